"""URL filters: every capture against the list entries that were active when it was fetched.

A list is a log of dated changes: a key (a host, a parent domain or a host with a path prefix) is added with a verdict or removed. Changes
of a key become validity intervals from one change up to the next. A capture has the keys of its own host, of every parent domain and of
every path prefix at segment boundaries. An as-of join looks up, per key, the interval that holds the fetch time.

Captures and intervals meet by key and time slot: an interval is laid out over the slots it covers within the time of the captures, so one
host's captures spread over slots, and keys that many captures share are salted as well: their captures get a salt and
their intervals are repeated for each. How often a key comes up is counted over all captures, combined before the shuffle.

Of several active entries the longest key decides (a path before its host, a host before its parent), and of changes of one key at the
same time the largest verdict in code point order, a removal last. Several lists may hold a key; each list has its own intervals.

Defined cases: captures without url or time meet no entry and are kept; changes without key or time are left out; changes repeated in
full count once; equal and null captures each get a row of their own. Hosts are compared in lower case, without a trailing dot. A url without
scheme or host has no keys. Empty lists keep every capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.shared import staged

SLOT_SECONDS = 30 * 86400
HOT_ROWS = 50_000           # captures of a key and slot that share a salt
BROADCAST_PAIRS = 500_000   # pairs of key and slot, of about 60 bytes, that go to every executor
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case; null if the url has none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.$", ""), F.lit(""))


def url_keys(url: Column) -> Column:
    """Host, parent domains, and the host with each prefix of the path."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")
    paths = F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(1), F.size(steps)),
                                                  lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/"))))
    return F.when(host.isNotNull(), F.concat(parents, F.coalesce(paths, F.array().cast("array<string>"))))


def validity(changes: DataFrame) -> DataFrame:
    """list, key, verdict, since, until (null: open) from dated changes: list, key, at, action ("add" or "remove"), verdict."""
    known = changes.where("key IS NOT NULL AND at IS NOT NULL")
    # One change per list, key and time: a removal wins, then the largest verdict.
    last = known.groupBy("list", "key", "at").agg(F.max(F.struct((F.col("action") == "remove").alias("removed"), F.col("verdict"))).alias("c"))
    after = F.lead("at").over(Window.partitionBy("list", "key").orderBy("at"))
    return last.withColumn("until", after).where("NOT c.removed") \
        .select("list", "key", F.col("c.verdict").alias("verdict"), F.col("at").alias("since"), "until")


def _slot(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(time.cast("timestamp")) / F.lit(seconds))


def active_entries(captures: DataFrame, changes: DataFrame, slot_seconds: int = SLOT_SECONDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A row per capture and entry active at its fetch time: ``capture`` (as given), list, key, verdict.

    ``captures``: a unique ``capture`` value, url, fetched.
    """
    looked_up = captures.where("fetched IS NOT NULL AND url IS NOT NULL") \
        .select("capture", "fetched", _slot(F.col("fetched"), slot_seconds).alias("slot"), F.explode(F.array_distinct(url_keys(F.col("url")))).alias("key"))
    intervals = validity(changes)
    listed = intervals.select("key").distinct()
    looked_up = staged(looked_up.join(listed, "key", "left_semi"))
    if looked_up.isEmpty():
        return looked_up.join(intervals, "key").select("capture", "list", "key", "verdict")
    ends = looked_up.agg(F.min("slot").alias("low"), F.max("slot").alias("high")).first()
    # Only pairs of key and slot with more captures than share a salt, so at most one for every ``hot_rows`` look-ups.
    hot = staged(looked_up.groupBy("key", "slot").agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_rows)).alias("salts")).where("salts > 1"))
    salts = F.broadcast(hot) if hot.count() <= BROADCAST_PAIRS else hot
    laid_out = intervals.withColumn("slot", F.explode(F.when(
        F.coalesce(_slot(F.col("until"), slot_seconds), F.lit(ends["high"])) >= F.greatest(_slot(F.col("since"), slot_seconds), F.lit(ends["low"])),
        F.when(F.greatest(_slot(F.col("since"), slot_seconds), F.lit(ends["low"])) <= F.least(F.coalesce(_slot(F.col("until"), slot_seconds), F.lit(ends["high"])), F.lit(ends["high"])),
               F.sequence(F.greatest(_slot(F.col("since"), slot_seconds), F.lit(ends["low"])),
                          F.least(F.coalesce(_slot(F.col("until"), slot_seconds), F.lit(ends["high"])), F.lit(ends["high"])))))))
    parts = F.coalesce("salts", F.lit(1).cast("long"))
    laid_out = laid_out.join(salts, ["key", "slot"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("salts")
    own = looked_up.join(salts, ["key", "slot"], "left").withColumn("salt", F.pmod(F.xxhash64("capture"), parts)).drop("salts")
    found = own.join(laid_out, ["key", "slot", "salt"])
    return found.where((F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))) \
        .select("capture", "list", "key", "verdict")


def decisions(captures: DataFrame, changes: DataFrame, slot_seconds: int = SLOT_SECONDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A row per row of ``captures``: capture, ``n_active`` entries, the ``key`` and ``verdict`` that decide (null: none) and ``blocked``.

    The rows are numbered and staged, so captures may repeat or be null.
    """
    rows = staged(captures.select("capture", "url", "fetched", F.monotonically_increasing_id().alias("_row")))
    active = active_entries(rows.select(F.col("_row").alias("capture"), "url", "fetched"), changes, slot_seconds, hot_rows)
    strongest = F.max(F.struct(F.length("key"), F.col("key"), F.col("verdict")))
    best = active.groupBy(F.col("capture").alias("_found")).agg(F.count(F.lit(1)).alias("n_active"), strongest.alias("best"))
    return rows.select("capture", "_row").join(best, F.col("_row") == F.col("_found"), "left") \
        .select("capture", F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"), F.col("best.key").alias("key"),
                F.col("best.verdict").alias("verdict"), F.coalesce(F.col("best.verdict") == "block", F.lit(False)).alias("blocked"))
