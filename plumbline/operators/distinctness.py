"""Repeated rows, distinct keys, and the distinct values a source has shown so far."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import as_text, cell
from ..functions.scores import at_least_zero, at_most_one, ratio
from ..plans.staging import stage
from ..plans.summary import KeySet, groups

VALUES_SCHEMA = "attribute string, value string"
BROADCAST_HASHES = 4_000_000    # of repeated rows
DIGEST_BYTES = 32
HOT_COPIES = 10_000             # of a row; rows of more are combined before a shuffle
HASHES_PER_TASK = 1_000_000     # that are combined before the shuffle, and about as many that a task counts after it
DISTINCTNESS_SCHEMA = "Attribute string, Count bigint, TotalRows bigint, DistinctnessValue double"


def _exact(value: Column, kind: T.DataType) -> Column:
    """A value that two cells share if and only if grouping takes them as equal, at any depth: zeros of either sign are one, and instants do not
    depend on the session's zone."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")              # 0.0 for -0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")              # two instants may share a local time
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _exact(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_exact(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast("string")


def _exact_text(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(F.struct(_exact(cell(name), kind).alias("c")), {"ignoreNullFields": "false"})
    return _exact(cell(name), kind)


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over the cells, each with its length so that no two rows write the same text."""
    parts = []
    for name in columns:
        text = _exact_text(name, df.schema[name].dataType)
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(
            F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def distinctness_global(df: DataFrame, columns: Sequence[str], digest: bool = False) -> DataFrame:
    """Distinctness of whole rows.

    A group of equal rows weighs half its size once it has more than two; pairs do not count.
    ``DistinctRatio`` is the plain share of distinct rows. With ``digest`` the shuffle moves a SHA-256
    digest per row instead of the row, which pays for wide rows. Equal rows are combined before it either way.
    """
    keys = [row_digest(df, columns).alias("digest")] if digest else [cell(c) for c in columns]
    counted = df.select(*keys)
    return _row_distinctness(counted.groupBy(*[cell(c) for c in counted.columns]).agg(F.count(F.lit(1)).alias("copies")))


def _row_distinctness(sizes: DataFrame) -> DataFrame:
    """From the size of each group of equal rows in ``copies``; ``groups``, if there, tells how many groups a row stands for."""
    groups = F.sum("groups") if "groups" in sizes.columns else F.count(F.lit(1))
    rows = F.sum(F.col("copies") * F.col("groups")) if "groups" in sizes.columns else F.sum("copies")
    repeated = F.sum(F.when(F.col("copies") > 2, F.col("copies") / 2 * (F.col("groups") if "groups" in sizes.columns else 1)).otherwise(0.0))
    return sizes.agg(at_least_zero(1 - ratio(repeated, rows)).alias("Distinctness"), ratio(groups, rows).alias("DistinctRatio"))


def _tasks(df: DataFrame, per_task: int = HASHES_PER_TASK) -> int:
    """Tasks after a shuffle of the frame's rows, for each to hold its share."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // per_task))


def _copies(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*[cell(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias("copies"))


def hash_counts(hashes: DataFrame, per_task: int = HASHES_PER_TASK) -> DataFrame:
    """``hash, copies`` of a frame of one column of 64-bit numbers.

    They are combined before the shuffle, so a frequent one meets in few rows, but in parts of bounded size: a hash map over all that a task reads
    would spill where most come once. After it there are as many tasks as it takes for each to hold its share.
    """

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            values, copies = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(copies, pa.int64())], ["hash", "copies"])

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= per_task:
                yield out()
                held.clear()
        if held:
            yield out()

    return hashes.mapInArrow(combined, "hash bigint, copies bigint").repartition(_tasks(hashes, per_task), "hash").groupBy("hash").agg(F.sum("copies").alias("copies"))


def distinctness_in_two_steps(df: DataFrame, columns: Sequence[str], staging: str, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """As ``distinctness_global``, for wide rows of which most come once.

    The first step shuffles a 64-bit hash per row. A hash that comes once is a row that comes once, and only how many those are matters, so
    none of them is written. The second step reads the rows again, keeps those whose hash repeats and groups them exactly, so two rows of
    one hash are still two. Up to ``broadcast_hashes`` repeated hashes of 8 bytes go to every executor, which finds the rows in place, so that no
    row is shuffled that is not repeated. More of them meet the rows' digests in one shuffle, or the rows where these are shorter than a
    digest; only hashes of more than ``HOT_COPIES`` rows, which are few, still go to every executor. ``staging``: folder for the hashes.
    """
    own = F.xxhash64(*[cell(c) for c in columns])       # zeros of either sign and all NaN hash alike
    singles = Observation()
    counted = hash_counts(df.select(own.alias("hash"))).observe(singles, F.count_if(F.col("copies") == 1).alias("n"))
    repeated = stage(counted.filter("copies > 1"), staging, "row_hashes")
    single = singles.get["n"]
    few = repeated.limit(broadcast_hashes + 1).count() <= broadcast_hashes
    keys = [cell(c) for c in columns]
    if few:
        sizes = _copies(df.withColumn("__hash", own).join(F.broadcast(repeated), F.col("__hash") == F.col("hash"), "left_semi").select(*keys))
    else:
        kinds = [df.schema[c].dataType for c in columns]
        short = all(isinstance(k, (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)) for k in kinds) and 8 * len(kinds) <= DIGEST_BYTES
        cells = [c.alias(f"k{i}") for i, c in enumerate(keys)] if short else [F.unhex(row_digest(df, columns)).alias("k0")]
        rows = df.select(own.alias("hash"), *cells)
        hot = F.broadcast(repeated.filter(F.col("copies") > HOT_COPIES))
        often = _copies(rows.join(hot, "hash", "left_semi").select("hash", *rows.columns[1:]))
        tasks = _tasks(df)
        seldom = rows.join(hot, "hash", "left_anti").repartition(tasks, "hash").join(repeated.filter(F.col("copies") <= HOT_COPIES).repartition(tasks, "hash"), "hash", "left_semi")
        sizes = often.select("copies").unionByName(_copies(seldom).select("copies"))
    once = df.sparkSession.createDataFrame([(1, single)] if single else [], "copies long, groups long")
    return _row_distinctness(sizes.select("copies", F.lit(1).cast("long").alias("groups")).unionByName(once))


def _counted(summary: DataFrame, key_sets: Sequence[KeySet]) -> DataFrame:
    # A summary has one row per distinct key, so counting its rows counts distinct keys.
    return groups(summary, key_sets).groupBy("key_set").agg(
        F.count(F.lit(1)).alias("DistinctCount"), F.sum("rows_filled").alias("rows"))


def distinctness_attribute(summary: DataFrame, key_sets: Sequence[KeySet], confidence: float) -> DataFrame:
    return _counted(summary, key_sets).select(
        "key_set", "DistinctCount", ratio(F.col("DistinctCount"), F.col("rows")).alias("Distinctness"),
        F.lit(float(confidence)).alias("Confidence"))


def population_attribute(summary: DataFrame, key_sets: Sequence[KeySet], source_distinctness: DataFrame,
                         confidence: float) -> DataFrame:
    """Distinct keys now against all the source has shown, for key sets of one column."""
    single = [k for k in key_sets if len(k) == 1]
    stored = source_distinctness.select(F.col("Attribute").alias("key_set"), F.col("Count").alias("stored"))
    return (_counted(summary, single).join(stored, "key_set")
            .select("key_set", "DistinctCount",
                    at_most_one(ratio(F.col("DistinctCount"), F.col("stored"))).alias("CompletenessPopulationValue"),
                    F.lit(float(confidence)).alias("Confidence")))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``attribute, value`` of every value each column holds, all columns in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), as_text(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).distinct()


def new_values(df: DataFrame, columns: Sequence[str], stored: DataFrame) -> DataFrame:
    """The distinct values of a batch that the source has not shown before.

    The stored values the batch repeats are found first. In that join the batch is the side to build from, so
    a long history is only scanned when the batch's values are few enough to broadcast, and can be thinned out
    by a run-time filter when they are not; against the history itself it would be shuffled for every batch.
    """
    return unseen_values(distinct_values(df, columns), stored)


def unseen_values(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Those of a batch's distinct values that are not stored. ``current`` is read twice."""
    repeated = stored.join(current, ["attribute", "value"], "left_semi")
    return current.join(repeated, ["attribute", "value"], "left_anti")


def distinctness_update(rows: DataFrame, columns: Sequence[str], added: DataFrame,
                        previous: DataFrame) -> DataFrame:
    """Distinctness of the source after a batch.

    ``rows`` is one row with the batch's ``rows``, ``added`` the values new to the source and ``previous``
    the state before the batch, empty for the first one.
    """
    return distinctness_totals(rows, columns, added.groupBy("attribute").agg(F.count(F.lit(1)).alias("Count")), previous)


def distinctness_totals(rows: DataFrame, columns: Sequence[str], fresh: DataFrame, previous: DataFrame) -> DataFrame:
    """As ``distinctness_update``, from the number of new values per attribute (attribute, Count)."""
    batch = rows.select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("Attribute"),
                        F.lit(0).cast("long").alias("Count"), F.col("rows").alias("TotalRows"))
    counted = fresh.select(F.col("attribute").alias("Attribute"), "Count", F.lit(0).cast("long").alias("TotalRows"))
    before = previous.select("Attribute", "Count", "TotalRows")
    return (before.unionByName(counted).unionByName(batch).groupBy("Attribute")
            .agg(F.sum("Count").alias("Count"), F.sum("TotalRows").alias("TotalRows"))
            .withColumn("DistinctnessValue", ratio(F.col("Count"), F.col("TotalRows"))))
