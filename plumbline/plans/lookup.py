"""Existence look-ups whose strategy follows the measured size of the list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.cells import cell

BROADCAST_BYTES = 64 * 1024 * 1024      # largest list, as texts, that goes to every executor
ROW_OVERHEAD_BYTES = 64
HOT_SHARE = 1000                        # a key is hot above 1/1000 of the sampled rows: there are fewer than 1000
HOT_SAMPLE = 0.01                       # rows looked at to find hot keys
HOT_ROWS = 20                           # and how many of those a hot key has at least
HOT_SALTS = 64                          # parts that the rows of a hot key are dealt out to


@dataclass(frozen=True)
class Lookup:
    """A list to look rows up in: ``keys`` maps each column of ``known`` to the text expression it is compared with."""

    keys: Mapping[str, Column]
    known: DataFrame
    flag: str


def text_bytes(df: DataFrame) -> int:
    """Upper estimate of a frame of text columns in memory; one aggregation over it."""
    size = F.lit(ROW_OVERHEAD_BYTES)
    for name in df.columns:
        size = size + F.coalesce(F.octet_length(cell(name)), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).head()["bytes"]


def hot_keys(rows: DataFrame, keys: Sequence[Sequence[str]], fraction: float = HOT_SAMPLE) -> DataFrame:
    """``list, key`` of key values that hold many rows, for several lists of key columns, found by one pass over a sample; fewer
    than ``HOT_SHARE`` for each.

    They only decide how a row is joined, not what comes out. The keys found are fixed by bringing them to the
    driver: two parts of a plan that each sampled for themselves could disagree on a key.
    """
    sample = rows.sample(fraction, seed=0).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("list"), key_of(k).alias("key")) for i, k in enumerate(keys)])).alias("k"))
    counts = sample.groupBy("k.list", "k.key").agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy("list"))
    hot = counts.withColumn("total", total).filter((F.col("rows") * HOT_SHARE > F.col("total")) & (F.col("rows") >= HOT_ROWS))
    return rows.sparkSession.createDataFrame(hot.select("list", "key").collect(), "list int, key string")


def key_of(columns: Sequence[str]) -> Column:
    """One text for the texts of several columns."""
    return F.to_json(F.array(*[cell(c) for c in columns]))


def flag_known(df: DataFrame, lists: Sequence[Lookup], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add a boolean column per list: does it hold the row's keys?

    The rows are read once and stay in one branch, whatever the number of lists. A list of checked size is broadcast and rows stay
    where they are. A longer list takes a shuffle join, in which the rows of a hot key are dealt out by a salt, with
    the key's answer repeated for each.
    """
    names = [{c: f"__key_{i}_{j}" for j, c in enumerate(lookup.known.columns)} for i, lookup in enumerate(lists)]
    rows = df.select("*", *[lookup.keys[c].alias(n) for lookup, own in zip(lists, names) for c, n in own.items()])
    listed = [lookup.known.select(*[cell(c).alias(n) for c, n in own.items()]) for lookup, own in zip(lists, names)]
    # The list as it is bounds the distinct one, and is measured without a shuffle.
    long = [i for i, known in enumerate(listed)
            if text_bytes(known) > broadcast_bytes and text_bytes(known.distinct()) > broadcast_bytes]
    hot = hot_keys(rows, [list(names[i].values()) for i in long]) if long else None
    for i, (lookup, known) in enumerate(zip(lists, listed)):
        on = list(names[i].values())
        answers = known.distinct().withColumn(lookup.flag, F.lit(True))
        if i not in long:
            rows = rows.join(F.broadcast(answers), on, "left")
            continue
        own = F.broadcast(hot.filter(F.col("list") == long.index(i)).select(F.col("key").alias("__hot")))
        salts = F.when(F.col("__hot").isNotNull(), F.lit(HOT_SALTS)).otherwise(F.lit(1))
        rows = rows.join(own, key_of(on) == F.col("__hot"), "left") \
            .withColumn("__salt", F.pmod(F.xxhash64(*[cell(c) for c in df.columns]), salts).cast("int")).drop("__hot")
        answers = answers.join(own, key_of(on) == F.col("__hot"), "left") \
            .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__hot")
        rows = rows.join(answers, [*on, "__salt"], "left").drop("__salt")
    return rows.select(*[cell(c) for c in df.columns], *[F.coalesce(lookup.flag, F.lit(False)).alias(lookup.flag) for lookup in lists])
