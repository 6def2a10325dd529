"""Sharding by jump consistent hashing: a key and the number of shards decide the shard, without a table of the ring.

Going from ``n`` to ``n + 1`` shards moves a key only into the new shard, and about one key in ``n + 1``. Within a shard rows get gapless
slots in the order of their ids: all rows are dealt out by ranges of shard and id and numbered within each range, and only the sizes of the
ranges meet in one task, so no task holds a shard.

Defined cases: a null key is the key 0 and null text has no bytes (size 1, checksum 0). Rows with equal keys go to the same
shard; rows equal in id and text get their slots in any order. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import numbered, staged

SHARDS = 16
# Fixed value of the published algorithm: the multiplier of its linear congruential generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(state), np.int64)
    to = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        at[moving] = to[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        to[moving] = ((at[moving] + 1) * (float(1 << 31) / ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        moving = moving[to[moving] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard, from 0, of an integer key."""
    if shards < 1:
        raise ValueError("there is at least one shard")

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        return pa.array(jump(keys.to_numpy(zero_copy_only=False), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row per document: doc_id, size, text_crc32, shard, slot and grown_shard, the shard if one more is appended."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       shard_of(F.col("doc_id"), shards).alias("shard"), shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"))
    rows = numbered(staged(rows), [F.col(c).asc() for c in ("shard", "doc_id", "text_crc32", "size")], "_number")
    # There is a row per shard, so the driver's and the window's share is bounded by the number of shards.
    starts = rows.groupBy(F.col("shard").alias("_shard")).agg(F.min("_number").alias("_start"))
    return rows.join(F.broadcast(starts), F.col("shard") == F.col("_shard")) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_number") - F.col("_start")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, files: int = 1) -> None:
    """The documents as Parquet in one folder per shard, each in ``files`` parts, dealt out by a hash of the id."""
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(files))
    docs.withColumn("shard", shard_of(F.col("doc_id"), shards)).repartition(shards * files, "shard", spread) \
        .write.mode("errorifexists").partitionBy("shard").parquet(folder)
