"""Benchmark decontamination: documents are scanned for word windows of benchmark items.

Items are normalised (A-Z lower-cased, ASCII other than letters and digits separates words) and cut into windows of ``width``
words; an item with fewer words is one window. Windows become a sorted array of 64-bit hashes with their words beside it, which is
broadcast. A document's words are looked up among the words of the items, windows with a foreign word are skipped, the
others are looked up by hash and a hit is verified word by word.

What is broadcast is bounded: item words are counted first, and beyond ``block_words`` the items are cut into blocks of about that
many words, dealt out by a hash. Each block is one scan of all documents that keeps only rows with hits, and the hits of a
row are joined at the end. The result does not depend on the number of blocks.

Defined cases: null and empty texts have no words, hit nothing and hold no window; an item that occurs twice, or with an id used
twice, counts once; an item without id marks hits but is not listed. With several blocks, rows are brought together by id and
text hash, so rows repeated in full share one scan's result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import staged
from plumbline.llm.words import LOWER_ALNUM, covered, texts

WIDTH = 10
BLOCK_WORDS = 200_000       # item words of a block: about 130 MB on the driver while it is built, 45 MB in a worker
SEGMENT_WORDS = 10_000
_FOUND = "struct<n_words:int, starts:array<int>, stops:array<int>, items:array<string>>"


class WindowSet:
    """Windows of some items, by hash, and the items that hold each."""

    def __init__(self, segments: list[tuple[str | None, bytes]], width: int):
        self.ids: dict[bytes, int] = {}
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, list[list[str]]]] = {}
        windows: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in segments:
            words = text.split()
            numbers = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            size = min(width, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                windows.setdefault(size, {}).setdefault(tuple(numbers[i:i + size]), set()).add(item)
        for size, found in windows.items():
            rows = np.array(list(found), np.uint64).reshape(len(found), size)
            keys = self.hashes(rows)
            order = np.argsort(keys, kind="stable")
            holders = list(found.values())
            self.sizes[size] = (keys[order], rows[order], [sorted(x for x in holders[i] if x is not None) for i in order])

    @staticmethod
    def hashes(rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows), np.uint64)
        for i in range(rows.shape[1]):
            total = (total ^ rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return total

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Mask of the hit words (None: none) and the items whose windows occur."""
        n = len(words)
        numbers = np.fromiter(map(self.ids.get, words, repeat(0)), np.uint64, n)
        foreign = np.concatenate(([0], np.cumsum(numbers == 0)))
        hit, items = None, set()
        for size, (keys, rows, holders) in self.sizes.items():
            starts = np.flatnonzero(foreign[size:] == foreign[:n - size + 1]) if n >= size else []
            if not len(starts):
                continue
            own = np.lib.stride_tricks.sliding_window_view(numbers, size)[starts]
            hashes = self.hashes(own)
            at, end = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, "right")
            found = []
            for k in np.flatnonzero(at < end):
                for j in range(at[k], end[k]):
                    if np.array_equal(rows[j], own[k]):
                        found.append(starts[k])
                        items.update(holders[j])
            if found:
                mask = covered(np.array(found), size, n)
                hit = mask if hit is None else hit | mask
        return hit, items


def normalised(text: bytes) -> bytes:
    return text.translate(LOWER_ALNUM)


def spans(mask: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return edges[::2].tolist(), edges[1::2].tolist()


def item_segments(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, text (normalised, at most ``SEGMENT_WORDS`` words, overlapping so that no window is lost), n_words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                words = normalised(text).split()
                for i in range(0, max(len(words) - width + 1, min(len(words), 1)), SEGMENT_WORDS):
                    some = words[i:i + SEGMENT_WORDS + width - 1]
                    rows.append((item, b" ".join(some), len(some)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.int64())], ["item_id", "text", "n_words"])

    return benchmark.select(F.col("item_id").cast("string"), "text").distinct().mapInArrow(cut, "item_id string, text binary, n_words bigint")


def _scanner(spark, segments: DataFrame, width: int):
    """A column function for one block of item segments. What the driver gathers is bounded by the block's size."""
    windows = WindowSet([(r["item_id"], bytes(r["text"])) for r in segments.select("item_id", "text").collect()], width)
    shared = spark.sparkContext.broadcast(windows)

    @F.arrow_udf(_FOUND)
    def scan(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        fields = [("n_words", pa.int32()), ("starts", pa.list_(pa.int32())), ("stops", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
        for batch in column:
            rows = []
            for text in texts(batch):
                words = normalised(text).split()
                hit, items = own.scan(words)
                starts, stops = ([], []) if hit is None else spans(hit)
                rows.append((len(words), starts, stops, sorted(items)))
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)],
                                             fields=[pa.field(*f) for f in fields])

    return scan.asNondeterministic()    # else a filter on what it finds would scan the texts a second time


def scanned(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as struct ``row`` beside ``found``: n_words, the hit word spans (starts, stops) and the items found."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"))
    segments = staged(item_segments(benchmark, width))
    words = segments.agg(F.sum("n_words")).first()[0] or 0
    blocks = max(1, math.ceil(words / block_words))
    if blocks == 1:
        return rows.withColumn("found", _scanner(spark, segments, width)(F.col("row.text")))
    key = [F.col("row.doc_id").alias("_id"), F.xxhash64("row.text").alias("_hash")]
    parts = None
    for block in range(blocks):
        own = segments.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found = rows.select(*key, _scanner(spark, own, width)(F.col("row.text")).alias("found"))
        found = staged(found.where(F.size("found.starts") > 0).distinct())
        parts = found if parts is None else parts.unionByName(found)

    @F.arrow_udf("struct<starts:array<int>, stops:array<int>>")
    def merge(starts: pa.Array, stops: pa.Array) -> pa.Array:
        out: list[tuple[list, list]] = []
        for s, e in zip(starts.to_pylist(), stops.to_pylist()):
            mask = np.zeros(max(e) + 1, bool)
            for i, j in zip(s, e):
                mask[i:j] = True
            out.append(spans(mask))
        return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.list_(pa.int32())), pa.array([o[1] for o in out], pa.list_(pa.int32()))],
                                          names=["starts", "stops"])

    # A row has at most one part per block.
    joined = parts.groupBy("_id", "_hash").agg(F.first("found.n_words").alias("n_words"), F.flatten(F.collect_list("found.starts")).alias("s"),
                                               F.flatten(F.collect_list("found.stops")).alias("e"),
                                               F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.items")))).alias("items"))
    joined = joined.withColumn("m", merge("s", "e")) \
        .select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), F.struct("n_words", "m.starts", "m.stops", "items").alias("found"))
    empty = _scanner(spark, segments.limit(0), width)
    rows = rows.select("row", *key)
    out = rows.join(joined, rows["_id"].eqNullSafe(joined["_i"]) & (rows["_hash"] == joined["_h"]), "left")
    return out.select("row", F.coalesce("found", empty(F.col("row.text"))).alias("found"))


def hits(found: Column) -> Column:
    """Number of hit words."""
    return F.aggregate(F.zip_with(found["starts"], found["stops"], lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, the hit spans, the items found (ids as text, sorted) and contaminated."""
    rows = scanned(docs.select("doc_id", "text"), benchmark, width, block_words)
    return rows.select(F.col("row.doc_id").alias("doc_id"), F.col("found.n_words").cast("long").alias("n_words"),
                       hits(F.col("found")).alias("n_hit"), "found.starts", "found.stops", "found.items",
                       (F.size("found.starts") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without benchmark windows, with all their columns: ``remove`` whole "documents", or only the "spans" from the
    first to the last character of each run of hit words."""
    rows = scanned(docs, benchmark, width, block_words)
    if remove == "documents":
        return rows.where(F.size("found.starts") == 0).select("row.*")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    cut = _span_remover()(F.col("row.text"), F.col("found.starts"), F.col("found.stops"))
    text = F.when(F.size("found.starts") > 0, cut).otherwise(F.col("row.text"))
    return rows.withColumn("row", F.col("row").withField("text", text)).select("row.*")


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _span_remover():
    @F.arrow_udf("string")
    def remove(text: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
        out = []
        for data, s, e in zip(texts(text), starts.to_pylist(), stops.to_pylist()):
            places = [m.span() for m in _WORD.finditer(normalised(data))]
            kept, at = [], 0
            for i, j in zip(s, e):
                kept.append(data[at:places[i][0]])
                at = places[j - 1][1]
            out.append(b"".join([*kept, data[at:]]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return remove
