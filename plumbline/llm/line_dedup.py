"""Line deduplication over a corpus: lines that many documents hold stay in one of them.

Each text becomes a row per distinct key (the stripped, lower-cased line; 128-bit hash) with the positions of its lines. Rows are dealt out by
ranges of (key, document) and sorted, so a task streams the documents of a key in order, the one that keeps its lines
first. As the ranges include the document, a key that a third of the corpus holds spreads over many tasks. A task
decides all keys that it holds whole. Of the first and the last key of its range, which neighbours may share, it decides the documents
that cannot be the keeper, once it has seen enough of them, and leaves open at most a few documents; what is open is put
together by key. Decisions go back as a compressed bitmap per document, never as text.

Defined cases: null and empty texts are one empty line; lines with short keys always stay; a key's lines repeated in the keeping
document all stay. Rows with equal ids are one document (so a key in them counts once) and each gets its own
bitmap; null ids are together the document that is last to keep. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from xxhash import xxh3_128_digest

from plumbline.llm.shared import staged
from plumbline.llm.words import LOWER, texts

BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
LEAST_CHARS, LEAST_DOCS = 20, 3
_LOWEST = -(1 << 63)
_ROWS = "key binary, doc bigint, hash bigint, places array<int>"
_DECIDED = _ROWS + ", seen int"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).translate(LOWER)


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("key", pa.binary()), ("doc", pa.int64()), ("hash", pa.int64()), ("places", pa.list_(pa.int32())), ("seen", pa.int32())]
    kinds = kinds[:len(rows[0])] if rows else kinds
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])


def key_rows(docs: DataFrame, least_chars: int) -> DataFrame:
    """key, doc, hash (of the text), places: a row per document and distinct key."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
                places: dict[bytes, list[int]] = {}
                for i, line in enumerate(text.split(b"\n")):
                    if long_enough(key := line_key(line), least_chars):
                        places.setdefault(xxh3_128_digest(key), []).append(i)
                rows += [(key, doc, own, p) for key, p in places.items()]
                if len(rows) > 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("doc"), F.xxhash64("text").alias("hash"), "text") \
        .mapInArrow(explode, _ROWS)


def streamed(rows: DataFrame, least_docs: int) -> DataFrame:
    """Decisions over rows sorted by key and descending document. ``seen`` is null in rows to drop; rows that are open have it: the
    documents of the key in this task, in one row per task, else 0."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, first_key, known, docs = None, True, [], 0     # known: rows of the key not yet decided, of at most least_docs documents

        def close(shared: bool) -> None:
            """The key ends. Undecided rows of a key that another task may share stay open."""
            if known and shared:
                out.extend((*row, docs if i == 0 else 0) for i, row in enumerate(known))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != key:
                    if key is not None:
                        close(first_key)
                        first_key = False
                    key, known, docs, last = row[0], [], 0, None
                if row[1] != last:
                    docs, last = docs + 1, row[1]
                    if docs == least_docs:
                        keeper = known[0][1]
                        out.extend((*r, None) for r in known if r[1] != keeper)
                        known = [r for r in known if r[1] == keeper]
                if docs >= least_docs and row[1] != known[0][1]:
                    out.append((*row, None))
                else:
                    known.append(row)
            if len(out) > 20_000:
                yield _batch(out)
                out.clear()
        if key is not None:
            close(True)
        if out:
            yield _batch(out)

    return rows.mapInArrow(stream, _DECIDED)


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc, hash, bitmap: a row per document that loses lines. ``bitmap``: zlib-compressed bits, 1 for a line that stays."""
    order = [F.col("key").asc(), F.col("doc").desc()]
    rows = key_rows(docs, least_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    decided = staged(streamed(rows, max(least_docs, 2)))
    by_key = Window.partitionBy("key")
    opened = decided.where("seen IS NOT NULL").withColumn("_docs", F.sum("seen").over(by_key)).withColumn("_keeper", F.max("doc").over(by_key)) \
        .where((F.col("_docs") >= least_docs) & (F.col("doc") != F.col("_keeper")))
    out = decided.where("seen IS NULL").select("doc", "hash", "places").unionByName(opened.select("doc", "hash", "places"))

    @F.arrow_udf("binary")
    def bitmap(places: pa.Array) -> pa.Array:
        maps = []
        for places_of in places:
            at = np.array(places_of.values, np.int64)
            bits = np.ones((int(at.max()) // 8 + 1) * 8, bool)     # whole bytes, so that no line is dropped by padding
            bits[at] = False
            maps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        return pa.array(maps, pa.binary())

    return out.groupBy("doc", "hash").agg(F.flatten(F.collect_list("places")).alias("_places")) \
        .select("doc", "hash", bitmap("_places").alias("bitmap"))


def kept_lines(text: bytes, bitmap: bytes | None) -> list[bytes]:
    """The lines that stay. Lines beyond the bitmap do."""
    lines = text.split(b"\n")
    if bitmap is None:
        return lines
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:len(lines)].astype(bool).tolist()
    return [line for line, k in zip(lines, keep + [True] * (len(lines) - len(keep))) if k]


def line_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` as struct ``row`` beside ``bitmap``, null where every line stays."""
    drops = dropped_lines(docs, least_chars, least_docs).withColumnRenamed("doc", "_d").withColumnRenamed("hash", "_h")
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("_doc"),
                       F.xxhash64("text").alias("_hash"))
    return rows.join(drops, (rows["_doc"] == drops["_d"]) & (rows["_hash"] == drops["_h"]), "left").select("row", "bitmap")


@F.arrow_udf(T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                          T.StructField("kept_sha256", T.StringType())]))
def line_digest(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    out = []
    for data, bits in zip(texts(text), bitmap):
        kept, n = kept_lines(data, bits.as_py()), data.count(b"\n") + 1
        out.append((n, n - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                       pa.array([o[2] for o in out], pa.string())], names=["n_lines", "n_dropped", "kept_sha256"])


@F.arrow_udf(T.StringType())
def _kept_text(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    return pa.array([b"\n".join(kept_lines(d, b.as_py())).decode("utf-8", "replace") for d, b in zip(texts(text), bitmap)], pa.string())


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents without the lines they lose, with all their columns."""
    rows = line_bitmaps(docs, least_chars, least_docs)
    text: Column = F.when(F.col("bitmap").isNotNull(), _kept_text(F.col("row.text"), F.col("bitmap"))).otherwise(F.col("row.text"))
    return rows.withColumn("row", F.col("row").withField("text", text)).select("row.*")
