import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import sharding as S

from .conftest import DOCS, text


def jump(key, shards):
    key &= (1 << 64) - 1
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        to = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


def test_jump():
    pick = random.Random(1)
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63] + [pick.randrange(-2 ** 63, 2 ** 63) for _ in range(500)]
    for shards in (1, 2, 3, 16, 17, 1000):
        assert S.jump(np.array(keys, np.int64), shards).tolist() == [jump(k, shards) for k in keys]
    # Published values of the algorithm.
    assert [jump(k, n) for k, n in ((1, 1), (42, 57), (0xDEAD10CC, 1), (0xDEAD10CC, 666), (256, 1024))] == [0, 43, 0, 361, 520]


def test_growth_moves_only_into_the_new_shard():
    keys = np.arange(50_000, dtype=np.int64)
    for n in range(1, 20):
        a, b = S.jump(keys, n), S.jump(keys, n + 1)
        moved = a != b
        assert set(b[moved].tolist()) <= {n} and abs(moved.mean() - 1 / (n + 1)) < 0.02
        assert np.bincount(a, minlength=n).max() < 1.1 * len(keys) / n


def check(rows):
    by_shard = {}
    for r in rows:
        key = 0 if r["doc_id"] is None else r["doc_id"]
        assert (r["shard"], r["grown_shard"]) == (jump(key, 16), jump(key, 17))
        by_shard.setdefault(r["shard"], []).append(r)
    for own in by_shard.values():
        own.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        ids = [-1 << 63 if r["doc_id"] is None else r["doc_id"] for r in own]
        assert ids == sorted(ids)


def test_slots(spark):
    rows = [(random.Random(i).randrange(-10 ** 12, 10 ** 12) if i % 3 else 7, text(i % 50, 5), "en", "s", None) for i in range(3000)]
    got = S.sharded(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert len(got) == 3000
    check(got)


def test_odd_rows(spark, odd_docs):
    got = S.sharded(odd_docs).collect()
    check(got)
    texts = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts}
    assert S.sharded(odd_docs.limit(0)).count() == 0


def test_written_shards(spark, odd_docs, tmp_path):
    S.write_shards(odd_docs.drop("shard"), str(tmp_path / "out"), 4, 2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 9 and back.where(F.col("shard") != S.shard_of(F.col("doc_id"), 4)).count() == 0
