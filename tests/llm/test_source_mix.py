import pytest
from pyspark.sql import functions as F

from plumbline.llm import source_mix as M

from .conftest import DOCS, text


def levels(sizes, weights, epochs=3):
    """Water-filling, one source after the other."""
    total, clamped = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in clamped)
        free = [s for s in sizes if s not in clamped]
        level = rest / sum(weights[s] for s in free) if free else 0
        new = {s for s in free if level * weights[s] > epochs * sizes[s]}
        if not new:
            return {s: epochs * sizes[s] if s in clamped else level * weights[s] for s in sizes}
        clamped |= new


def corpus(spark, counts):
    rows = [(1000 * k + i, text(1000 * k + i, 20 + (i * 37) % 200), "en", s, None) for k, (s, n) in enumerate(counts.items()) for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_targets_and_taken(spark):
    docs = corpus(spark, {"a": 300, "b": 3, "c": 40, "Z": 1, "é": 25, None: 10})
    rows = M.mixed_sources(docs).collect()
    sizes = {r["source"]: r["source_size"] for r in rows}
    order = ["Z", "a", "b", "c", "é", None]
    want = levels(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for source in order:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["size"] for r in own) == sizes[source]
        assert own[0]["target"] == pytest.approx(want[source])
        assert abs(sum(r["taken"] for r in own) - want[source]) <= 1 + len([r for r in own if 0 < r["part"] < 1])
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    again = M.mixed_sources(docs.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_seed_changes_the_sample(spark):
    docs = corpus(spark, {"a": 200, "b": 100})
    one, two = ({r["doc_id"]: r["taken"] for r in M.mixed_sources(docs, seed=s).collect()} for s in (1, 2))
    assert one != two


def test_one_document_with_nearly_all_words(spark):
    docs = spark.createDataFrame([(1, text(1, 5000), "en", "a", None), (2, text(2, 10), "en", "a", None), (3, text(3, 4000), "en", "b", None)], DOCS)
    rows = M.mixed_sources(docs).collect()
    for source in "ab":
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2


def test_mixture_repeats_whole_rows(spark):
    docs = corpus(spark, {"a": 600, "b": 20, "c": 200})
    plan = {r["doc_id"]: r for r in M.mixed_sources(docs).collect()}
    mixed = M.mixture(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for doc, r in plan.items():
        low, high = r["repeats"] + (r["part"] >= 1), r["repeats"] + (r["part"] > 0)
        assert low <= counts.get(doc, 0) <= high <= 3
    assert {(r["doc_id"], r["text"]) for r in mixed.collect()} <= {(r["doc_id"], r["text"]) for r in docs.collect()}


def test_odd_rows(spark, odd_docs):
    rows = M.mixed_sources(odd_docs).collect()
    assert len(rows) == 9 and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["taken"] for r in rows if r["size"] == 0} == {0}
    assert M.mixture(odd_docs).columns == odd_docs.columns and M.mixture(odd_docs).count() > 0
    assert M.mixed_sources(odd_docs.limit(0)).count() == M.mixture(odd_docs.limit(0)).count() == 0
    blank = odd_docs.where("trim(coalesce(text, '')) = ''")
    assert {(r["target"], r["taken"]) for r in M.mixed_sources(blank).collect()} == {(0.0, 0)}


def test_other_weights(spark):
    docs = corpus(spark, {"a": 100, "b": 100})
    by_hand = lambda sources: sources.withColumn("weight", F.when(F.col("source") == "a", 3.0).otherwise(1.0))
    rows = M.mixed_sources(docs, by_hand, max_epochs=10).collect()
    targets = {r["source"]: r["target"] for r in rows}
    assert targets["a"] == pytest.approx(3 * targets["b"])
