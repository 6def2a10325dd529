import corpus_pipeline as P
import pytest
from plumbline.llm.decontaminate import contamination
from plumbline.llm.ngram_join import similar_classes
from plumbline.llm.shared import shared_folder, staged, table

from .conftest import DOCS, text, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, SF))
        out.append(docs)
    return out


def test_columns_and_effects(stages, spark):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    good, single, clean, mixed = stages[1:5]
    assert good.count() < stages[0].count()
    assert similar_classes(single).where("doc_id != component_id").count() == 0
    assert contamination(clean, table(spark, SF, "benchmark")).where("contaminated").count() == 0
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in clean.collect()}
    assert stages[5].count() == mixed.count()


def test_run_is_the_stages(stages, spark):
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, stages[5].collect()))


def test_odd_documents(spark, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, stage in P.STAGES:
            docs = staged(stage(spark, docs, SF))
            if name != P.STAGES[-1][0]:
                assert docs.columns == odd_docs.columns, name


def test_shared_folder(spark, monkeypatch):
    class Session:
        class conf:     # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:     # noqa: N801
            master = "spark://somewhere"

    with pytest.raises(ValueError):
        shared_folder(Session)


def test_junk_of_a_small_language(spark, tmp_path):
    """A small stratum whose junk is clearly separable, against the expected verdicts."""
    def rows(first, n_good, n_junk, lang):
        make = lambda i: text(i, 80, 10_000) if i < first + n_good else " ".join(f"{w}###" for w in words(i, 80, 10_000))      # noqa: E731
        return [(i, make(i), lang, f"s{i % 2}", None) for i in range(first, first + n_good + n_junk)]

    docs = rows(0, 400, 20, "en") + rows(1000, 260, 20, "es")
    good = {*range(400), *range(1000, 1260)}
    labelled = [(i, int(i in good), 0) for i, *_ in docs if i in good or i % 2]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labelled, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = P.good_documents(spark, table(spark, str(tmp_path), "documents"), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == good
    assert {r["doc_id"] for r in P.run(spark, str(tmp_path)).select("doc_id").collect()} <= good
