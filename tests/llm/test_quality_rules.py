import math
import random

import duckdb
import pandas as pd
import pytest

from plumbline.llm import quality_rules as Q
from plumbline.llm.oracles import SQL

from .conftest import text


def brute(t):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), len(lines),
            sum("A" <= c <= "Z" for c in t or ""), sum(c in "!?" for c in t or ""))


@pytest.mark.parametrize("t", ["", " \n ", "a b", "a b c a b c", "a a a a", "é ü x\x1cy z #*\n|<>&%$ é\n\né ü", "x\ny\nx\n x\n\t\nx", text(1, 300, 12),
                               "A!b?\x0b\x0c\x85c 日本 語"])
def test_measures(t):
    assert Q.measured(t.encode()) == brute(t)


def test_binomial():
    n, p = 23, 0.13
    for k in range(n + 1):
        exact = math.fsum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert Q.binomial_at_most(k, n, p) == pytest.approx(exact, rel=1e-9)
    assert Q.binomial_at_most(0, 10_000, 0.01) == pytest.approx(0.99 ** 10_000, rel=1e-6)


def test_choice():
    # Fixed sequence: the third cutoff fails, so the fourth is not reached; the first of equals is taken.
    assert Q.chosen([0.4, 0.3, 0.2, 0.1], [0, 0, 30, 0], [5, 5, 9, 20], 1000, 0.01, 0.01) == 0.4
    assert Q.chosen([0.4, 0.3], [0, 0], [0, 7], 1000, 0.01, 0.01) == 0.3
    assert Q.chosen([0.4, 0.3], [0, 0], [9, 9], 10, 0.01, 0.01) == math.inf      # too few to certify anything
    assert Q.chosen([0.4], [0], [0], 1000, 0.01, 0.01) == math.inf               # rejects nothing bad
    assert Q.chosen([0.4], [0], [4], 0, 0.01, 0.01) == math.inf


def many(spark, shares, lang="en"):
    """Documents whose share of symbols is as given."""
    out = []
    for i, s in enumerate(shares):
        n = 100
        out.append((i, " ".join(("#" * 5 if k < s * n else f"{random.Random(i * n + k).randrange(10**9):05d}"[:5]) for k in range(n)), lang))
    return spark.createDataFrame(out, "doc_id bigint, text string, lang string")


def test_risk_is_held(spark):
    plan = Q.RiskPlan(risk=0.1, error=0.1, rules={"symbols": ("n_symbols", "word_chars")}, cutoffs={"symbols": [0.4, 0.3, 0.2, 0.1]})
    docs = many(spark, [0.0] * 95 + [0.25] * 25 + [0.35] * 40)
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(160)] + [(None, 1, 0), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    kept = {r["doc_id"] for r in Q.quality_verdicts(docs, labels, plan=plan).where("kept").collect()}
    assert kept == set(range(120))      # 0.3 rejects all bad ones and no good one; 0.2 would reject 25 of 120 good ones


def test_few_labels_reject_nothing(spark):
    docs = many(spark, [0.0] * 5 + [0.45] * 5)
    labels = spark.createDataFrame([(i, int(i < 5), 0) for i in range(10)], "doc_id bigint, quality int, toxic int")
    assert Q.quality_verdicts(docs, labels).where("kept").count() == 10


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (2, None, 1), (None, 0, 0), (6, 1, 0), (6, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = Q.quality_verdicts(odd_docs, labels).collect()
    assert len(rows) == 9 and sorted(r["n_words"] for r in rows) == [0, 0, 0, 0, 60, 80, 80, 80, 40_000]
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in rows)
    kept = Q.kept_documents(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in rows)


def test_empty(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.quality_verdicts(odd_docs.limit(0), labels).count() == 0
    assert Q.quality_verdicts(odd_docs, labels).where("kept != (NOT base_failed)").count() == 0


def test_rules_are_tested_together():
    none = lambda *rows: tuple(map(Q.np.array, zip(*rows)))     # noqa: E731
    # Kinds of documents: cutoffs passed of two rules, good ones, bad ones. The first rule separates, the second is alike on both sides.
    passed, good, bad = none(([0, 0], 300, 0), ([2, 0], 0, 20))
    assert Q.joint_levels(passed, good, bad, [3, 3], 0.02, 0.05 / 4) == [2, 0]
    assert Q.joint_levels(passed, Q.np.array([217, 0]), bad, [3, 3], 0.02, 0.05 / 4) == [2, 0]
    assert Q.joint_levels(passed, Q.np.array([216, 0]), bad, [3, 3], 0.02, 0.05 / 4) == [0, 0]
    # Two rules that separate are used together; one that rejects good documents is set aside as far as it must be.
    passed, good, bad = none(([0, 0, 0], 800, 0), ([3, 0, 0], 0, 20), ([0, 3, 0], 0, 10), ([0, 0, 1], 100, 40), ([0, 0, 3], 0, 5))
    assert Q.joint_levels(passed, good, bad, [3, 3, 3], 0.02, 0.05 / 4) == [1, 1, 1]
    # Each alone would hold the risk, both together do not.
    passed, good, bad = none(([0, 0], 960, 0), ([1, 0], 12, 50), ([0, 1], 12, 40))
    assert sum(Q.joint_levels(passed, good, bad, [1, 1], 0.02, 0.2)) == 1
    assert Q.joint_levels(passed, good * 0, bad, [1, 1], 0.02, 0.05) == [0, 0]


def test_error_is_held():
    """Each rule rejects a bit more than half the risk of the good documents, so any two together, and one alone, exceed it."""
    rng, wrong, runs = Q.np.random.default_rng(5), 0, 600
    kinds = Q.np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 2, 0]])
    true = Q.np.array([0.936, 0.011, 0.011, 0.021, 0.021])
    for _ in range(runs):
        levels = Q.joint_levels(kinds, rng.multinomial(400, true), Q.np.array([0, 30, 20, 9, 25]), [2, 2, 2], 0.02, 0.1)
        hit = ((Q.np.array(levels) > 0) & (kinds > 2 - Q.np.array(levels))).any(axis=1)
        wrong += true[hit].sum() > 0.02
    assert wrong <= 0.1 * runs + 3 * math.sqrt(0.1 * 0.9 * runs)


def test_junk_of_a_small_language(spark):
    """Expected verdicts: all good documents are kept, separable junk goes in the large and in the small language."""
    docs = many(spark, [0.0] * 500 + [0.45] * 20).unionByName(
        many(spark, [0.0] * 300 + [0.45] * 20, "es").selectExpr("doc_id + 1000 AS doc_id", "text", "lang"))
    good = [*range(500), *range(1000, 1300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 0, 0) for i in [*range(500, 515), *range(1300, 1315)]],
                                   "doc_id bigint, quality int, toxic int")
    assert {r["doc_id"] for r in Q.quality_verdicts(docs, labels).where("kept").collect()} == set(good)


def _fixture():
    """Labelled documents of three languages: cutoffs can be certified in en (two rules), in de (one of two rules) and not in fr."""
    rows, labels = [], []

    def add(lang, n, body, quality):
        for i in range(n):
            doc = len(rows)
            rows.append((doc, body(doc), lang))
            if quality is not None:
                labels.append((doc, quality, 0))

    clean = lambda i: " ".join(f"wort{i}x{j}" for j in range(60))       # noqa: E731
    symbols = lambda i: clean(i) + " " + "#*" * (60 + i % 90)           # noqa: E731
    capitals = lambda i: clean(i).upper() if i % 2 else clean(i) + " " + "QX" * (300 + i % 50)      # noqa: E731
    add("en", 330, clean, 1), add("en", 40, symbols, 0), add("en", 25, capitals, 0), add("en", 20, symbols, None), add("en", 30, capitals, None)
    add("de", 300, clean, 1), add("de", 15, capitals, 1), add("de", 30, symbols, 0), add("de", 40, capitals, 0), add("de", 10, symbols, None)
    add("fr", 50, clean, 1), add("fr", 20, symbols, 0), add(None, 5, symbols, None), add("en", 5, lambda i: "short", None)
    return rows, labels


def test_sql_and_query_agree_where_cutoffs_are_certified(spark):
    rows, labels = _fixture()
    con = duckdb.connect()
    documents, known = pd.DataFrame(rows, columns=["doc_id", "text", "lang"]), pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"])
    con.register("documents", documents), con.register("labels", known)
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, base_failed, kept, n_symbols FROM ({SQL['op1_quality_rules']})").fetchall()}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"], r["n_symbols"]) for r in Q.quality_verdicts(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got == want
    rejected = {lang: sum(not got[d][0] and not got[d][1] for d, _, x in rows if x == lang) for lang in ("en", "de", "fr", None)}
    assert rejected["en"] == 40 + 25 + 20 + 30 and 30 <= rejected["de"] <= 30 + 10 and not rejected["fr"] and not rejected[None]
    good = {d for d, q, _ in labels if q == 1}
    assert all(got[d][1] for d in good) and sum(not got[d][1] for d, q, _ in labels if not q and rows[d][2] == "de") == 30


def test_sql_and_query_agree_on_many_mixtures(spark):
    """Shares at random around the cutoffs, so that sequences stop in different places."""
    pick = random.Random(3)
    for trial in range(3):
        rows, labels = [], []
        for doc in range(900):
            lang, good = pick.choice(["a", "b"]), pick.random() < 0.75
            words = [f"w{doc}y{j}" for j in range(50 + pick.randrange(30))]
            strength = 0 if good and pick.random() < 0.985 else pick.random()
            kind = pick.choice(["#", "X", "!", "line"])
            body = " ".join(words) + ("\nsame\n" * int(4 * strength) if kind == "line" else " " + kind * int(300 * strength))
            rows.append((doc, body, lang))
            labels.append((doc, int(good), 0))
        con = duckdb.connect()
        con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang"])), con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]))
        want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, kept FROM ({SQL['op1_quality_rules']})").fetchall()}
        frames = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert {r["doc_id"]: r["kept"] for r in Q.quality_verdicts(*frames).collect()} == want, trial


def _workers(df):
    """Python operators of the plan, each of which holds a worker of its own in a task."""
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_texts_are_measured_once_where_measures_decide(spark):
    docs = spark.createDataFrame([(i, text(i, 80), "en") for i in range(20)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    kept = Q.kept_documents(docs, labels)
    assert _workers(kept) == 1
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(20))
