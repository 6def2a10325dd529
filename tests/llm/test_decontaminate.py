import random
import re

import pytest

from plumbline.llm import decontaminate as D

from .conftest import text, words

ITEM = "item_id bigint, text string"


def normal(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items, width=10):
    windows = {}
    for item, t in items:
        w = normal(t)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, t in docs:
        w, hit, found = normal(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def cases():
    pick = random.Random(5)
    items = [(i, " ".join(words(i, n, 30))) for i, n in enumerate([25, 12, 10, 9, 3, 1, 40])]
    items += [(50, items[0][1].upper().replace(" ", "-- ")), (51, ""), (52, None), (None, " ".join(words(99, 15, 30))), (53, "Übung—macht Öl 日本 x"), (0, items[1][1])]
    docs = [(0, None), (1, ""), (2, "!!! ??"), (3, items[0][1]), (3, items[0][1]), (None, items[1][1] + " " + items[6][1])]
    for d in range(4, 40):
        parts = words(1000 + d, 60, 30)
        t = items[pick.choice([0, 1, 2, 3, 6])][1].split()
        at = pick.randrange(50)
        i = pick.randrange(len(t))
        parts[at:at] = t[i:i + pick.randrange(4, 20)]
        docs.append((d, pick.choice([" ", "\n", ", "]).join(parts)))
    docs.append((41, "übung—macht öl 日本 x " * 2))
    docs.append((42, text(7, 30_000, 30) + " " + items[0][1]))
    return docs, items


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 40])
def test_against_brute_force(spark, block_words):
    docs, items = cases()
    got = D.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM), block_words=block_words).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got], key=repr) == brute(docs, items)
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def test_long_items_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT_WORDS", 7)
    docs, items = cases()
    got = D.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEM)).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got], key=repr) == brute(docs, items)


def test_spans_and_documents(spark, docs):
    item = " ".join(f"q{i}" for i in range(12))
    table = docs([text(1, 30), f"before, {item.upper()}! after", f"{item}", None])
    bench = spark.createDataFrame([(1, item)], ITEM)
    assert sorted(r["doc_id"] for r in D.clean_documents(table, bench).collect()) == [0, 3]
    cut = {r["doc_id"]: r["text"] for r in D.clean_documents(table, bench, "spans").collect()}
    assert cut == {0: text(1, 30), 1: "before, ! after", 2: "", 3: None}
    with pytest.raises(ValueError):
        D.clean_documents(table, bench, "some")


def test_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, text(1, 80))], ITEM)
    for block_words in (D.BLOCK_WORDS, 10):
        assert D.contamination(odd_docs, bench, block_words=block_words).where("contaminated").count() == 3
        for how in ("documents", "spans"):
            kept = D.clean_documents(odd_docs, bench, how, block_words=block_words)
            assert kept.columns == odd_docs.columns and kept.count() == (6 if how == "documents" else 9)
    assert D.contamination(odd_docs.limit(0), bench).count() == 0
    assert D.contamination(odd_docs, bench.limit(0)).where("contaminated").count() == 0


def test_texts_are_scanned_once_where_hits_decide(spark):
    bench = spark.createDataFrame([(1, text(5, 20)), (2, text(6, 20))], ITEM)
    docs = spark.createDataFrame([(1, text(5, 30)), (2, text(7, 30))], "doc_id bigint, text string")
    for found in (D.scanned(docs, bench).where("size(found.starts) > 0").select("row.doc_id", "found"), D.clean_documents(docs, bench)):
        assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["doc_id"] for r in D.clean_documents(docs, bench).collect()] == [2]
