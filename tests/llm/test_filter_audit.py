import re
from itertools import permutations

import pytest

from plumbline.llm import filter_audit as A
from tests.llm.conftest import text

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """Every document through every order, one filter after the other."""
    smallest = {}
    for doc, body, _ in rows:
        if doc is not None:
            smallest[body or ""] = min(doc, smallest.get(body or "", doc))
    good, toxic = ({d for d, q, t in labels if (q, t)[i] == 1 and d is not None} for i in (0, 1))
    found = []
    for doc, body, lang in rows:
        body = body or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", body)) > 10 * len(body),
                 "D": bool(re.search("[#$%&*|]", body)), "E": doc is not None and smallest[body] < doc}
        found.append((doc, lang or "", {f for f, x in fails.items() if x}))
    out = {}
    for part in {p for _, p, _ in found}:
        docs = [(d, f) for d, p, f in found if p == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d, fails in left if f in fails]
                left = [(d, fails) for d, fails in left if f not in fails]
                removed_by[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in fails for _, fails in docs) - len(gone), sum(fails == {f} for _, fails in docs),
                                          sum(d in good for d in gone), sum(d in toxic for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    rows = A.document_audit(docs, labels).collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}
    assert len(got) == len(rows)
    return got


def checked(spark, docs, labels):
    got = audited(docs, spark.createDataFrame(labels, LABELS))
    assert got == brute([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], labels)
    return got


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_intervals_cover_each_order_of_a_mask_once(n):
    orders = list(permutations(range(n)))
    for mask in range(1, 1 << n):
        at = sorted((a, b, step, f) for m, step, f, a, b in A.intervals(n) if m == mask)
        assert [a for a, _, _, _ in at] == [0, *[b for _, b, _, _ in at][:-1]] and at[-1][1] == len(orders)
        for a, b, step, f in at:
            for order in orders[a:b]:
                assert order[step - 1] == f and next(i for i, x in enumerate(order) if mask >> x & 1) == step - 1


def test_every_mask_against_brute_force(spark):
    rows, labels = [], []
    bodies = [text(i, n, v) + tail for i, (n, v) in enumerate([(40, 9999), (200, 9999), (120, 20), (90, 10)]) for tail in ("", " #", " AAAA" * 90, " $ " + "B" * 900)]
    for i, body in enumerate(bodies * 3):
        rows.append((500 - i if i % 5 else i, body, ["en", "de", None, ""][i % 4]))
        labels.append((rows[-1][0], i % 2, int(i % 7 == 0)))
    labels += [(1, 1, 1), (1, 0, None), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(d, t, lang, "s", None) for d, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = checked(spark, docs, labels)
    assert len(got) == 3 * 600 and sum(v[1] for v in got.values()) > 0


def test_hot_text_null_ids_and_repeated_rows(spark, docs):
    frame = docs([(None, "same")] * 5 + [(7, "same")] * 3 + [(i, "same") for i in range(8, 60)] + [(3, None), (2, ""), (None, None)])
    got = checked(spark, frame, [(7, 1, 0), (9, 1, 1), (9, None, None)])
    assert got["en", "EABCD", 1][1] == 52 + 1


def test_odd_rows(spark, odd_docs):
    checked(spark, odd_docs, [(1, 1, 0), (5, None, 1), (None, 1, 1)])
    assert audited(odd_docs.limit(0), spark.createDataFrame([], LABELS)) == {}


def test_counts_are_few_rows_for_many_copies(spark, docs):
    counts = A.failure_counts(docs([(i, text(i % 3, 150)) for i in range(300)]), spark.createDataFrame([], LABELS))
    assert counts.count() <= 32 and counts.groupBy().sum("docs").first()[0] == 300
