import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import ngram_join as J
from plumbline.llm.components import components

from .conftest import text, words


def shingles(t, width=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\x1c", "\x1c")
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", w)]
    if not w:
        return frozenset()
    n = min(width, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[top(i)] = min(low.get(top(i), doc), doc)
    return sorted(((doc, len(s), low.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def edited(base, seed, share):
    pick = random.Random(seed)
    return " ".join(f"e{seed}x{i}" if pick.random() < share else w for i, w in enumerate(base.split()))


def families(seed):
    """Chains and stars of copies at all distances, and a passage that unrelated documents share."""
    pick = random.Random(seed)
    rows = []
    passage = text(f"p{seed}", 60, 10_000)
    for f in range(25):
        base = text(f"{seed}-{f}", pick.choice([3, 5, 6, 9, 20, 60, 120]), 10_000)
        rows.append(base)
        for c in range(pick.randrange(7)):
            base = edited(base if pick.random() < 0.6 else rows[-1], seed * 1000 + f * 10 + c, pick.choice([0, 0.01, 0.03, 0.05, 0.08]))
            rows.append(base)
    rows += [passage + " " + text(f"o{seed}{i}", n, 10_000) for i, n in enumerate([0, 5, 10, 20, 30, 60, 200, 12, 14, 16, 18, 20])]
    rows += [rows[0]] * 5 + ["", None, " \n", "A b", "a B", "a b c"]
    pick.shuffle(rows)
    return rows


def result(df):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.similar_classes(df).collect()], key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(docs, seed, monkeypatch):
    if seed % 2:        # few frequent n-grams, small chunks, parts and blocks at this size too
        monkeypatch.setattr(J, "FREQUENT", 40)
        monkeypatch.setattr(J, "LEADER_NODES", 2)
        monkeypatch.setattr(J, "BLOCK_NODES", 3)
        monkeypatch.setattr(J, "PART_NGRAMS", 100)
        monkeypatch.setattr(J, "CHUNK_NGRAMS", 500)
        monkeypatch.setattr(J, "DENSE_PAIRS", 1)
        monkeypatch.setattr(J, "BROADCAST_NODES", 0)
    rows = list(enumerate(families(seed)))
    assert result(docs(rows).repartition(3)) == brute(rows)


@pytest.mark.parametrize("nodes", [J.BLOCK_NODES, 2])
def test_links_that_no_leader_has(docs, monkeypatch, nodes):
    """Neighbours in a chain are similar, its ends are not; the documents' order does not follow the chain."""
    base = words("chain", 100, 10_000)
    chain = []
    for i in range(30):
        base = base[3:] + words(f"c{i}", 3, 10_000)
        chain.append(" ".join(base))
    monkeypatch.setattr(J, "BLOCK_NODES", nodes)
    random.Random(3).shuffle(chain)
    rows = list(enumerate(chain))
    assert result(docs(rows)) == brute(rows) and len({r[2] for r in brute(rows)}) == 1


@pytest.mark.parametrize("order", [(), (3, 8, 9)])
def test_traversal(order):
    pick = random.Random(1)
    own = J.Order(np.array(order, np.uint64), np.arange(len(order)) + 2)
    sets = [np.array(sorted(pick.sample(range(40), pick.randrange(1, 30))), np.uint64) for _ in range(300)]
    ordered = sorted((own.apply(s) for s in sets), key=lambda s: s.astype(">u8").tobytes())
    for q in sets[:40]:
        traversal = J.Traversal(own.apply(q), 75)
        for s in ordered:
            common = len(set(q.tolist()) & set(s.tolist()))
            assert traversal.similar(s) == (100 * common >= 75 * (len(q) + len(s) - common))


@pytest.mark.parametrize("n", range(1, 60))
def test_prefixes_of_similar_sets_meet(n):
    """The prefix misses fewer n-grams than the overlap has at least."""
    assert n - J.prefix_length(n) < -(-75 * n // 100) and J.prefix_length(n) >= 1


@pytest.mark.parametrize("n", [2, 3, 48, 1000, 2 ** 20, 2 ** 33])
def test_slices(n):
    pick = random.Random(n)
    tokens = np.array(sorted([0, 1, 2 ** 64 - 1, 2 ** 63] + [pick.randrange(2 ** 64) for _ in range(500)]), np.uint64)
    ranges, heads = J.Slices(n).cut(tokens)
    assert ranges.min() >= 0 and ranges.max() < n and (np.diff(ranges) >= 0).all()
    same = ranges[1:] == ranges[:-1]
    assert (heads[1:][same].astype(np.int64) >= heads[:-1][same]).all()


def test_components(spark):
    pick = random.Random(2)
    edges = [(f"{pick.randrange(300):03d}", f"{pick.randrange(300):03d}") for _ in range(200)] + [(f"9{i:02d}", f"9{i + 1:02d}") for i in range(90)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        return x if root[x] == x else top(root[x])

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_rounds_of_components_shrink(spark, monkeypatch):
    """Chains whose ends meet late: every round goes on with fewer nodes, so all that is written stays within a few times the edges."""
    import plumbline.llm.components as C

    written, stage = [], C.staged

    def counted(df):
        out = stage(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(C, "staged", counted)
    names = random.Random(3).sample(range(10_000), 800)
    edges = list(zip(names, names[1:])) + [(names[0], names[0]), (20_000, 20_000), (30_000, 30_001), (30_001, 30_000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(names) for x in names} | {20_000: 20_000, 30_000: 30_000, 30_001: 30_000}
    assert sum(written) <= 12 * len(edges)


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert result(odd_docs) == brute(rows)
    assert result(odd_docs.limit(0)) == []
    kept = J.representatives(odd_docs)
    # Of documents 1, 1 and 6, which are equal, one row stays; every document without words does.
    assert kept.columns == odd_docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None", "None"]
    assert J.representatives(odd_docs.limit(0)).count() == 0


def test_representatives(docs):
    table = docs([(7, text(1, 60)), (3, text(1, 60)), (9, text(1, 60) + " one more"), (4, text(2, 60))])
    assert sorted(r["doc_id"] for r in J.representatives(table).collect()) == [3, 4]
    assert J.similar_classes(table).where(F.col("component_id") == 3).count() == 3
