import hashlib
import itertools
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import alignment as L
from tests.llm.conftest import text

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PIECES = ["a", "Zeit", "'s", "don't", " ", "  ", "\n", "\n\n ", "\t", "\xa0", "12", "é", "日本語", "!!", "<|endoftext|>", "<s>", "\r\n", "x1y2", "_", "\U0001f600", "ﬁ",
          "\x0b", "ab cd", ".\nNew", "\n's", "antidisestablishment", " Übergrößenträger", "\x00"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def ends(tokens):
    return itertools.accumulate(map(len, tokens))


def aligned(tokenizers, body):
    """n_a, n_b, n_groups, n_links, groups, linked pairs with occurrences, by comparing all byte ranges."""
    a, b = tokenizers
    if not body:
        return 0, 0, 0, 0, "", {}
    own = {c: i for i, c in L.byte_letters().items()}
    ids_a, ids_b = a.encode(" " + body, add_special_tokens=False).ids, b.encode(body)
    bytes_a = [bytes(own[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + body).encode():
        return 0, 0, 0, 0, "", {}
    # Which token of either tokenizer each byte belongs to, and the pairs of those.
    own_a, own_b = ([i for i, t in enumerate(tokens) for _ in t] for tokens in (bytes_a, bytes_b))
    groups, links = [], {}
    for i, j in sorted(set(zip(own_a, own_b))):
        links[ids_a[i], ids_b[j]] = links.get((ids_a[i], ids_b[j]), 0) + 1
    cuts = sorted(set(ends(bytes_a)) & set(ends(bytes_b)))
    start = 0
    for cut in cuts:
        groups.append("|".join(",".join(str(ids[i]) for i in sorted(set(own[start:cut]))) for ids, own in ((ids_a, own_a), (ids_b, own_b))))
        start = cut
    return len(ids_a), len(ids_b), len(groups), sum(links.values()), ";".join(groups), links


def expected(tokenizers, rows):
    found = [(doc, aligned(tokenizers, body)) for doc, body in rows]
    counts, best = {}, {}
    for _, f in found:
        for pair in f[5]:
            counts[pair] = counts.get(pair, 0) + 1
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    return sorted((str(doc), *f[:4], sum(n for p, n in f[5].items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in f[5].items()), f[4]) for doc, f in found)


def checked(tokenizers, frame):
    out = L.scored(L.alignments(frame, A, B)).collect()
    got = sorted((str(r["doc_id"]), r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in out)
    assert got == expected(tokenizers, [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()])
    return got


@pytest.mark.parametrize("seed", range(40))
def test_words_give_the_alignment_of_the_whole(tokenizers, seed):
    own, pick = L.aligner(A, B), random.Random(seed)
    assert own.cuts
    bodies = ["".join(pick.choice(PIECES) for _ in range(pick.randrange(60))) for _ in range(6)] + ["x▁y z", "▁", " ", "\n", "a", " lead", "trail ", "a▁ b c d"]
    for body, got in zip(bodies, pa.table(own.align(bodies)).to_pylist(), strict=True):
        n_a, n_b, n_groups, n_links, groups, links = aligned(tokenizers, body)
        assert (got["n_a"], got["n_b"], got["n_groups"], got["n_links"], got["groups"]) == (n_a, n_b, n_groups, n_links, groups)
        same = {(i, j): n for (i, j), n in links.items() if own.identity[i] == j}
        assert dict(zip(got["same"], got["same_links"])) == {i: n for (i, _), n in same.items()}
        assert {(i, j): n for i, j, n in zip(got["a"], got["b"], got["links"])} == {p: n for p, n in links.items() if p not in same}


def test_counts_against_brute_force(tokenizers, docs):
    pick = random.Random(5)
    bodies = ["".join(pick.choice(PIECES) for _ in range(40)) for _ in range(30)] + [text(i, 60) for i in range(10)] + [text(1, 60)] * 5 + [None, "", "bad▁mark"]
    assert sum(r[1] > 0 for r in checked(tokenizers, docs(bodies))) > 40


@pytest.mark.parametrize("frequent", [0, 20])
def test_rare_pairs_are_joined(tokenizers, docs, monkeypatch, frequent):
    monkeypatch.setattr(L, "FREQUENT_PAIRS", frequent)
    pick = random.Random(6)
    bodies = ["".join(pick.choice(PIECES) for _ in range(40)) for _ in range(20)] + ["antidisestablishment Übergrößenträger"] * 30
    checked(tokenizers, docs(bodies))


def test_pair_may_be_linked_inside_and_outside_groups_of_one(tokenizers, docs):
    checked(tokenizers, docs(["aaaaaaa aa a", "hellohello hell o", "....... .. ."]))


def test_small_tables_of_known_words(tokenizers, docs, monkeypatch):
    monkeypatch.setattr(L, "KNOWN_WORDS", 5)
    monkeypatch.setattr(L, "CHUNK_CHARS", 20)
    own = L.Aligner(A, B)
    for i in range(10):
        body = f"some words {i} {i + 1}\n{'z' * 50} ▁ x"
        assert own.align([body])["n_a"].to_pylist() == [0] and own.align([body[:-3]])["groups"].to_pylist() == [aligned(tokenizers, body[:-3])[4]]
        assert len(own.known) <= 5 + 8
    checked(tokenizers, docs([text(i, 40) for i in range(20)]))


def test_tokenizer_that_cannot_be_cut(tokenizers):
    own = L.Aligner(A, B)
    own.cuts = False
    bodies = ["one two\nthree  ", " x", "▁", "", "a"]
    assert own.align(bodies)["groups"].to_pylist() == [aligned(tokenizers, t)[4] for t in bodies]


def test_odd_rows(tokenizers, odd_docs):
    assert len(checked(tokenizers, odd_docs)) == 9
    empty = odd_docs.limit(0)
    assert L.scored(L.alignments(empty, A, B)).count() == 0


def test_digest_column_passes_through(docs):
    found = L.alignments(docs(["one two", None]), A, B).withColumn("d", F.sha2("groups", 256)).drop("groups")
    rows = {r["doc_id"]: r["d"] for r in L.scored(found).collect()}
    assert rows[1] == hashlib.sha256(b"").hexdigest() and set(L.scored(found).columns) == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "d", "n_best", "count_sum"}
