import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import bpe_codec as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "Zeit", "'s", "'", "don't", " ", "  ", "\n", "\n\n ", "\t", "\xa0", " ", "\x1c", "12", "é", "日本語", "!!", "<|endoftext|>", "<|endo", " <|endoftext|> ",
          "\r\n", "x1y2", "_", "\U0001f600", "ﬁ", " 'll", "\x0b", "ab cd", ".\nNew", "\n'll"]
RUNS = ["aaaaaaaaaa", "banana", "thethethe", "ing", "        ", "1234567890", "........", "====", "éàü", "日本語日本語"]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    return lambda s: t.encode(s, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    return C.Codec(PATH)


def some(seed, parts=PIECES, n=120):
    pick = random.Random(seed)
    return "".join(pick.choice(parts) for _ in range(pick.randrange(n)))


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("seed", range(30))
def test_ids_and_texts_equal_the_library(whole, own, seed, monkeypatch):
    monkeypatch.setattr(C, "LONG_PIECE", 12)
    monkeypatch.setattr(C, "LEAF", 8)
    monkeypatch.setattr(C, "BATCH_CHARS", 50)
    own.known.clear()
    batch = [some(seed * 100 + i) for i in range(10)] + ["", " ", "\n", "a\nb", "a\n", "\na"]
    for _ in range(2):      # the second time from the table
        assert [ids_of(x) for x in own.encode(batch)] == [whole(s) for s in batch]
    library = Tokenizer.from_file(PATH)
    assert [own.decode(np.array(whole(s), "<u4")) for s in batch] == [library.decode(whole(s), skip_special_tokens=False) for s in batch] == batch


@pytest.mark.parametrize("seed", range(60))
def test_tree_gives_the_encoding_of_an_unsplit_run(whole, own, seed, monkeypatch):
    monkeypatch.setattr(C, "LEAF", 4 + seed % 13)
    monkeypatch.setattr(C, "WINDOW", 1)
    pick = random.Random(seed)
    run = "".join(pick.choice(["a", "b", "an", "the", "ing", "qu", "zz", "A", "aaa", "er", "tion"]) for _ in range(300))
    assert [i for r in own.runs(run) for i in r] == whole(run)
    assert own.tree("a" * 1000) == whole("a" * 1000)
    assert own.tree("=" * 777) == whole("=" * 777)


@pytest.mark.parametrize("seed", range(60))
def test_parts_give_the_encoding_of_the_whole(whole, own, seed, monkeypatch):
    monkeypatch.setattr(C, "PART_CHARS", 9 + seed % 30)
    monkeypatch.setattr(C, "REACH", 12)
    text = some(seed, PIECES + RUNS * 4, 100)
    parts = list(own.parts(text))
    assert "".join(p for _, p in parts) == text
    got = own.concatenated([(joins, own.part(p)) for joins, p in parts])[1][0]
    assert got.tolist() == whole(text)


def test_some_parts_end_within_a_run(own, monkeypatch):
    monkeypatch.setattr(C, "PART_CHARS", 10)
    assert sum(joins for joins, _ in own.parts("x" * 100)) > 3
    assert not any("<|endo" in p[-9:] and not p.endswith(">") for _, p in list(own.parts("<|endoftext|>" * 40))[:-1])


def test_other_tokenizer_goes_to_the_library_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, t = C.Codec(path), Tokenizer.from_file(path)
    batch = ["Hello  World 12ab", "", "x y", "x y"]
    expected = [t.encode(s, add_special_tokens=False).ids for s in batch]
    assert not own.cuts and [ids_of(x) for x in own.encode(batch)] == expected
    assert [own.decode(np.array(i, "<u4")) for i in expected] == [t.decode(i, skip_special_tokens=False) for i in expected]
    assert list(own.parts("a b " * 10)) == [(False, "a b " * 10)]


def test_known_pieces_are_bounded(own, monkeypatch):
    monkeypatch.setattr(C, "KNOWN_PIECES", 10)
    own.known.clear()
    for i in range(8):
        own.encode([f"a{i} b{i} c{i}", f"d{i} e{i}", "y" * 60])
        assert len(own.known) <= 10 + 7
    own.encode(["z"])
    assert not any(len(p) > 48 for p in own.known)


def checked(frame, whole):
    out = C.encoded(frame, PATH, decode=True).withColumn("again", C.decoded("ids", PATH)).collect()
    assert all(r["again"] == r["text"] for r in out)
    got = sorted((str(r["doc_id"]), r["n_tokens"], ids_of(r["ids"]), r["text"]) for r in out)
    assert got == sorted((str(r["doc_id"]), len(whole(r["text"] or "")), whole(r["text"] or ""), r["text"] or "") for r in frame.collect())
    return got


def test_odd_rows(odd_docs, whole):
    assert len(checked(odd_docs, whole)) == 9
    assert C.encoded(odd_docs.limit(0), PATH).count() == 0


def test_long_texts_in_parts(spark, docs, whole, monkeypatch):
    monkeypatch.setattr(C, "LONG_TEXT", 100_000)
    run = "".join(random.Random(1).choice("abcdefgh") for _ in range(600_000))
    spaced = " ".join(["word"] * 120_000)
    frame = docs([(1, run), (1, run), (2, spaced), (None, spaced), (3, "short"), (4, None), (5, "x" + run[:100_000] + " " * 300_000 + "7" * 200_000)])
    assert frame.where(F.octet_length("text") > C.LONG_TEXT).count() == 5 and C.PART_CHARS < 300_000
    checked(frame, whole)
