import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "Zeit", "'s", "'", "don't", " ", "  ", "\n", "\n\n ", "\t", " ", " ", "\x1c", "12", "é", "日本語", "!!", "<|endoftext|>", "<|endo", " <|endoftext|> ",
          "\r\n", "x1y2", "_", "\U0001f600", "ﬁ", " 'll", "\x0b", "ab cd"]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(40))
def test_pieces_give_the_count_of_the_whole(whole, seed, monkeypatch):
    monkeypatch.setattr(C, "SLICE_CHARS", 60)
    monkeypatch.setattr(C, "LONG_PIECE", 20)
    monkeypatch.setattr(C, "BATCH_BYTES", 50)
    pick = random.Random(seed)
    some = ["".join(pick.choice(PIECES) for _ in range(pick.randrange(120))) for _ in range(10)]
    some += ["".join(pick.choice("aB1 2'") for _ in range(200)), "", " ", "   a"]
    counter = C.Counter(PATH)
    assert counter.cuts
    assert counter.count(some) == [whole(s) for s in some] == counter.count(some)


def test_other_tokenizer_is_not_cut():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, t = C.Counter(path), Tokenizer.from_file(path)
    some = ["Hello  World 12ab", "", "x y"]
    assert not own.cuts and own.count(some) == [len(t.encode(s, add_special_tokens=False).ids) for s in some]


def test_known_pieces_are_bounded(whole, monkeypatch):
    monkeypatch.setattr(C, "KNOWN_PIECES", 10)
    own = C.Counter(PATH)
    for i in range(5):
        own.count([f"a{i} b{i} c{i}", f"d{i} e{i}"])
    assert len(own.known) <= 10


def test_odd_rows(spark, odd_docs, whole):
    rows = odd_docs.select("doc_id", "text", C.token_count(F.col("text"), PATH).alias("n")).collect()
    assert len(rows) == 9 and all(r["n"] == whole(r["text"] or "") for r in rows)
    assert odd_docs.limit(0).select(C.token_count(F.col("text"), PATH)).count() == 0
