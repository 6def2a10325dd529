"""Byte-pair encoding of whole texts to token ids, and decoding, equal to the tokenizer library's.

A text is cut where no token can lie across: before a space between two visible characters, and around a line end between two.
What lies between cuts is looked up in a table of bounded size or encoded by the library in batches.

What the tokenizer itself does not split (a run of letters, digits, marks or spaces) can be as long as the text. It is encoded by
*tree concatenation*: its halves are encoded apart, down to leaves of ``LEAF`` bytes, and two encodings are put together by encoding
anew a window around the join, which grows until its outermost tokens are those that either side had there. A sequence of
byte-pair tokens is the encoding of its text if every two neighbours are; all neighbours lie in the left part, the window or the
right part, so the result is exact. Texts above ``LONG_TEXT`` bytes are cut into parts that different tasks encode, at a safe place
if there is one and within a run otherwise; one row per text then joins the parts the same way, as a balanced tree.

All this holds for byte-level tokenizers with the usual pattern and without a normaliser, which is checked when the tokenizer is
loaded; texts of any other tokenizer go to the library whole.

Defined cases: null and empty texts have no tokens and decode to an empty text. Special strings in a text are the library's default:
one token each. Rows are kept as they come, repeated ones and null ids too; other columns do not matter. An empty table gives an
empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.words import texts

LONG_TEXT = 1 << 20         # bytes above which a text is encoded in parts
PART_CHARS = 1 << 18        # of a part, at least
REACH = 1 << 12             # characters in which a safe place is looked for before a run is cut
LONG_PIECE = 1 << 12        # characters between cuts that are encoded as a tree of their unsplit runs
LEAF = 1 << 10              # bytes that are encoded at once there
WINDOW = 4                  # tokens on each side of a join, to begin with
BATCH_CHARS = 1 << 18       # given to the library at once
SOME_BYTES = 1 << 22        # of texts whose pieces are looked up together
OUT_BYTES = 1 << 23         # of ids that a task holds back
KNOWN_PIECES, KNOWN_CHARS = 200_000, 48     # a worker's table, and the longest piece in it

_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_SPACE = re.compile(r" (?<=\S )(?=\S)")
_RUN = regex.compile(r"\p{L}{8}|\p{N}{8}|\s{8}|[^\s\p{L}\p{N}']{8}")

Part = tuple[np.ndarray, int, int]      # ids, and how many of them the first and the last unsplit run have


def pieces_of(text: str) -> list[str]:
    """The text between the places where no token lies across."""
    out: list[str] = []
    for i, line in enumerate(_LINE.split(text)):
        if i:
            out.append("\n")
        first, *rest = _SPACE.split(line)
        out.append(first)
        out.extend([" " + p for p in rest])
    return out


class Codec:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        step, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        self.cuts = (spec.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex", True)
                     and not step.get("add_prefix_space") and (spec.get("decoder") or {}).get("type") == "ByteLevel"
                     and spec["model"]["type"] == "BPE" and not any(spec["model"].get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix"))
                     and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        if not self.cuts:
            return
        self.model = self.tokenizer.model
        self.special = {t["content"]: t["id"] for t in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.special_text = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        self.mapped = [""] * size           # a token's text as the vocabulary spells it, one character a byte
        for token, i in spec["model"]["vocab"].items():
            self.mapped[i] = token
        own = {c: b for b, c in byte_letters().items()}
        self.bytes = [bytes(own[c] for c in t) for t in self.mapped]
        for token, i in self.special.items():
            self.bytes[i] = token.encode()

    # Unsplit runs

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two texts put together, from theirs."""
        if not left or not right:
            return left + right
        k = WINDOW
        while True:
            a, b = left[-k:], right[:k]
            window = self.leaf("".join(map(self.mapped.__getitem__, a + b)))
            if (len(a) == len(left) or window[0] == a[0]) and (len(b) == len(right) or window[-1] == b[-1]):
                return left[:-k] + window + right[k:]
            k *= 2

    def leaf(self, run: str) -> list[int]:
        return [t.id for t in self.model.tokenize(run)]

    def tree(self, run: str) -> list[int]:
        if len(run) <= LEAF:
            return self.leaf(run)
        half = len(run) // 2
        return self.joined(self.tree(run[:half]), self.tree(run[half:]))

    def runs(self, piece: str) -> Iterator[list[int]]:
        """Ids of each unsplit run, or special string, of a piece."""
        for i, part in enumerate(self.special_text.split(piece) if self.special_text else [piece]):
            if i % 2:
                yield [self.special[part]]
            elif part:
                for run, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    yield self.tree(run)

    # Texts

    def _unknown(self, pieces: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        batch: list[str] = []
        size = 0

        def flush() -> None:
            for p, e in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)):
                found[p] = np.array(e.ids, "<u4").tobytes()
            batch.clear()

        for piece in pieces:
            if self.cuts and len(piece) > LONG_PIECE:
                found[piece] = np.array([i for run in self.runs(piece) for i in run], "<u4").tobytes()
                continue
            batch.append(piece)
            size += len(piece)
            if size >= BATCH_CHARS:
                flush()
                size = 0
        flush()
        return found

    def encode(self, some: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        if not self.cuts:
            found = self._unknown(list(dict.fromkeys(some)))
            return [found[t] for t in some]
        known = self.known
        for piece in [p for p in known if len(p) > KNOWN_CHARS] if len(known) <= KNOWN_PIECES else list(known):
            del known[piece]
        cut = [pieces_of(t) if t else [] for t in some]
        known.update(self._unknown(list({p for pieces in cut for p in pieces if p not in known})))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: np.ndarray) -> str:
        if not self.cuts:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        get = self.bytes.__getitem__
        parts = [b"".join(map(get, ids[i:i + (1 << 16)].tolist())) for i in range(0, len(ids), 1 << 16)]
        return (parts[0] if len(parts) == 1 else b"".join(parts)).decode("utf-8", "replace")

    # Parts of long texts

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """Consecutive parts of a text, each with whether the part before it ends within the run that this one begins with."""
        start, joins, at = 0, False, PART_CHARS
        while self.cuts and at < len(text):
            safe = _SPACE.search(text, at, min(at + REACH, len(text)))
            inside = None if safe else next((m.start() + 4 for m in _RUN.finditer(text, at, min(at + REACH, len(text)))
                                             if not self._special_across(text, m.start() + 4)), None)
            if safe is None and inside is None:
                at += REACH
                continue
            cut = safe.start() if safe else inside
            yield joins, text[start:cut]
            start, joins, at = cut, safe is None, cut + PART_CHARS
        yield joins, text[start:]

    def _special_across(self, text: str, cut: int) -> bool:
        return any(text.find(s, max(cut - len(s) + 1, 0), cut + len(s) - 1) >= 0 for s in self.special)

    def part(self, text: str) -> Part:
        ids = np.frombuffer(self.encode([text])[0], "<u4")
        if not self.cuts or not len(ids):
            return ids, len(ids), len(ids)
        pieces = pieces_of(text)
        last = None
        for last in self.runs(pieces[-1]):
            pass
        return ids, len(next(self.runs(pieces[0]))), len(last)

    def concatenated(self, parts: list[tuple[bool, Part]]) -> tuple[bool, Part]:
        """The parts of a text as one, by a balanced tree."""
        if len(parts) == 1:
            return parts[0]
        (joins, (a, a_first, a_last)), (within, (b, b_first, b_last)) = \
            self.concatenated(parts[:len(parts) // 2]), self.concatenated(parts[len(parts) // 2:])
        if not within or not len(a) or not len(b):
            return joins, (np.concatenate((a, b)), a_first if len(a) else b_first, b_last if len(b) else a_last)
        middle = np.array(self.joined(a[len(a) - a_last:].tolist(), b[:b_first].tolist()), "<u4")
        return joins, (np.concatenate((a[:len(a) - a_last], middle, b[b_first:])), a_first if a_first < len(a) else len(middle),
                       b_last if b_last < len(b) else len(middle))


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _bounded(rows: Iterator[tuple], names: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose last column holds at most about ``OUT_BYTES`` bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 64
        if size >= OUT_BYTES:
            yield _batch(held, names)
            held, size = [], 0
    if held:
        yield _batch(held, names)


def _batch(rows: list[tuple], names: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(names)], [name for name, _ in names])


def encoded(docs: DataFrame, tokenizer: str, decode: bool = False) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids (little-endian 32-bit integers). ``tokenizer``: path of a file that every executor has. With
    ``decode`` also ``text``, what the ids decode to, by the same worker."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    long = F.octet_length("text") > LONG_TEXT
    whole = [("doc_id", pa.int64()), ("copies", pa.int64()), ("ids", pa.binary()), *([("text", pa.string())] if decode else [])]
    schema = "doc_id long, copies long, ids binary" + (", text string" if decode else "")
    part = [("doc_id", pa.int64()), ("digest", pa.binary()), ("number", pa.int32()), ("joins", pa.bool_())]

    def row(own: Codec, name: int | None, copies: int, ids: bytes) -> tuple:
        return (name, copies, ids, own.decode(np.frombuffer(ids, "<u4"))) if decode else (name, copies, ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)

        def out() -> Iterator[tuple]:
            for batch in batches:
                some: list[str] = []
                names: list = []
                size = 0
                for doc, text in zip(batch.column(0), texts(batch.column(1))):
                    names.append(doc.as_py())
                    some.append(text.decode("utf-8", "replace"))
                    size += len(text)
                    if size >= SOME_BYTES:
                        yield from (row(own, n, 1, ids) for n, ids in zip(names, own.encode(some)))
                        some, names, size = [], [], 0
                yield from (row(own, n, 1, ids) for n, ids in zip(names, own.encode(some)))

        yield from _bounded(out(), whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        yield from _bounded(((doc.as_py(), digest.as_py(), i, joins, piece) for batch in batches
                             for doc, digest, text in zip(batch.column(0), batch.column(1), texts(batch.column(2)))
                             for i, (joins, piece) in enumerate(own.parts(text.decode("utf-8", "replace")))), [*part, ("part", pa.string())])

    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)

        def out() -> Iterator[tuple]:
            for batch in batches:
                for doc, digest, number, joins, text in zip(*batch.columns[:4], texts(batch.column(4))):
                    ids, first, last = own.part(text.decode("utf-8", "replace"))
                    yield doc.as_py(), digest.as_py(), number.as_py(), joins.as_py(), None, first, last, ids.tobytes()

        yield from _bounded(out(), [*part, ("copies", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("ids", pa.binary())])

    def concatenate(table: pa.Table) -> pa.Table:
        found = sorted(table.select(["number", "joins", "copies", "first", "last", "ids"]).to_pylist(), key=lambda r: r["number"])
        parts = [(r["joins"], (np.frombuffer(r["ids"], "<u4"), r["first"], r["last"])) for r in found[1:]]
        own = codec(tokenizer)
        ids = own.concatenated(parts)[1][0].tobytes()
        return pa.Table.from_batches([_batch([row(own, table.column("doc_id")[0].as_py(), found[0]["copies"], ids)], whole)])

    short = rows.where(~long).mapInArrow(encode, schema)
    keyed = rows.where(long).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    # A row repeated in full is cut and encoded once; how often it is there comes with number -1.
    copies = keyed.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")) \
        .select("doc_id", "digest", F.lit(-1).alias("number"), F.lit(False).alias("joins"), "copies", F.lit(0).cast("long").alias("first"),
                F.lit(0).cast("long").alias("last"), F.lit(b"").alias("ids"))
    parts = keyed.mapInArrow(cut, "doc_id long, digest binary, number int, joins boolean, part string") \
        .dropDuplicates(["doc_id", "digest", "number"]) \
        .mapInArrow(encode_part, "doc_id long, digest binary, number int, joins boolean, copies long, first long, last long, ids binary")
    longer = parts.unionByName(copies).groupBy("doc_id", "digest").applyInArrow(concatenate, schema)
    longer = longer.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return short.unionByName(longer).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", *(["text"] if decode else []))


def decoded(ids: Column | str, tokenizer: str) -> Column:
    """Text of a column of little-endian 32-bit ids, special tokens included."""

    @F.arrow_udf("string")
    def decode(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(tokenizer)
        for batch in column:
            yield pa.array([own.decode(np.frombuffer(v.as_py() or b"", "<u4")) for v in batch], pa.string())

    return decode(ids)
