"""Token counts of whole texts, without the tokens.

Texts are counted in Arrow batches. A text is cut where no token can lie across: before a space that a visible
character follows (a pattern that lets a space only lead a token starts anew there, and no special string holds a space)
and, in a run without spaces that is very long, between an ASCII letter and an ASCII digit. Pieces already counted by
this worker are looked up in a table of bounded size; the others go to the tokenizer in batches of about equal bytes.
The counts equal those of the uncut text for byte-level tokenizers of this pattern without a prefix space, which is checked
when the tokenizer is loaded; any other tokenizer gets the uncut texts, again in batches balanced by bytes.

Defined cases: null and empty texts have 0 tokens. Each row is counted by itself: ids, repeated rows and other columns
do not matter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.llm.words import texts

BATCH_BYTES = 1 << 18       # of texts given to the tokenizer at once
SLICE_CHARS = 1 << 20       # of a long text that are cut into pieces at once
LONG_PIECE = 1 << 16        # a piece without spaces beyond this is cut between letters and digits
KNOWN_PIECES = 300_000      # in a worker's table
KNOWN_CHARS = 48            # longest piece that the table holds

_BEFORE_WORD = re.compile(r" (?=\S)")
_LETTER_DIGIT = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


class Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            pre = json.load(f)
        step, added = pre.get("pre_tokenizer") or {}, pre.get("added_tokens", [])
        self.cuts = (pre.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex", True)
                     and not step.get("add_prefix_space") and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"]
                                                                      or t["single_word"] for t in added))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def encoded(self, pieces: list[str]) -> list[int]:
        """Lengths of pieces, encoded in batches of about equal bytes."""
        lengths: list[int] = []
        batch: list[str] = []
        size = 0
        for piece in pieces:
            batch.append(piece)
            size += len(piece.encode("utf-8", "replace"))
            if size >= BATCH_BYTES:
                lengths += map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))
                batch, size = [], 0
        return lengths + [len(e) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def slices(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SLICE_CHARS and (cut := _BEFORE_WORD.search(text, start + SLICE_CHARS)):
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def count(self, batch: list[str]) -> list[int]:
        if not self.cuts:
            return self.encoded(batch)
        totals = [0] * len(batch)
        unknown: dict[str, int] = {}
        waiting: list[tuple[int, list[str]]] = []
        known = self.known
        for i, text in enumerate(batch):
            for part in self.slices(text):
                first, *rest = _BEFORE_WORD.split(part)
                pieces = [first, *[" " + p for p in rest]] if first else [" " + p for p in rest]
                if len(part) > LONG_PIECE and max(map(len, pieces), default=0) > LONG_PIECE:
                    pieces = [q for p in pieces for q in (_LETTER_DIGIT.split(p) if len(p) > LONG_PIECE else (p,))]
                counts = [known.get(p) for p in pieces]
                if None in counts:
                    missing = [p for p, c in zip(pieces, counts) if c is None]
                    unknown.update(dict.fromkeys(missing, 0))
                    waiting.append((i, missing))
                    totals[i] += sum(c for c in counts if c is not None)
                else:
                    totals[i] += sum(counts)
        if unknown:
            unknown = dict(zip(unknown, self.encoded(list(unknown))))
            for i, missing in waiting:
                totals[i] += sum(map(unknown.__getitem__, missing))
            if len(known) + len(unknown) > KNOWN_PIECES:
                known.clear()
            known.update((p, c) for p, c in unknown.items() if len(p) <= KNOWN_CHARS)
        return totals


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column | str, tokenizer: str) -> Column:
    """Number of tokens of a text column; ``tokenizer``: path of a tokenizer file that every executor has."""

    @F.arrow_udf("bigint")
    def count(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(tokenizer)
        for batch in column:
            totals: list[int] = []
            some: list[str] = []
            size = 0
            for text in texts(batch):
                some.append(text.decode("utf-8", "replace"))
                size += len(text)
                if size >= 4 * SLICE_CHARS:
                    totals += own.count(some)
                    some, size = [], 0
            yield pa.array(np.array(totals + own.count(some), np.int64))

    return count(text)
