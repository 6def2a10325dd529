"""Alignment of the tokens of two tokenizers over the same texts, and how often their ids meet.

Both tokenizers cut a text into tokens; where tokens of both end at the same byte, a group ends. Within a group every two tokens that
overlap are linked. A text is cut first at places where a token of either ends for certain: before a space, or a line end, between two
visible characters. The ids of what lies between (a word) are looked up in a table of bounded size; unknown words are encoded
many at once. Groups and links of about a megabyte of texts are then found together, by merging the ends of all tokens.

Counting pairs of ids over all documents takes an *identity map*: for each id of the first tokenizer the id of the second with the same bytes.
Groups of one token each hold such a pair, and most groups do. Each task counts the documents of those pairs in a vector as long as
the vocabulary; only other pairs are counted by a shuffle, combined over many documents before it.

The counts then go back to the documents' links: those of identity pairs as a vector, those of the most frequent other pairs (at
most ``FREQUENT_PAIRS``) as sorted arrays, both broadcast. Where there are more pairs than that, rarer ones are joined by a shuffle; each
is in fewer documents than any frequent one, so none is hot.

Defined cases: null and empty texts, and texts whose tokens of either tokenizer do not spell the text, have no tokens and no links. Rows are
kept as they come, repeated ones and null ids too, and each counts as a document; other columns do not matter. An empty table gives
an empty result. Tokenizers that may hold a token across such places align every text as one word, with equal results.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.bpe_codec import byte_letters
from plumbline.llm.shared import staged
from plumbline.llm.words import texts

FREQUENT_PAIRS = 1 << 20            # pairs, of 24 bytes, whose counts are broadcast
KNOWN_WORDS, KNOWN_CHARS = 300_000, 40     # a worker's table, and the longest word in it
SOME_BYTES = 1 << 20                # of texts that are aligned together
CHUNK_CHARS = 1 << 13               # of unknown words that are encoded as one text
CHUNK_PAIRS = 1 << 20               # pairs that are combined before the shuffle

_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_SPACE = re.compile(r" (?<=\S )(?=\S)")
_FIRST, _SECOND = itemgetter(0), itemgetter(1)

Ids = tuple[bytes, bytes]           # of either tokenizer, little-endian 32 bits


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        step = spec.get("pre_tokenizer") or {}
        if step.get("type") != "ByteLevel":
            raise ValueError(f"{path_a} is no byte-level tokenizer")
        own = {c: b for b, c in byte_letters().items()}
        vocabulary = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(own.get(c, 0) for c in token)
        plain = spec.get("normalizer") is None and step.get("use_regex", True) and not step.get("add_prefix_space")
        self.encode_a = self._encoder(path_a, spec, plain)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        same: dict[bytes, int] = {}
        for i in range(len(pieces)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)) and (self.bytes_b[i] not in same or self.b.is_byte(same[self.bytes_b[i]])):
                same[self.bytes_b[i]] = i
        self.identity = np.array([same.get(t, -1) if t else -1 for t in self.bytes_a], np.int64)
        self.length_a, self.length_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # Each id as a text with what follows it in a group: another id, the ids of the other tokenizer, another group.
        self.texts_a = [np.array([f"{i}{end}" for i in range(len(self.bytes_a))], object) for end in ",|"]
        self.texts_b = [np.array([f"{i}{end}" for i in range(len(self.bytes_b))], object) for end in ",;"]
        self.cuts = plain and not any(re.search("[^▁]▁|\n.|.\n", p, re.DOTALL) for p in pieces) and self._cuts_b()
        self.known: dict = {}           # ids of words, None where they do not spell the word
        self.unspelled: set = set()     # those of them
        self.long: list = []            # words that are forgotten after the texts they are in

    def _encoder(self, path: str, spec: dict, plain: bool):
        """Encodes a text, special strings in it as plain text. Where the order of the vocabulary is that of the merges, as usual, the
        same ids come faster from a tokenizer that goes by this order."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        vocabulary, model = spec["model"]["vocab"], spec["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ordered = sorted(vocabulary[c] for c in byte_letters().values() if c in vocabulary) == list(range(256)) and \
            all(vocabulary.get(x + y) == 256 + i for i, (x, y) in enumerate(pairs)) and not any(model.get(k) for k in ("dropout", "ignore_merges"))
        if plain and ordered:
            ranks = {self.bytes_a[i]: i for i in range(256 + len(pairs))}
            quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            return lambda text: quick.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        library.encode_special_tokens = True
        return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, "<u4")

    def encode_b(self, text: str) -> np.ndarray:
        return np.array(self.b.encode(text), "<u4")

    def _cuts_b(self) -> bool:
        """Whether the second tokenizer begins every text with a space and leaves all other characters as they are."""
        encode = self.b.encode
        return all(encode(f"{x} {y}") == encode(x) + encode(y) and encode(f"{x}\n{y}") == encode(x) + encode("\n" + y)[1:]
                   and self._spells(encode(x), " " + x, self.bytes_b)
                   for x, y in (("a", "b"), ("  a", "9\xa0é"), ("ﬁ\t\t.", "ｱ  !"), ("Ａ　", "́x\r\n")))

    @staticmethod
    def _spells(ids, text: str, table: list[bytes]) -> bool:
        return b"".join([table[i] for i in (ids if isinstance(ids, list) else ids.tolist())]) == text.encode()

    def words_of(self, text: str) -> list:
        """The words of a text: each with a space before it that it leaves out, or with the line end before it. A first word that begins with
        white space is in a tuple."""
        if not self.cuts:
            return [(text,)]
        lines = _LINE.split(text)
        words = _SPACE.split(lines[0])
        if words[0][:1].isspace():
            words[0] = (words[0],)
        for line in lines[1:]:
            some = _SPACE.split(line)
            some[0] = "\n" + some[0]
            words += some
        return words

    @staticmethod
    def _spelled(word) -> str:
        return " " + word[0] if isinstance(word, tuple) else word if word[0] == "\n" else " " + word

    def _encoded(self, words: list) -> None:
        """Looks words up that are not in the table: as one text, if each begins and ends at a place of a cut."""
        spelled = [self._spelled(w) for w in words]
        text = "".join(spelled)
        a, b = self.encode_a(text), self.encode_b("a" + text if text[0] == "\n" else text[1:])
        if text[0] == "\n":         # the letter before it is there so that no space is added
            b = b[len(self.b.encode("a")):]
        if not (self._spells(a, text, self.bytes_a) and self._spells(b, text, self.bytes_b)):
            if len(words) == 1:
                self.known[words[0]] = None
                self.unspelled.add(words[0])
            else:
                for word in words:
                    self._encoded([word])
            return
        ends = np.cumsum([len(w.encode()) for w in spelled])
        cut_a, cut_b = (np.searchsorted(np.cumsum(table[ids]), ends, "right").tolist() for ids, table in ((a, self.length_a), (b, self.length_b)))
        a, b = a.tobytes(), b.tobytes()
        i = j = 0
        for word, k, m in zip(words, cut_a, cut_b):
            self.known[word] = a[4 * i:4 * k], b[4 * j:4 * m]
            i, j = k, m

    def ids_of(self, some: list[str]) -> list[Ids]:
        """Ids of both tokenizers of every text; empty where one's tokens do not spell it."""
        known = self.known
        if len(known) > KNOWN_WORDS:        # the older half goes
            for word in list(known)[:max(len(known) - KNOWN_WORDS // 2, 0)]:
                del known[word]
        for word in self.long:
            known.pop(word, None)
        self.long.clear()
        self.unspelled.intersection_update(known)
        cut = [self.words_of(t) if t else [] for t in some]
        chunk: list = []
        size = 0
        for word in set().union(*cut).difference(known):
            if len(word) > KNOWN_CHARS or isinstance(word, tuple):
                self.long.append(word)
            if isinstance(word, tuple) or len(word) > CHUNK_CHARS or word[-1].isspace():
                self._encoded([word])
                continue
            chunk.append(word)
            size += len(word)
            if size >= CHUNK_CHARS:
                self._encoded(chunk)
                chunk, size = [], 0
        if chunk:
            self._encoded(chunk)
        out = []
        for text, words in zip(some, cut):
            if self.unspelled and not self.unspelled.isdisjoint(words):     # as a whole, where lengths might make up for each other
                a, b = self.encode_a(" " + text), self.encode_b(text)
                fits = self._spells(a, " " + text, self.bytes_a) and self._spells(b, " " + text, self.bytes_b)
                out.append((a.tobytes(), b.tobytes()) if fits else (b"", b""))
                continue
            own = list(map(known.__getitem__, words))
            out.append((b"".join(map(_FIRST, own)), b"".join(map(_SECOND, own))))
        return out

    def align(self, some: list[str]) -> dict[str, pa.Array]:
        """The columns of ``alignments`` for texts, but for their ids."""
        ids = self.ids_of(some)
        n = len(some)
        a, b = (np.frombuffer(b"".join([x[i] for x in ids]), "<u4").astype(np.int64) for i in (0, 1))
        n_a, n_b = (np.array([len(x[i]) // 4 for x in ids], np.int64) for i in (0, 1))
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # Between two neighbouring ends, of tokens of either, lies one link: that of the two tokens that reach over it.
        ends = np.concatenate((end_a, end_b))
        ends.sort(kind="stable")
        ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))] if len(ends) else ends
        at_a, at_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        of_a, of_b = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        of_a[at_a], of_b[at_b] = 1, 1
        cut = of_a & of_b
        link_a, link_b, group = a[np.cumsum(of_a) - of_a], b[np.cumsum(of_b) - of_b], np.cumsum(cut) - cut
        del of_a, of_b
        bytes_upto = np.concatenate(([0], end_a))[np.cumsum(n_a)]
        links_upto = np.concatenate(([0], np.searchsorted(ends, bytes_upto, "right")))
        n_links = np.diff(links_upto)
        n_groups = np.diff(np.concatenate(([0], np.cumsum(cut)))[links_upto])

        # Distinct pairs of each text. An identity pair is numbered by its first id, the others follow those.
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        number = np.where(self.identity[link_a] == link_b, link_a, size_a + link_a * size_b + link_b)
        number += np.repeat(np.arange(n) * (size_a + size_a * size_b), n_links)
        number, occurrences = np.unique(number, return_counts=True)
        doc, number = number // (size_a + size_a * size_b), number % (size_a + size_a * size_b)
        same = number < size_a
        lists = {}
        for name, kept, values in (("same", same, number), ("same_links", same, occurrences), ("a", ~same, (number - size_a) // size_b),
                                   ("b", ~same, (number - size_a) % size_b), ("links", ~same, occurrences)):
            offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[kept], minlength=n)))).astype(np.int32)
            lists[name] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[kept].astype(np.int32)))

        return {"n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
                "groups": pa.array(self._texts(a, b, group[at_a], group[at_b], n_a + n_b), pa.string()), **lists}

    def _texts(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The groups as text: in each the ids of the first tokenizer, then those of the second."""
        n_a, n_b = (np.bincount(g, minlength=int(group_a[-1]) + 1 if len(group_a) else 0) for g in (group_a, group_b))
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        in_a, in_b = np.arange(len(a)) - first_a[group_a], np.arange(len(b)) - first_b[group_b]
        start = first_a + first_b
        out = np.empty(len(a) + len(b), object)
        for ids, group, inside, count, place, (within, last) in ((a, group_a, in_a, n_a, start[group_a] + in_a, self.texts_a),
                                                                 (b, group_b, in_b, n_b, start[group_b] + n_a[group_b] + in_b, self.texts_b)):
            out[place] = np.where(inside == count[group] - 1, last[ids], within[ids])
        upto = np.concatenate(([0], np.cumsum(sizes))).tolist()
        return ["".join(out[i:j])[:-1] for i, j in zip(upto, upto[1:])]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_LINKS = ["same", "same_links", "a", "b", "links"]
_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, same array<int>, same_links array<int>, a array<int>, " \
          "b array<int>, links array<int>"


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order), and its links by pair
    of ids: ``same`` (first ids linked with the id of the same bytes) with ``same_links`` occurrences, and ``a``, ``b`` with ``links``. ``path_a``:
    a byte-level tokenizer of the tokenizers library, ``path_b``: a sentencepiece model; every executor has both."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            start = size = 0
            some: list[str] = []
            for i, text in enumerate(texts(batch.column(1)), 1):
                some.append(text.decode("utf-8", "replace"))
                size += len(text)
                if size >= SOME_BYTES or i == len(batch):
                    yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(start, len(some)), **own.align(some)})
                    start, size, some = i, 0, []

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, _SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n: documents that hold the pair linked; b is -1 for the id with the bytes of ``a``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n.astype(np.int64))], ["a", "b", "n"])

        def pairs() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return rows(keys >> 32, keys & 0xFFFFFFFF, n)

        for batch in batches:
            found = np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=len(vector))
            found[:len(vector)] += vector
            vector = found.astype(np.int64)
            a, b = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
            for i in range(0, len(a), CHUNK_PAIRS):
                held.append((a[i:i + CHUNK_PAIRS] << 32) + b[i:i + CHUNK_PAIRS])
                size += len(held[-1])
                if size >= CHUNK_PAIRS:
                    yield pairs()
                    held, size = [], 0
        if size:
            yield pairs()
        ids = np.flatnonzero(vector)
        yield rows(ids, np.full(len(ids), -1), vector[ids])

    return aligned.select("same", "a", "b").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Counts:
    """Counts of identity pairs and of the frequent other ones, and each first id's highest count."""

    def __init__(self, same: np.ndarray, best: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        by_key = np.argsort(keys)
        self.same, self.best, self.keys, self.counts = same, best, keys[by_key], counts[by_key]

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Counts of pairs, 0 for those not here."""
        keys = (a.astype(np.int64) << 32) + b
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(values)))
    return upto[offsets[1:]] - upto[offsets[:-1]]


def scored(aligned: DataFrame) -> DataFrame:
    """Adds n_best (links whose pair's count is the highest of its first id, ties included) and count_sum (the counts of all links) and leaves
    out the links. Writes the alignments in the shared folder: they are read for counting and again here."""
    rest = [c for c in aligned.columns if c not in _LINKS]
    rows = staged(aligned.withColumn("_row", F.monotonically_increasing_id()))
    counts = staged(pair_counts(rows))
    spark = aligned.sparkSession
    # One row for each id of the first vocabulary.
    vector = counts.groupBy("a").agg(F.max("n").alias("best"), F.max(F.when(F.col("b") < 0, F.col("n")).otherwise(0)).alias("same")).toArrow()
    ids = vector.column("a").to_numpy()
    best, same = np.zeros(int(ids.max(initial=-1)) + 1, np.int64), np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    best[ids], same[ids] = vector.column("best").to_numpy(), vector.column("same").to_numpy()
    others = counts.where("b >= 0")
    power = F.floor(F.log2("n") + F.lit(1e-9)).cast("int")
    sizes = {r["k"]: r["count"] for r in others.groupBy(power.alias("k")).count().collect()}
    least = next((k for k in range(64) if sum(n for p, n in sizes.items() if p >= k) <= FREQUENT_PAIRS), 64)
    often = others.where(power >= least).toArrow()
    keys = (often.column("a").to_numpy().astype(np.int64) << 32) + often.column("b").to_numpy()
    table = spark.sparkContext.broadcast(Counts(same, best, keys, often.column("n").to_numpy()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for batch in batches:
            own, own_links, a, b, links = (batch.column(c) for c in _LINKS)
            values = [c.flatten().to_numpy(zero_copy_only=False) for c in (own, own_links, a, b, links)]
            offsets = [np.concatenate(([0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64) for c in (own, a)]
            n, m = known.same[values[0]], known.find(values[2], values[3])
            total = _sums(n * values[1], offsets[0]) + _sums(m * values[4], offsets[1])
            top = _sums((n == known.best[values[0]]) * values[1], offsets[0]) + _sums(((m > 0) & (m == known.best[values[2]])) * values[4], offsets[1])
            out = {c: batch.column(c) for c in passed} | {"n_best": pa.array(top.astype(np.int64)), "count_sum": pa.array(total.astype(np.int64))}
            if least:       # pairs whose counts are not here
                ends = np.concatenate(([0], np.cumsum(_sums(m == 0, offsets[1])))).astype(np.int32)
                out |= {c: pa.ListArray.from_arrays(pa.array(ends), pa.array(v[m == 0].astype(np.int32))) for c, v in zip(_LINKS[2:], values[2:])}
            yield pa.RecordBatch.from_pydict(out)

    passed = ["_row", *rest]
    schema = T.StructType([*rows.select(*passed).schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                           *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in (_LINKS[2:] if least else ())]])
    found = rows.mapInArrow(score, schema)
    if not least:
        return found.drop("_row")
    found = staged(found)
    highest = spark.createDataFrame([(i, int(best[i])) for i in ids.tolist()], "a int, best long")
    rare = others.where(power < least).join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("best")).alias("top"))
    more = found.select("_row", F.inline(F.arrays_zip("a", "b", "links"))).join(rare, ["a", "b"]).groupBy("_row") \
        .agg(F.sum(F.when(F.col("top"), F.col("links")).otherwise(0)).alias("_best"), F.sum(F.col("links") * F.col("n")).alias("_sum"))
    return found.join(more, "_row", "left").select(*rest, (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                                                   (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"))
