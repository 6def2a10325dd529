"""Prefix-tree similarity join: documents whose sets of word n-grams have a Jaccard similarity of at least ``percent`` %.

The steps, all exact:

1. A scan hashes every text's n-grams to a set. Equal sets are one node from here on, with the smallest id of its documents. The n-grams
   of all sets are dealt out by ranges of their hash, and each node learns how many of its own occur elsewhere: a node that is similar
   to another one shares ``t`` of its n-grams, so nodes that repeat fewer are done. The sets of the others are kept.
2. Their n-grams get one global order: rare ones by hash, then frequent ones by frequency, so that passages which documents
   share come last. Any order gives the same result; what is broadcast of it is at most ``FREQUENT`` n-grams, the most frequent ones.
3. Two similar sets share one of their first ``n - ceil(t n) + 1`` n-grams. These prefixes are dealt out by n-gram, packed into
   arrays, and n-grams with several nodes give the candidate lists; equal lists count once.
4. Each node is compared with the leaders of its lists. Lists that then still lie in several components are put together to families,
   which are gone through in blocks of bounded size: the prefix n-grams that two nodes share are counted in place, and only pairs across
   components whose count plus remaining length can reach the bound are compared.
5. A comparison traverses a prefix tree: the sets that meet one query set are sorted by their ordered n-grams, which is the
   depth-first order of their trie, so the overlap counted along a shared path is counted once, and a subtree is left when overlap plus
   remaining length cannot reach the bound.
6. Components of the links are joined back to the documents.

Hashes: 64 bits for an n-gram, 128 bits for a set. What is counted on fewer bits only lets more through to an exact step.

Defined cases: null or empty texts, and texts without a word, have an empty set and link with nothing; a text with fewer words
than n has one n-gram, the whole sequence. Documents with equal sets are linked. Rows with equal ids are documents of their own;
null ids are never the smallest of a component unless it has no other. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from plumbline.llm.components import components
from plumbline.llm.shared import scalar, staged
from plumbline.llm.words import LOWER, distinct, texts, window_hashes, word_hashes

WIDTH, PERCENT = 5, 75
FREQUENT = 1 << 22          # most n-grams whose frequency is broadcast
CHUNK_NGRAMS = 1 << 20      # n-grams of the sets that are counted, or packed, together
CHUNK_SETS = 1 << 16        # and sets; their numbers take 16 bits
PART_NGRAMS = 1_000_000     # prefix n-grams of a part
LEADER_NODES = 1024         # nodes that a task compares with one leader
BLOCK_NODES = 1024          # nodes of a block of a family
DENSE_PAIRS, DENSE_LISTS = 4096, 512    # pairs from which a list is counted by a matrix product, and lists of one product
BROADCAST_NODES = 1_000_000 # rows of at most 60 bytes that go to every executor; more are joined by a shuffle
OUT_BYTES = 1 << 23         # of sets that a task holds back
STEP = 64                   # n-grams of a path that are looked up at once


def ngram_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    return distinct(window_hashes(word_hashes(words), min(width, len(words))))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def least_overlap(a: int, b: int, percent: int) -> int:
    """Smallest overlap of two sets of these sizes that are similar."""
    return -(-percent * (a + b) // (100 + percent))


class Order:
    """The global order of n-grams: by hash, except that frequent ones follow by frequency."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by_token = np.argsort(tokens)
        self.tokens, self.counts = tokens[by_token], counts[by_token]

    def count(self, tokens: np.ndarray) -> np.ndarray:
        """Frequency of each n-gram, 0 for the rare ones."""
        if not len(self.tokens):
            return np.zeros(len(tokens), np.uint32)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)

    def apply(self, tokens: np.ndarray) -> np.ndarray:
        """Sorted hashes in the global order."""
        counts = self.count(tokens)
        return tokens[np.argsort(counts, kind="stable")] if counts.any() else tokens

    def place(self, token: np.uint64) -> bytes:
        """Bytes that sort as the n-gram does in the global order."""
        return int(self.count(np.array([token]))[0]).to_bytes(4, "big") + int(token).to_bytes(8, "big")


class Traversal:
    """Overlap of one query set with sets that come in the depth-first order of their trie."""

    def __init__(self, query: np.ndarray, percent: int):
        self.query, self.percent = np.sort(query), percent
        self.path, self.overlap, self.depth = np.empty(0, np.uint64), np.zeros(1, np.int64), 0

    def similar(self, tokens: np.ndarray) -> bool:
        """Whether the set, given in the global order, is similar to the query."""
        n, q = len(tokens), len(self.query)
        need = least_overlap(n, q, self.percent)
        shared = min(self.depth, n)
        differs = np.flatnonzero(self.path[:shared] != tokens[:shared])
        depth = int(differs[0]) if len(differs) else shared
        overlap = np.zeros(n + 1, np.int64)
        overlap[:depth + 1] = self.overlap[:depth + 1]
        while depth < n and overlap[depth] + min(n - depth, q - overlap[depth]) >= need:
            part = tokens[depth:depth + STEP]
            at = np.minimum(np.searchsorted(self.query, part), q - 1)
            overlap[depth + 1:depth + 1 + len(part)] = overlap[depth] + np.cumsum(self.query[at] == part)
            depth += len(part)
        self.path, self.overlap, self.depth = tokens, overlap, depth
        return depth == n and bool(overlap[n] >= need)


# Sets

class Slices:
    """Ranges of the hash, and 32 bits of each hash within its range."""

    def __init__(self, n: int):
        self.width = np.uint64(-(-(1 << 64) // n)) if n > 1 else np.uint64((1 << 64) - 1)
        self.step = np.uint64(max(1, -(-int(self.width) // (1 << 32))))

    def cut(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range, and bits within it, of each hash."""
        ranges = tokens // self.width
        return ranges.astype(np.int64), ((tokens - ranges * self.width) // self.step).astype(np.uint32)


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


def _bounded(rows: Iterator[tuple], kinds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose last column, bytes, holds about ``OUT_BYTES`` at most."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 64
        if size >= OUT_BYTES:
            yield _batch(held, kinds)
            held, size = [], 0
    if held:
        yield _batch(held, kinds)


def _blobs(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(b.as_py(), kind) for b in column]


_LONGS = pa.list_(pa.int64())
_CHUNKS = [("slice", pa.int32()), ("chunk", pa.int64()), ("heads", pa.binary()), ("owners", pa.binary()), ("doc", _LONGS), ("hash", _LONGS),
           ("fp", pa.list_(pa.binary())), ("n", _LONGS), ("place", _LONGS)]
_CHUNK_SCHEMA = "slice int, chunk bigint, heads binary, owners binary, doc array<bigint>, hash array<bigint>, fp array<binary>, n array<bigint>, " \
                "place array<bigint>"
_COUNT_SCHEMA = "chunk bigint, owners binary, counts binary, doc array<bigint>, hash array<bigint>, fp array<binary>, n array<bigint>, place array<bigint>"


def profiled(docs: DataFrame, slices: int, width: int) -> DataFrame:
    """A row per document: doc, hash of the text, fp (the set's hash), n, and ``repeated``, how many of its n-grams come up elsewhere,
    if not a few more: an n-gram counts by the bits that its slice keeps, and copies in other chunks are elsewhere.

    Chunks of distinct sets are numbered by task, so that a task that is run again numbers them alike.
    """
    ranges = Slices(slices)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        known: dict[bytes, int] = {}
        sets: list[np.ndarray] = []
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            packed: list[tuple] = [(-1 - chunk % slices, chunk, None, None, *[[r[i] for r in rows] for i in range(5)])]
            if sets:
                of, heads = ranges.cut(np.concatenate(sets))
                owners = np.repeat(np.arange(len(sets)).astype(np.uint16), [len(s) for s in sets])
                by_range = np.argsort(of, kind="stable")
                heads, owners, ends = heads[by_range], owners[by_range], np.cumsum(np.bincount(of, minlength=slices)).tolist()
                packed += [(i, chunk, heads[a:b].tobytes(), owners[a:b].tobytes(), *[None] * 5) for i, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
            return _batch(packed, _CHUNKS)

        for batch in batches:
            for doc, own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
                tokens = ngram_set(text, width)
                fp = xxh3_128_digest(tokens)
                if len(tokens) and fp not in known:      # a copy within the chunk is neither counted nor sent
                    known[fp] = len(sets)
                    sets.append(tokens)
                    held += len(tokens)
                rows.append((doc, own, fp, len(tokens), known.get(fp, -1)))
                if held >= CHUNK_NGRAMS or len(rows) >= CHUNK_SETS:
                    yield out()
                    chunk, held = chunk + 1, 0
                    known.clear(), sets.clear(), rows.clear()
        if rows:
            yield out()

    def count(table: pa.Table) -> pa.Table:
        docs_of = ["doc", "hash", "fp", "n", "place"]
        if table.column("slice")[0].as_py() < 0:
            empty = pa.array([None] * len(table), pa.binary())
            return pa.table({"chunk": table.column("chunk"), "owners": empty, "counts": empty, **{c: table.column(c) for c in docs_of}})
        heads, owners = np.concatenate(_blobs(table.column("heads"), np.uint32)), _blobs(table.column("owners"), np.uint16)
        places = np.repeat(np.arange(len(owners)) * CHUNK_SETS, [len(o) for o in owners]) + np.concatenate(owners)
        by_head = np.argsort(heads, kind="stable")
        heads = heads[by_head]
        same = heads[1:] == heads[:-1]
        several = np.concatenate((same, [False])) | np.concatenate(([False], same))
        places, counts = np.unique(places[by_head][several], return_counts=True)
        cuts = np.searchsorted(places, np.arange(len(owners) + 1) * CHUNK_SETS).tolist()
        chunks = table.column("chunk").to_pylist()
        rows = [(c, (places[a:b] % CHUNK_SETS).astype(np.uint16).tobytes(), counts[a:b].astype(np.uint32).tobytes(), *[None] * 5)
                for c, a, b in zip(chunks, cuts, cuts[1:]) if b > a]
        kinds = [("chunk", pa.int64()), ("owners", pa.binary()), ("counts", pa.binary()), *_CHUNKS[4:]]
        return pa.Table.from_batches([_batch(rows, kinds)])

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(CHUNK_SETS + 1, np.int64)       # the last place is that of empty sets
        columns: dict[str, list] = {c: [] for c in ("doc", "hash", "fp", "n", "place")}
        for row in table.to_pylist():
            if row["owners"] is None:
                for c, values in columns.items():
                    values.extend(row[c])
            else:
                sums += np.bincount(np.frombuffer(row["owners"], np.uint16), np.frombuffer(row["counts"], np.uint32), CHUNK_SETS + 1).astype(np.int64)
        return pa.table({"doc": pa.array(columns["doc"], pa.int64()), "hash": pa.array(columns["hash"], pa.int64()), "fp": pa.array(columns["fp"], pa.binary()),
                         "n": pa.array(columns["n"], pa.int64()), "repeated": pa.array(sums[np.array(columns["place"], np.int64)], pa.int64())})

    packed = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("hash"), "text").mapInArrow(pack, _CHUNK_SCHEMA)
    return packed.groupBy("slice").applyInArrow(count, _COUNT_SCHEMA) \
        .groupBy("chunk").applyInArrow(total, "doc bigint, hash bigint, fp binary, n bigint, repeated bigint")


def _spread(ids: DataFrame) -> DataFrame:
    """A frame of short rows, to be broadcast in a join if it has few enough of them; else Spark shuffles both sides."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_NODES else ids


def kept_sets(docs: DataFrame, nodes: DataFrame, width: int, repeated: bool) -> DataFrame:
    """fp, tokens (sorted hashes) of nodes (fp, and doc, hash: one document that has the set). ``repeated``: rows may be there twice."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _bounded(((fp.as_py(), ngram_set(text, width).tobytes()) for batch in batches for fp, text in zip(batch.column(0), texts(batch.column(1)))),
                            [("fp", pa.binary()), ("tokens", pa.binary())])

    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_hash"), "text")
    wanted = _spread(nodes.select("fp", "doc", "hash"))
    own = rows.join(wanted, rows["_doc"].eqNullSafe(wanted["doc"]) & (rows["_hash"] == wanted["hash"]))
    sets = own.select("fp", "text").mapInArrow(build, "fp binary, tokens binary")
    return sets.dropDuplicates(["fp"]) if repeated else sets


def global_order(sets: DataFrame, slices: int) -> Order:
    """Counts n-grams over the sets. At most ``FREQUENT`` reach the driver: those above the least power of two that few enough reach."""
    ranges = Slices(slices)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(chunk), return_counts=True)
            cuts = np.searchsorted(ranges.cut(tokens)[0], np.arange(slices + 1)).tolist()
            rows = [(i, tokens[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return _batch(rows, [("slice", pa.int32()), ("tokens", pa.binary()), ("counts", pa.binary())])

        for batch in batches:
            for tokens in batch.column(0):
                chunk.append(np.frombuffer(tokens.as_py(), np.uint64))
                held += len(chunk[-1])
                if held >= CHUNK_NGRAMS:
                    yield out()
                    chunk, held = [], 0
        if held:
            yield out()

    def count(table: pa.Table) -> pa.Table:
        tokens, places = np.unique(np.concatenate(_blobs(table.column("tokens"), np.uint64)), return_inverse=True)
        counts = np.zeros(len(tokens), np.int64)
        np.add.at(counts, places, np.concatenate(_blobs(table.column("counts"), np.int64)))
        tokens, counts = tokens[counts > 1], counts[counts > 1]
        reach = [int((counts >> k > 0).sum()) for k in range(1, 63)]
        return pa.table({"tokens": pa.array([tokens.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
                         "reach": pa.array([reach], _LONGS)})

    counted = staged(sets.select("tokens").mapInArrow(pack, "slice int, tokens binary, counts binary").groupBy("slice")
                     .applyInArrow(count, "tokens binary, counts binary, reach array<bigint>"))
    reach = {r["k"]: r["n"] for r in counted.select(F.posexplode("reach").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("n")).collect()}
    least = next((k + 1 for k in sorted(reach) if reach[k] <= FREQUENT), 1)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, counts in zip(batch.column(0), batch.column(1)):
                counts = np.frombuffer(counts.as_py(), np.int64)
                many = counts >> least > 0
                yield _batch([(np.frombuffer(tokens.as_py(), np.uint64)[many].tobytes(), np.minimum(counts[many], 1 << 31).astype(np.uint32).tobytes())],
                             [("tokens", pa.binary()), ("counts", pa.binary())])

    frame = counted.select("tokens", "counts").mapInArrow(often, "tokens binary, counts binary").toArrow()
    return Order(*[np.concatenate([np.empty(0, kind), *_blobs(frame.column(c), kind)]) for c, kind in (("tokens", np.uint64), ("counts", np.uint32))])


def candidate_lists(sets: DataFrame, order, parts: int, percent: int) -> DataFrame:
    """list, short, weight: nodes (the first 64 bits of their set's hash) that have n-grams of their prefixes in common, and how many
    n-grams have just these nodes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = order.value
        prefixes: list[np.ndarray] = []
        nodes: list[int] = []
        held = 0

        def out() -> pa.RecordBatch:
            tokens = np.concatenate(prefixes)
            part = (tokens % np.uint64(parts)).astype(np.int64)
            by_part = np.argsort(part, kind="stable")
            owners = np.repeat(np.array(nodes, np.int64), [len(p) for p in prefixes])[by_part]
            tokens, ends = tokens[by_part], np.cumsum(np.bincount(part, minlength=parts)).tolist()
            return _batch([(i, tokens[a:b].tobytes(), owners[a:b].tobytes()) for i, (a, b) in enumerate(zip([0, *ends], ends)) if b > a],
                          [("part", pa.int32()), ("tokens", pa.binary()), ("nodes", pa.binary())])

        for batch in batches:
            for fp, tokens in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(tokens.as_py(), np.uint64)
                prefixes.append(own.apply(found)[:prefix_length(len(found), percent)])
                nodes.append(int.from_bytes(fp[:8], "big", signed=True))
                held += len(prefixes[-1])
                if held >= CHUNK_NGRAMS:
                    yield out()
                    prefixes.clear(), nodes.clear()
                    held = 0
        if held:
            yield out()

    def lists(table: pa.Table) -> pa.Table:
        tokens, nodes = np.concatenate(_blobs(table.column("tokens"), np.uint64)), np.concatenate(_blobs(table.column("nodes"), np.int64))
        both = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[both], nodes[both]
        begins = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))).tolist()
        found: dict[int, list] = {}
        for i, j in zip(begins, [*begins[1:], len(tokens)]):
            if j - i > 1:
                found.setdefault(xxh3_64_intdigest(nodes[i:j].tobytes()), [nodes[i:j], 0])[1] += 1
        sizes = [len(x) for x, _ in found.values()]
        return pa.table({"list": pa.array(np.repeat(np.fromiter(found, np.uint64, len(found)).view(np.int64), sizes), pa.int64()),
                         "short": pa.array(np.concatenate([np.empty(0, np.int64), *[x for x, _ in found.values()]]), pa.int64()),
                         "weight": pa.array(np.repeat(np.array([w for _, w in found.values()], np.int64), sizes), pa.int64())})

    packed = sets.select("fp", "tokens").mapInArrow(pack, "part int, tokens binary, nodes binary")
    return packed.groupBy("part").applyInArrow(lists, "list bigint, short bigint, weight bigint") \
        .groupBy("list", "short").agg(F.sum("weight").alias("weight"))


def ordered_sets(sets: DataFrame, order, percent: int) -> DataFrame:
    """fp, n, last (the place of the prefix's last n-gram), tokens (big-endian, in the global order, so that bytes sort as the trie's
    depth-first order)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = order.value

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for fp, tokens in zip(batch.column(0), batch.column(1)):
                    found = own.apply(np.frombuffer(tokens.as_py(), np.uint64))
                    yield fp.as_py(), len(found), own.place(found[prefix_length(len(found), percent) - 1]), found.astype(">u8").tobytes()

        yield from _bounded(rows(), [("fp", pa.binary()), ("n", pa.int64()), ("last", pa.binary()), ("tokens", pa.binary())])

    return sets.select("fp", "tokens").mapInArrow(build, "fp binary, n bigint, last binary, tokens binary")


# Comparisons

def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[Iterator[tuple]]:
    """Runs of rows with equal first ``n_keys`` columns."""
    # One row at a time: the sets are by far the largest part of a batch.
    rows = (tuple(v.as_py() for v in row) for batch in batches for row in zip(*batch.columns))
    for _, group in groupby(rows, key=lambda row: row[:n_keys]):
        yield group


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return _batch(pairs, [("a", pa.binary()), ("b", pa.binary())])


def _tokens(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u8").astype(np.uint64)


def leader_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs (fp, leader) that are similar. A leader's nodes are dealt out in blocks, each with its leader's set."""
    sizes = staged(pairs.groupBy(F.col("leader").alias("_leader")).agg(F.ceil(F.count(F.lit(1)) / F.lit(LEADER_NODES)).alias("blocks")))
    placed = pairs.join(sizes, pairs["leader"] == sizes["_leader"]) \
        .select("leader", F.pmod(F.xxhash64("fp"), F.col("blocks")).alias("block"), F.lit(1).alias("role"), "fp")
    leaders = sizes.select(F.col("_leader").alias("leader"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                           F.lit(0).alias("role"), F.col("_leader").alias("fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[bytes, bytes]] = []
        for group in _groups(batches, 2):
            traversal = None
            for leader, _, role, tokens, fp in group:
                if role == 0:
                    traversal = Traversal(_tokens(tokens), percent)
                elif traversal.similar(_tokens(tokens)):
                    found.append((leader, fp))
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    placed = _spread(staged(placed.unionByName(leaders)))
    rows = sets.select("fp", "tokens").join(placed, "fp").select("leader", "block", "role", "tokens", "fp")
    return rows.repartition("leader", "block").sortWithinPartitions("leader", "block", "role", "tokens") \
        .mapInArrow(compare, "a binary, b binary")


def _shared_weights(entries: list[tuple[np.ndarray, np.ndarray, int]], rows: int, columns: int) -> np.ndarray:
    """How many prefix n-grams the nodes of two blocks have in common, from (places in one, places in the other, weight) per list."""
    total = np.zeros((rows, columns), np.float32)
    long = [e for e in entries if len(e[0]) * len(e[1]) > DENSE_PAIRS]
    for i in range(0, len(long), DENSE_LISTS):
        left, right = np.zeros((rows, DENSE_LISTS), np.float32), np.zeros((DENSE_LISTS, columns), np.float32)
        for k, (a, b, weight) in enumerate(long[i:i + DENSE_LISTS]):
            left[a, k], right[k, b] = weight, 1
        total += left @ right
    for a, b, weight in entries:
        if len(a) * len(b) <= DENSE_PAIRS:
            total[np.ix_(a, b)] += weight
    return total


def reachable_pairs(members: DataFrame, percent: int) -> DataFrame:
    """fp, leader: pairs of nodes of different components that may be similar. ``members``: list, family, fp, n, last, weight, component.

    Of two nodes, all common n-grams up to the end of the prefix that ends first are counted, so their overlap is at most the count
    and what that node has after its prefix. Lists that nodes connect are a family; a task counts for two blocks of a family's nodes.
    """
    sizes = members.groupBy(F.col("family").alias("_family")).agg(F.ceil(F.count_distinct("fp") / F.lit(BLOCK_NODES)).alias("blocks"))
    placed = members.join(staged(sizes), F.col("family") == F.col("_family")) \
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select("family", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "list", "own", "fp", "n", "last",
                "weight", "component")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            nodes: dict[int, dict] = {}
            lists: dict[int, tuple] = {}
            low = high = None
            for _, low, high, name, own, fp, n, last, weight, component in group:
                block = nodes.setdefault(own, {})
                place = block.setdefault(fp, (len(block), n, last, component))[0]
                lists.setdefault(name, (array("i"), array("i"), weight))[0 if own == low else 1].append(place)
            if low not in nodes or high not in nodes:
                continue
            a, b = nodes[low], nodes[high]
            entries = [(np.frombuffer(x, np.int32), np.frombuffer(x if low == high else y, np.int32), w) for x, y, w in lists.values() if x and (y or low == high)]
            common = _shared_weights(entries, len(a), len(b))
            n_a, n_b = (np.array([v[1] for v in block.values()], np.int64) for block in (a, b))
            order = {x: i for i, x in enumerate(sorted({v[2] for block in (a, b) for v in block.values()}))}
            last_a, last_b = (np.array([order[v[2]] for v in block.values()]) for block in (a, b))
            part = {x: i for i, x in enumerate({v[3] for block in (a, b) for v in block.values()})}
            part_a, part_b = (np.array([part[v[3]] for v in block.values()]) for block in (a, b))
            first = np.where(last_a[:, None] <= last_b[None, :], n_a[:, None], n_b[None, :])
            bound = common + (-(-first * percent // 100) - 1)
            near = (common > 0) & (bound * (100 + percent) >= percent * (n_a[:, None] + n_b[None, :])) & (part_a[:, None] != part_b[None, :])
            near &= np.minimum(n_a[:, None], n_b[None, :]) * 100 >= percent * np.maximum(n_a[:, None], n_b[None, :])
            if low == high:
                near = np.triu(near, 1)
            names_a, names_b = list(a), list(b)
            yield _edges([(names_a[i], names_b[j]) for i, j in zip(*np.nonzero(near))])

    pairs = placed.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high") \
        .mapInArrow(compare, "leader binary, fp binary")
    return pairs.select("fp", "leader")


def led(lists: DataFrame) -> DataFrame:
    """Adds each list's leader: the node that shares most n-grams with most nodes, as a text does that others were made from."""
    sizes = _spread(staged(lists.groupBy(F.col("list").alias("_list")).agg(F.count(F.lit(1)).alias("_nodes"))))
    shared = lists.join(sizes, lists["list"] == sizes["_list"]).groupBy(F.col("fp").alias("_fp")) \
        .agg(F.sum(F.col("weight") * (F.col("_nodes") - 1)).alias("_shared"))
    shared = _spread(staged(shared))
    ranked = lists.join(shared, lists["fp"] == shared["_fp"]).select("list", "fp", "n", "weight", F.struct(-F.col("_shared"), "fp").alias("_rank"))
    heads = _spread(staged(ranked.groupBy(F.col("list").alias("_list")).agg(F.min("_rank")["fp"].alias("leader"))))
    return ranked.join(heads, ranked["list"] == heads["_list"]).select("list", "leader", "fp", "n", "weight")


def similar_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """A row per document: doc_id, text_hash, n_shingles, component_id (smallest id of its component) and ``keeper``, the
    (doc_id, text_hash) of the document that stands for the component."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = staged(profiled(docs, 4 * tasks, width))
    first = F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("hash"))
    nodes = staged(rows.where("n > 0").groupBy("fp").agg(F.max("n").alias("n"), F.max("repeated").alias("repeated"), F.min(first).alias("first")))
    near = staged(nodes.where(F.col("repeated") * 100 >= F.col("n") * percent)
                  .select("fp", "n", F.col("first.doc").alias("doc"), F.col("first.hash").alias("hash"),
                          F.conv(F.hex(F.substring("fp", 1, 8)), 16, -10).cast("long").alias("short")))
    repeated = not rows.groupBy("doc", "hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty()
    kept = staged(kept_sets(docs, near, width, repeated))
    order = spark.sparkContext.broadcast(global_order(kept, 4 * tasks))
    prefixes = scalar(near, F.sum(F.col("n") * (100 - percent) / 100 + 1)) or 0
    shorts = staged(candidate_lists(kept, order, max(4 * tasks, math.ceil(prefixes / PART_NGRAMS)), percent))
    lists = shorts.join(near.select("short", "fp", "n"), "short").select("list", "fp", "n", "weight")
    lists = staged(led(staged(lists)))
    sets = ordered_sets(kept.join(_spread(staged(lists.select("fp").distinct())), "fp", "left_semi"), order, percent)
    sizes = staged(sets.select("fp", "n", "last"))
    links = staged(leader_links(staged(lists.where("leader != fp").select("fp", "leader").distinct()), sets, percent))
    linked = components(links).withColumnRenamed("node", "fp")
    members = staged(lists.join(linked, "fp", "left").select("list", "leader", "fp", "weight", F.coalesce("component", "fp").alias("component")))
    mixed = staged(members.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("list"))
    members = staged(members.join(_spread(mixed), "list"))
    families = components(members.where("leader != fp").select(F.col("leader").alias("a"), F.col("fp").alias("b")).distinct()) \
        .select(F.col("node").alias("fp"), F.col("component").alias("family"))
    pairs = staged(reachable_pairs(staged(members.join(families, "fp").join(sizes, "fp")), percent))
    more = staged(leader_links(pairs, sets, percent))
    if not more.isEmpty():
        linked = components(links.unionByName(more)).withColumnRenamed("node", "fp")
    named = nodes.select("fp", "first").join(linked, "fp", "left") \
        .select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = staged(named)
    keepers = named.groupBy("component").agg(F.min("first").alias("keeper"))
    classes = staged(named.join(keepers, "component").select(F.col("fp").alias("_fp"), "keeper"))
    out = rows.join(classes, rows["fp"] == classes["_fp"], "left")
    alone = F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("hash"))
    keeper = F.coalesce(F.col("keeper"), alone)
    return out.select(F.col("doc").alias("doc_id"), F.col("hash").alias("text_hash"), F.col("n").alias("n_shingles"),
                      keeper["doc"].alias("component_id"), F.struct(keeper["doc"].alias("doc_id"), keeper["hash"].alias("text_hash")).alias("keeper"))


def representatives(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns; every document without words stays."""
    classes = staged(similar_classes(docs, width, percent))
    own = F.struct("doc_id", "text_hash")
    stays = classes.where(own.eqNullSafe(F.col("keeper")) | (F.col("n_shingles") == 0)).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")) \
        .agg(F.count(F.lit(1)).alias("_n"), F.max("n_shingles").alias("_words"))
    stays = staged(stays)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_hash"))
    kept = rows.join(stays, rows["_doc"].eqNullSafe(stays["_id"]) & (rows["_hash"] == stays["_h"]))
    if not stays.where("_n > 1 AND _words > 0").isEmpty():      # rows repeated in full: one of them stays
        empty = kept.where("_words = 0")
        kept = kept.where("_words > 0").dropDuplicates(["_doc", "_hash"]).unionByName(empty)
    return kept.select("row.*")
