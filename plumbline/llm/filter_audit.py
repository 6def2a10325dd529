"""What each filter of a chain removes, for every order in which the chain could run.

A document's filters that it fails are a mask. Documents are counted by part and mask in one pass; everything after it works on those
counts, of which there are at most 2 to the number of filters for each part.

Orders are numbered as permutations are in dictionary order (their Lehmer rank), so all orders that begin alike are one interval of numbers.
A mask is removed at step k by filter f in the orders that begin with k - 1 filters the mask passes, followed by f. Its counts are
therefore added at the first number of that interval and taken off after the last one, and a running sum over the numbers gives what every
order removes at every step.

The last filter, an exact duplicate of a document with a smaller id, needs the smallest id of each text: documents are counted by digest
of the text first, copies combined before the shuffle, so that a text held by a third of all rows is a few rows from there on.

Defined cases: null texts are empty and equal to empty ones; a null ``lang`` is the part of the empty string. A document without id is no
duplicate, and rows with the smallest id of a text are not either, however often they are there. Labels of one id are put together: it
is good if any of them says so, and toxic likewise. Documents without label are neither. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.shared import staged

FILTERS = "ABCDE"
SPACE, WORD_BOUND, DISTINCT_SHARE, UPPER_SHARE = r"[\x20\x09-\x0D]+", 100, 80, 10


def intervals(n: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(mask, step, filter, first number, number after the last) for the orders of ``n`` filters in which a filter removes a mask at a step."""
    for step in range(1, n + 1):
        for begin in permutations(range(n), step):
            left, first = list(range(n)), 0
            for i, f in enumerate(begin):
                first += left.index(f) * factorial(n - 1 - i)
                left.remove(f)
            passed = sum(1 << f for f in begin[:-1])
            for mask in range(1 << n):
                if mask >> begin[-1] & 1 and not mask & passed:
                    yield mask, step, begin[-1], first, first + factorial(n - step)


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: filter i of ``FILTERS`` fails), docs, good, toxic."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    words = rows.select("doc", "part", "text", F.array_remove(F.split("text", SPACE), "").alias("words"))
    n_words, n_distinct = F.size("words"), F.size(F.array_distinct("words"))
    fails = [n_words < WORD_BOUND, n_distinct * 100 < n_words * DISTINCT_SHARE,
             F.regexp_count("text", F.lit("[A-Z]")) * 100 > F.char_length("text") * UPPER_SHARE, F.col("text").rlike("[#$%&*|]")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    own = words.select("doc", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    own = own.groupBy("doc", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_doc")) \
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")) \
        .withColumn("_salt", F.lit(0).cast("long"))
    # Documents without id have no label; a salt spreads them.
    own = own.withColumn("salt", F.when(F.col("doc").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1).cast("long"))).otherwise(0))
    own = own.join(known, (F.coalesce("doc", F.lit(0)) == F.col("_doc")) & (F.col("salt") == F.col("_salt")), "left")
    good, toxic = F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    first = F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n")))
    same = own.groupBy("digest", "mask", "part", good, toxic) \
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("without"), first.alias("first"))
    # A digest has a row for each part and label by now.
    lowest = F.min("first.doc").over(Window.partitionBy("digest"))
    kept = F.col("without") + F.when(F.col("first.doc") == lowest, F.col("first.n")).otherwise(0)
    copy = 1 << FILTERS.index("E")
    split = same.select("part", "good", "toxic", "mask", "n", kept.alias("single")) \
        .select("part", "good", "toxic", F.inline(F.array(F.struct(F.col("mask"), F.col("single").alias("docs")),
                                                         F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("single")).alias("docs")))))
    count = lambda column: F.sum(F.when(column, F.col("docs")).otherwise(0))       # noqa: E731
    return split.where("docs > 0").groupBy("part", "mask").agg(F.sum("docs").alias("docs"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """From part, mask, docs, good, toxic: a row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley."""
    spark, n = counts.sparkSession, len(filters)
    orders = ["".join(filters[i] for i in p) for p in permutations(range(n))]
    found = spark.createDataFrame([(m, step, first, after) for m, step, _, first, after in intervals(n)], "mask int, step int, first int, after int")
    names = spark.createDataFrame(list(enumerate(orders)), "rank int, filter_order string")

    per_filter = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("docs")).otherwise(0)) for i in range(n)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("docs")).otherwise(0)) for i in range(n)]
    parts = counts.groupBy("part").agg(F.sum("docs").alias("total"), F.array(*per_filter).alias("fails"), F.array(*alone).alias("alone"))

    values = ["docs", "good", "toxic"]
    ends = counts.join(F.broadcast(found), "mask").select("part", "step", F.inline(F.array(
        F.struct(F.col("first").alias("rank"), *values), F.struct(F.col("after").alias("rank"), *[(-F.col(v)).alias(v) for v in values]))))
    grid = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")) \
        .select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(v) for v in values])
    changes = ends.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(v).alias(v) for v in values])
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    sums = changes.select("part", "step", "rank", *[F.sum(v).over(upto).alias(v) for v in values]).where(F.col("rank") < len(orders))

    steps = sums.join(F.broadcast(names), "rank").join(parts, "part") \
        .withColumn("at", F.instr(F.lit(filters), F.substring("filter_order", F.col("step"), F.lit(1))))
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select("part", "filter_order", "step", (F.col("total") - F.sum("docs").over(so_far)).alias("kept"), F.col("docs").alias("removed"),
                        (F.element_at("fails", F.col("at")) - F.col("docs")).alias("redundant"), F.element_at("alone", F.col("at")).alias("unique_fails"),
                        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
                        F.sum("docs").over(Window.partitionBy("part", "at")).alias("shapley"))


def document_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over documents. Counts are staged: they are read several times."""
    return audit(staged(failure_counts(docs, labels)))
