"""Mixing sources to target weights by capped water-filling.

Every source has a size (the words of its documents) and a weight. All words together are shared by weight; a source whose
share exceeds ``max_epochs`` times its size is clamped there, and the excess is shared again by weight among the others until no share is
above its clamp. A source is then repeated whole as often as its target allows, and the rest is a seeded sample: documents are
ordered by a hash of seed and id, those before a threshold are taken once more, and the documents in the one hash bucket that holds
the threshold are taken in part, so that a source meets its target to within rounding even if it has few or very long documents.

Nothing is ordered or collected per source: sizes are aggregated by source and hash bucket before they are shuffled, and a
threshold is found among the buckets of a source. The driver sees one number per round of clamping.

Defined cases: null text has size 0 and takes nothing; the null source is one source, last in order; rows with equal ids fall into
the same bucket and are treated alike, so repeated rows are interchangeable; null ids are one id. An empty table, or one
without words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.shared import numbered, staged

BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket(doc_id: Column, seed: int) -> Column:
    """Hash bucket of an id: the first 32 bits of an MD5 digest, scaled."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * BUCKETS / F.lit(1 << 32)).cast("int")


def cycled_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ..., ``cycle``, repeating, for sources by code point, null last."""
    ranked = numbered(sources, [F.col("source").isNull().asc(), F.col("source").asc()], "_rank")
    return ranked.withColumn("weight", (F.col("_rank") % cycle + 1).cast("double")).drop("_rank")


def water_level(sources: DataFrame, max_epochs: float) -> float:
    """Words per unit of weight for the sources that are not clamped. ``sources``: source_size, weight."""
    clamp = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    while True:
        clamped = F.lit(level) * F.col("weight") >= clamp if level else F.lit(False)
        row = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(clamped, clamp)).alias("full"),
                          F.sum(F.when(~clamped, F.col("weight"))).alias("weight")).first()
        if not row["all"]:
            return 0.0
        if not row["weight"]:
            return float("inf")
        rest = (row["all"] - (row["full"] or 0.0)) / row["weight"]
        if rest <= level:
            return level
        level = rest


def mixed_sources(docs: DataFrame, weights=cycled_weights, max_epochs: float = 3, seed: int = 17,
                  size: Column | None = None) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, ``repeats`` (whole repetitions), ``part`` (the share of
    one more that is taken, 0 to 1) and ``taken`` (size times both, in words).

    ``weights`` gets a frame with a row per source (source, source_size) and adds ``weight``.
    """
    size = text_size(F.col("text")) if size is None else size
    sized = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"),
                               bucket(F.col("doc_id"), seed).alias("bucket")))
    cells = staged(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    sources = staged(weights(cells.groupBy("source").agg(F.sum("words").alias("source_size"))))
    level = water_level(sources, max_epochs)
    target = F.least(F.col("source_size") * F.lit(float(max_epochs)), F.lit(level) * F.col("weight"))
    epochs = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    targets = staged(sources.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)))
                     .withColumn("repeats", epochs.cast("int"))
                     .withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size")))
    plan = targets.select(F.col("source").alias("_source"), "source_size", "target", "repeats", "rest")
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = cells.withColumn("end", F.sum("words").over(up_to)).join(plan, F.col("source").eqNullSafe(F.col("_source")))
    # The bucket in which the running sum passes what is left over: one row per source that is not a whole multiple.
    edge = ends.where("end > rest AND end - words <= rest") \
        .select("_source", F.col("bucket").alias("edge"), ((F.col("rest") - F.col("end") + F.col("words")) / F.col("words")).alias("share"))
    plan = staged(plan.join(edge.withColumnRenamed("_source", "_edge_source"), F.col("_source").eqNullSafe(F.col("_edge_source")), "left")
                  .drop("_edge_source"))
    part = F.when(F.col("bucket") < F.col("edge"), 1.0).when(F.col("bucket") == F.col("edge"), F.col("share")).otherwise(0.0)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn("part", part) \
        .withColumn("taken", F.col("repeats") * F.col("size") + F.floor(F.col("part") * F.col("size") + 0.5).cast("long")) \
        .select("doc_id", "source", "size", "source_size", "target", "repeats", "part", "taken", "bucket")


def mixture(docs: DataFrame, weights=cycled_weights, max_epochs: float = 3, seed: int = 17) -> DataFrame:
    """The documents of the mix, with all their columns, whole: a row for every repetition. Of the documents that the
    threshold's bucket takes in part, a seeded share of equal size is taken whole."""
    chosen = mixed_sources(docs, weights, max_epochs, seed)
    plan = staged(chosen.groupBy(F.col("source").alias("_source"))
                  .agg(F.max("repeats").alias("_repeats"), F.max(F.when(F.col("part") > 0, F.col("bucket"))).alias("_edge"),
                       F.min(F.when(F.col("part") > 0, F.struct(-F.col("bucket"), F.col("part"))))["part"].alias("_share")))
    own = bucket(F.col("row.doc_id"), seed)
    second = bucket(F.col("row.doc_id"), seed + 1) / F.lit(float(BUCKETS))
    more = (own < F.col("_edge")) | ((own == F.col("_edge")) & (second < F.col("_share")))
    return docs.select(F.struct("*").alias("row")).join(plan, F.col("row.source").cast("string").eqNullSafe(F.col("_source"))) \
        .withColumn("_copies", F.col("_repeats") + F.when(more, 1).otherwise(0)) \
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")).select("row.*")
