"""Means of row scores from a stratified sample, with bounds.

Rows of each stratum (a key of a key set) are drawn independently, all of them where the stratum is small, so that rare keys are seen as they are and
hot ones cost no more than they tell. The mean over all rows weighs each stratum by its true size. Its variance comes from the spread within the strata
and shrinks to nothing where a stratum was taken whole; bounds are ``sigmas`` standard errors to either side. A stratum of which fewer than
``LEAST_ROWS`` rows were drawn counts with the largest spread that scores between 0 and 1 can have, so the bounds err to the wide side.

Two scans: one counts the strata, one draws and aggregates. Nothing but one row per stratum is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import cell, key_cell

SIGMAS = 2.576                  # 99 of 100
LEAST_ROWS = 8
BROADCAST_STRATA = 1_000_000    # strata, of a key and a rate, that go to every executor
LARGEST_VARIANCE = 0.25         # of scores between 0 and 1


def strata_sizes(df: DataFrame, key_set: Sequence[str]) -> DataFrame:
    """``s0, s1, ..., rows`` per key of the key set."""
    keys = [key_cell(df, c).alias(f"s{i}") for i, c in enumerate(key_set)]
    return df.select(*keys).groupBy(*[f"s{i}" for i in range(len(key_set))]).agg(F.count(F.lit(1)).alias("rows"))


def stratified_sample(df: DataFrame, key_set: Sequence[str], rows_per_stratum: int, seed: int = 0, sizes: DataFrame | None = None) -> DataFrame:
    """Rows as ``row`` with the ``stratum`` they come from, its number of ``rows`` and the ``rate`` at which they were drawn: about
    ``rows_per_stratum`` of each stratum, all of smaller ones."""
    if rows_per_stratum < 1:
        raise ValueError(f"a stratum needs at least one row, got {rows_per_stratum}")
    sizes = strata_sizes(df, key_set) if sizes is None else sizes
    names = [f"s{i}" for i in range(len(key_set))]
    rates = sizes.select(*[F.col(n).alias(f"_{n}") for n in names], "rows", F.least(F.lit(1.0), F.lit(float(rows_per_stratum)) / F.col("rows")).alias("rate"))
    if rates.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        rates = F.broadcast(rates)
    # The draw comes before the join, so that a row's number does not depend on how it is joined.
    rows = df.select(F.struct(*[cell(c) for c in df.columns]).alias("row"), *[key_cell(df, c).alias(n) for c, n in zip(key_set, names)], F.rand(seed).alias("draw"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return rows.join(rates, same).filter(F.col("draw") < F.col("rate")).select("row", F.struct(*names).alias("stratum"), "rows", "rate")


def sampled_means(df: DataFrame, scores: Mapping[str, Column], key_set: Sequence[str], rows_per_stratum: int, seed: int = 0, sigmas: float = SIGMAS) -> DataFrame:
    """A row per score: ``metric, estimate, low, high, rows, sampled``. ``scores`` are columns over ``df`` between 0 and 1; a NULL score is left out,
    and the mean is over the rows that have one, of which each stratum has about the share its sample has."""
    scored = df.select(*[cell(c) for c in key_set], *[score.cast("double").alias(f"v{i}") for i, score in enumerate(scores.values())])
    drawn = stratified_sample(scored, key_set, rows_per_stratum, seed)
    per_score = [a for i in range(len(scores)) for a in (F.count(f"row.v{i}").alias(f"n{i}"), F.avg(f"row.v{i}").alias(f"m{i}"), F.var_samp(f"row.v{i}").alias(f"q{i}"))]
    strata = drawn.groupBy("stratum").agg(F.max("rows").alias("rows"), F.count(F.lit(1)).alias("sampled"), *per_score)
    entries = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"), F.col(f"q{i}").alias("q")) for i, name in enumerate(scores)])
    long = strata.select("rows", "sampled", F.inline(entries)).withColumn("size", F.col("rows") * F.col("n") / F.col("sampled"))
    spread = F.when(F.col("sampled") >= F.col("rows"), 0.0).when(F.col("n") < LEAST_ROWS, LARGEST_VARIANCE).otherwise(F.greatest(F.col("q"), F.lit(1.0) / F.col("n") / F.col("n")))
    error = F.col("size") * F.col("size") * (1 - F.col("sampled") / F.col("rows")) * spread / F.col("n")
    total = F.sum("size")
    means = long.filter("n > 0").groupBy("metric").agg((F.sum(F.col("size") * F.col("m")) / total).alias("estimate"), (F.sqrt(F.sum(error)) / total * sigmas).alias("half"),
                                                       F.sum("rows").alias("rows"), F.sum("sampled").alias("sampled"))
    return means.select("metric", "estimate", F.greatest(F.col("estimate") - F.col("half"), F.lit(0.0)).alias("low"),
                        F.least(F.col("estimate") + F.col("half"), F.lit(1.0)).alias("high"), "rows", "sampled")
