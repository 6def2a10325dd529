"""Stratified samples and the bounds of means taken from them."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.sampling import sampled_means, stratified_sample


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with nearly all rows, some with few, one row of its own, and scores that differ by key."""
    key = F.when(F.col("id") < 9000, "hot").when(F.col("id") < 9800, F.concat(F.lit("k"), F.col("id") % 8)).when(F.col("id") < 9999, F.lit(None)).otherwise("alone")
    rows = spark.range(10_000).select(key.alias("k"), (F.col("id") % 3).cast("string").alias("j"), F.when(F.col("id") % 50 > 0, (F.abs(F.hash("id")) % 1000) / 999).alias("x"),
                                   F.when(F.col("id") < 9000, F.col("id") % 10 < 9).otherwise(F.col("id") % 2 == 0).cast("double").alias("y"))
    return rows.cache()


def test_small_strata_are_taken_whole(skewed):
    drawn = {r["k"]: r for r in stratified_sample(skewed, ["k"], 200, 1).groupBy("stratum.s0").agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows"), F.max("rate").alias("rate"))
             .withColumnRenamed("s0", "k").collect()}
    assert drawn["alone"]["n"] == 1 and drawn["null"]["n"] == drawn["null"]["rows"] == 199 and all(drawn[f"k{i}"]["n"] == 100 for i in range(8))
    assert 120 < drawn["hot"]["n"] < 280 and drawn["hot"]["rate"] == pytest.approx(200 / 9000)


def test_bounds_cover_the_true_means(skewed):
    truth = skewed.agg(F.avg("x").alias("x"), F.avg("y").alias("y")).head()
    hits, trials, width = 0, 40, []
    for seed in range(trials):
        for r in sampled_means(skewed, {"x": F.col("x"), "y": F.col("y")}, ["k"], 150, seed, sigmas=1.96).collect():
            hits += r["low"] <= truth[r["metric"]] <= r["high"]
            width.append(r["high"] - r["low"])
            assert r["rows"] == 10_000 and r["sampled"] < 1500
    assert hits >= 0.9 * 2 * trials and max(width) < 0.2


def test_more_rows_give_narrower_bounds_down_to_none(skewed):
    widths = []
    for n in (50, 800, 20_000):
        [r] = sampled_means(skewed, {"y": F.col("y")}, ["k", "j"], n, 3).collect()
        widths.append(r["high"] - r["low"])
    assert widths[0] > widths[1] > widths[2] == 0.0 and r["estimate"] == pytest.approx(skewed.agg(F.avg("y")).head()[0])


def test_empty_tables_and_scores(skewed):
    assert sampled_means(skewed.limit(0), {"x": F.col("x")}, ["k"], 10).collect() == []
    assert sampled_means(skewed, {"none": F.lit(None)}, ["k"], 10).collect() == []
    with pytest.raises(ValueError, match="at least one row"):
        stratified_sample(skewed, ["k"], 0)
