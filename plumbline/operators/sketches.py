"""Distinct counts of bounded size and stated error, as sketches that add up over batches and keys.

A sketch of ``lg_k`` has 2^lg_k registers. Its estimate has a relative standard error of at most 1.04 / sqrt(2^lg_k), merged or not; bounds are
``SIGMAS`` of those to either side, and hold for more than 99 of 100 columns. Counts up to about 2^lg_k / 10 are nearly exact. Every task keeps one
sketch per column, so no value is shuffled however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import all_filled, as_text, key_cell, key_set_name, key_text
from ..functions.scores import at_most_one, ratio

LG_K = 12
SIGMAS = 3.0
SKETCH_SCHEMA = "attribute string, sketch binary, rows long"


def relative_error(lg_k: int = LG_K) -> float:
    """Half the width of the bounds, as a share of the estimate."""
    return SIGMAS * 1.04 / math.sqrt(1 << lg_k)


def _stacked(df: DataFrame, texts: dict[str, Column], lg_k: int) -> DataFrame:
    sketches = [F.hll_sketch_agg(text, F.lit(lg_k)).alias(f"sketch_{i}") for i, text in enumerate(texts.values())]
    rows = F.array(*[F.struct(F.lit(name).alias("attribute"), F.col(f"sketch_{i}").alias("sketch"), F.col("rows"))
                     for i, name in enumerate(texts)])
    return df.agg(F.count(F.lit(1)).alias("rows"), *sketches).select(F.inline(rows))


def value_sketches(df: DataFrame, columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``attribute, sketch, rows`` of the distinct values of each column, in one scan."""
    return _stacked(df, {c: as_text(c) for c in columns}, lg_k)


def key_sketches(df: DataFrame, key_sets: Sequence[Sequence[str]], scope: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """``attribute, sketch, rows`` of the distinct keys of each key set, over rows whose ``scope`` columns are all filled."""
    rows = df.filter(all_filled(scope)) if scope else df
    names = list(dict.fromkeys(c for k in key_sets for c in k))
    keys = rows.select(*[key_cell(rows, n).alias(f"key_{i}") for i, n in enumerate(names)])
    place = {n: f"key_{i}" for i, n in enumerate(names)}
    # Each cell with its length, so that no two keys write the same text.
    whole = lambda k: F.concat(*[F.concat(F.length(as_text(place[c])).cast("string"), F.lit(":"), as_text(place[c])) for c in k]) \
        if len(k) > 1 else key_text([place[k[0]]])       # noqa: E731
    return _stacked(keys, {key_set_name(k): whole(k) for k in key_sets}, lg_k)


def merged_sketches(*frames: DataFrame) -> DataFrame:
    """Sketches of several batches as those of all of them."""
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union.groupBy("attribute").agg(F.hll_union_agg("sketch", F.lit(True)).alias("sketch"), F.sum("rows").alias("rows"))


def sketch_counts(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``attribute, Count, LowCount, HighCount, TotalRows``: the estimate and its bounds, none above the number of rows."""
    error = relative_error(lg_k)
    estimate = F.least(F.hll_sketch_estimate("sketch"), F.col("rows"))
    return sketches.select("attribute", estimate.alias("Count"), F.floor(estimate * (1 - error)).cast("long").alias("LowCount"),
                           F.least(F.ceil(estimate * (1 + error)).cast("long"), F.col("rows")).alias("HighCount"), F.col("rows").alias("TotalRows"))


def distinctness_estimate(sketches: DataFrame, confidence: float, lg_k: int = LG_K) -> DataFrame:
    """Distinct keys per key set and their share of the rows, estimated, with bounds of the count."""
    counts = sketch_counts(sketches, lg_k)
    return counts.select(F.col("attribute").alias("key_set"), F.col("Count").alias("DistinctCount"), ratio(F.col("Count"), F.col("TotalRows")).alias("Distinctness"),
                         F.col("LowCount").alias("DistinctLow"), F.col("HighCount").alias("DistinctHigh"), F.lit(float(confidence)).alias("Confidence"))


def population_estimate(now: DataFrame, stored: DataFrame, confidence: float, lg_k: int = LG_K) -> DataFrame:
    """Distinct values now against all that the source has shown, both estimated."""
    old = sketch_counts(stored, lg_k).select(F.col("attribute").alias("key_set"), F.col("Count").alias("stored"))
    new = sketch_counts(now, lg_k).select(F.col("attribute").alias("key_set"), F.col("Count").alias("DistinctCount"))
    return new.join(old, "key_set").select("key_set", "DistinctCount", at_most_one(ratio(F.col("DistinctCount"), F.col("stored"))).alias("CompletenessPopulationValue"),
                                           F.lit(float(confidence)).alias("Confidence"))
