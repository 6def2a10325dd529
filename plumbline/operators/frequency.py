"""Rows that arrived against the rows an update rate lets expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import key_cell, key_set_name, key_text
from ..functions.scores import at_most_one, clamp01, ratio
from ..functions.times import SECONDS_PER_HOUR, seconds_between, timestamp
from ..plans.summary import KeySet, aggregate_sets, by_set, distinct_key_sets


def frequency_hour(df: DataFrame, column: str, rates: DataFrame, time_format: str | None = None,
                   sample: float = 1.0, per_day: bool = True) -> DataFrame:
    """Per hour of day: rows against ``Frequency`` (rows per second) over the days that hour covers.

    ``rates`` has ``Hour`` and ``Frequency``; an hour listed twice counts with its highest rate.
    ``per_day=False`` is profiling's form, which takes the batch as a single day.
    """
    counts = (df.select(timestamp(df, column, time_format).alias("time")).filter("time IS NOT NULL")
              .groupBy(F.hour("time").alias("Hour"))
              .agg(F.count(F.lit(1)).alias("RecordNumber"),
                   (F.datediff(F.max("time"), F.min("time")) + 1).alias("days")))
    hourly = rates.groupBy(F.col("Hour").cast("int").alias("Hour")).agg(F.max("Frequency").alias("Frequency"))
    days = F.col("days") if per_day else F.lit(1)
    expected = F.col("Frequency") * days * F.lit(float(sample) * SECONDS_PER_HOUR)
    # There are at most 24 hours of day, so this side may be broadcast whatever the data's size.
    return (hourly.join(F.broadcast(counts), "Hour")
            .select("Hour", "RecordNumber",
                    clamp01(ratio(F.col("RecordNumber"), expected)).alias("CompletenessFrequency")))


def frequency_global(hours: DataFrame, column: str) -> DataFrame:
    return hours.agg(F.avg("CompletenessFrequency").alias(f"Completeness_Frequency_{column}"))


def frequency_value(df: DataFrame, column: str, key_sets: Sequence[KeySet], rates: DataFrame,
                    time_format: str | None = None, sample: float = 1.0) -> DataFrame:
    """Per key: rows against the rate expected between the oldest and the newest of them.

    ``rates`` has ``Key`` (name of the key set), ``Value``, ``Hour`` and ``Frequency``. Only rows whose key
    and hour have a rate count. Rows are counted per key and hour before the join, so it moves groups, not
    rows, and a hot key is 24 rows at most. Keys seen at a single instant or without a rate are left out.
    """
    sets = distinct_key_sets([k for k in key_sets if column not in k])
    if not sets:
        raise ValueError("frequency per key needs a key set without the measured column")
    names = list(dict.fromkeys(c for k in sets for c in k))
    position = {n: i for i, n in enumerate(names)}
    rows = (df.select(*[key_cell(df, n).alias(f"key_{i}") for i, n in enumerate(names)],
                      timestamp(df, column, time_format).alias("time")).filter("time IS NOT NULL")
            .withColumn("Hour", F.hour("time")))
    keys = [[f"key_{position[c]}" for c in k] for k in sets]
    counted = aggregate_sets(rows, [[*k, "Hour"] for k in keys], [
        F.count(F.lit(1)).alias("n"), F.min("time").alias("first"), F.max("time").alias("last")])
    labelled = counted.select(by_set([F.lit(key_set_name(k)) for k in sets]).alias("key_set"),
                              by_set([key_text(k) for k in keys]).alias("key_value"), "Hour", "n", "first", "last")
    rated = (rates.groupBy(F.col("Key").alias("key_set"), F.col("Value").cast("string").alias("key_value"),
                           F.col("Hour").cast("int").alias("Hour"))
             .agg(F.max("Frequency").alias("Frequency")))
    per_key = (labelled.join(rated, ["key_set", "key_value", "Hour"]).groupBy("key_set", "key_value")
               .agg(F.sum("n").alias("RecordNumber"), F.avg("Frequency").alias("frequency"),
                    seconds_between(F.max("last"), F.min("first")).alias("seconds")))
    expected = F.col("seconds") * F.lit(float(sample)) * F.col("frequency")
    return (per_key.filter(F.col("seconds") * F.col("frequency") != 0)
            .select("key_set", "key_value", F.lit(column).alias("attribute"), "RecordNumber",
                    at_most_one(ratio(F.col("RecordNumber"), expected)).alias("CompletenessFrequencyValue")))


def frequency_attribute(values: DataFrame, confidence: float) -> DataFrame:
    return (values.groupBy("key_set", "attribute")
            .agg(F.sum("RecordNumber").alias("RecordNumber"),
                 F.avg("CompletenessFrequencyValue").alias("CompletenessFrequencyValue"))
            .withColumn("Confidence", F.lit(float(confidence))))
