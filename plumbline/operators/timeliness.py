"""Age of timestamps against the time they stay valid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import at_least_zero, timeliness_score
from ..functions.times import DEFAULT_VOLATILITY_HOURS, timestamp
from ..plans.summary import KeySet, groups, per_attribute


@dataclass(frozen=True)
class Validity:
    """A timestamp column, the format of its texts if it is one, and its validity window in hours."""

    column: str
    time_format: str | None = None
    volatility_hours: float = DEFAULT_VOLATILITY_HOURS


def timeliness_row(df: DataFrame, validity: Validity, as_of: Column) -> Column:
    """Score of one row, between 0 and 1 for past times; a time that cannot be read scores 0."""
    score = timeliness_score(timestamp(df, validity.column, validity.time_format), as_of,
                             validity.volatility_hours)
    return F.coalesce(at_least_zero(score), F.lit(0.0))


class Timeliness:
    """Scores may be negative until they are reported, so that means weigh old rows by their age."""

    def __init__(self, validities: Sequence[Validity], as_of: Column):
        self.validities = list(validities)
        self.as_of = as_of

    def row_columns(self, df: DataFrame, in_scope: Column) -> Mapping[str, Column]:
        return {f"score_{i}": F.when(in_scope, timeliness_score(
                    timestamp(df, v.column, v.time_format), self.as_of, v.volatility_hours))
                for i, v in enumerate(self.validities)}

    def aggregates(self) -> Sequence[Column]:
        return [a for i in range(len(self.validities)) for a in (
            F.avg(f"score_{i}").alias(f"score_mean_{i}"),
            F.max(f"score_{i}").alias(f"score_max_{i}"),
            F.min(f"score_{i}").alias(f"score_min_{i}"))]

    def global_metrics(self) -> Mapping[str, Column]:
        metrics = {}
        for i, v in enumerate(self.validities):
            for name in ("mean", "max", "min"):
                metrics[f"Timeliness_{name.title()}_{v.column}"] = at_least_zero(F.col(f"score_{name}_{i}"))
            metrics[f"Last_Analysis_Timestamp_{v.column}"] = self.as_of
        return metrics

    def value_table(self, summary: DataFrame, key_sets: Sequence[KeySet], clamp: bool = True) -> DataFrame:
        tables = {}
        for i, v in enumerate(self.validities):
            metrics = {f"Timeliness{name.title()}": F.col(f"score_{name}_{i}") for name in ("mean", "max", "min")}
            if clamp:
                metrics = {n: at_least_zero(c) for n, c in metrics.items()}
            tables[v.column] = ([k for k in key_sets if v.column not in k], metrics)
        return per_attribute(groups(summary, key_sets), tables).withColumn("AnalysisTime", self.as_of)

    def attribute_table(self, summary: DataFrame, key_sets: Sequence[KeySet], confidence: float) -> DataFrame:
        """Mean of means, max of maxima and min of minima over the groups, clamped at the end."""
        return (self.value_table(summary, key_sets, clamp=False).groupBy("key_set", "attribute")
                .agg(at_least_zero(F.avg("TimelinessMean")).alias("TimelinessMean"),
                     at_least_zero(F.max("TimelinessMax")).alias("TimelinessMax"),
                     at_least_zero(F.min("TimelinessMin")).alias("TimelinessMin"))
                .withColumn("Confidence", F.lit(float(confidence)))
                .withColumn("AnalysisTime", self.as_of))


class RowTimeliness:
    """As profiling reports it: every row is clamped at 0 and unreadable times count as 0."""

    def __init__(self, validities: Sequence[Validity], as_of: Column):
        self.validities = list(validities)
        self.as_of = as_of

    def row_columns(self, df: DataFrame, in_scope: Column) -> Mapping[str, Column]:
        columns = {}
        for i, v in enumerate(self.validities):
            columns[f"row_score_{i}"] = timeliness_row(df, v, self.as_of)
            columns[f"time_{i}"] = timestamp(df, v.column, v.time_format)
        return columns

    def aggregates(self) -> Sequence[Column]:
        return [a for i in range(len(self.validities)) for a in (
            F.avg(f"row_score_{i}").alias(f"row_score_mean_{i}"),
            F.max(f"row_score_{i}").alias(f"row_score_max_{i}"),
            F.min(f"row_score_{i}").alias(f"row_score_min_{i}"),
            F.min(f"time_{i}").alias(f"time_min_{i}"),
            F.max(f"time_{i}").alias(f"time_max_{i}"))]

    def profile_metrics(self) -> Mapping[str, Column]:
        metrics = {}
        for i, v in enumerate(self.validities):
            readable = F.col(f"time_max_{i}").isNotNull()
            metrics[f"Minimum_Timestamp_{v.column}"] = F.col(f"time_min_{i}")
            metrics[f"Maximum_Timestamp_{v.column}"] = F.col(f"time_max_{i}")
            for name in ("mean", "max", "min"):
                metrics[f"Timeliness_{name.title()}_{v.column}"] = F.when(
                    readable, F.col(f"row_score_{name}_{i}"))
            metrics[f"Last_Analysis_Timestamp_{v.column}"] = F.when(readable, self.as_of)
        return metrics
