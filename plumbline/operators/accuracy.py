"""Distance of numbers from an expected mean, relative to the allowed interval."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import number
from ..functions.scores import accuracy_score
from ..plans.summary import KeySet, groups, per_attribute


@dataclass(frozen=True)
class Expected:
    """The mean a column should have and the full width of the interval allowed around it."""

    column: str
    mean: float
    width: float


class Accuracy:
    """Dynamic accuracy is the mean score, static accuracy the share of rows inside the interval."""

    def __init__(self, expected: Sequence[Expected]):
        self.expected = list(expected)

    def row_columns(self, df: DataFrame, in_scope: Column) -> Mapping[str, Column]:
        return {f"accuracy_{i}": F.when(in_scope, accuracy_score(number(df, e.column), e.mean, e.width))
                for i, e in enumerate(self.expected)}

    def aggregates(self) -> Sequence[Column]:
        return [a for i in range(len(self.expected)) for a in (
            F.avg(f"accuracy_{i}").alias(f"accuracy_dynamic_{i}"),
            F.avg(F.ceil(f"accuracy_{i}")).alias(f"accuracy_static_{i}"))]

    def global_metrics(self) -> Mapping[str, Column]:
        metrics = {}
        for i, e in enumerate(self.expected):
            metrics[f"Accuracy_Static_{e.column}"] = F.col(f"accuracy_static_{i}")
            metrics[f"Accuracy_Dynamic_{e.column}"] = F.col(f"accuracy_dynamic_{i}")
        return metrics

    def value_table(self, summary: DataFrame, key_sets: Sequence[KeySet]) -> DataFrame:
        tables = {e.column: ([k for k in key_sets if e.column not in k],
                             {"AccuracyDynamic": F.col(f"accuracy_dynamic_{i}"),
                              "AccuracyStatic": F.col(f"accuracy_static_{i}")})
                  for i, e in enumerate(self.expected)}
        return per_attribute(groups(summary, key_sets), tables)

    def attribute_table(self, summary: DataFrame, key_sets: Sequence[KeySet], confidence: float) -> DataFrame:
        """Mean of the groups' values, each group counting once."""
        return (self.value_table(summary, key_sets).groupBy("key_set", "attribute")
                .agg(F.avg("AccuracyDynamic").alias("AccuracyDynamic"),
                     F.avg("AccuracyStatic").alias("AccuracyStatic"))
                .withColumn("Confidence", F.lit(float(confidence))))
