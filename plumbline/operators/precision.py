"""Spread of numbers relative to their mean."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import number
from ..functions.scores import precision_score, shift_for_signs
from ..plans.summary import KeySet, groups, per_attribute


class Precision:
    """Population deviation against the mean; values on both sides of 0 are shifted by their minimum."""

    def __init__(self, columns: Sequence[str], digits_only: bool = False):
        self.columns = list(columns)
        self.digits_only = digits_only

    def row_columns(self, df: DataFrame, in_scope: Column) -> Mapping[str, Column]:
        return {f"number_{i}": F.when(in_scope, number(df, c, self.digits_only))
                for i, c in enumerate(self.columns)}

    def aggregates(self) -> Sequence[Column]:
        return [a for i in range(len(self.columns)) for a in (
            F.count(f"number_{i}").alias(f"number_count_{i}"),
            F.avg(f"number_{i}").alias(f"number_mean_{i}"),
            F.stddev_pop(f"number_{i}").alias(f"number_deviation_{i}"),
            F.min(f"number_{i}").alias(f"number_min_{i}"),
            F.max(f"number_{i}").alias(f"number_max_{i}"))]

    def _shift(self, i: int) -> Column:
        return shift_for_signs(F.col(f"number_min_{i}"), F.col(f"number_max_{i}"))

    def global_metrics(self) -> Mapping[str, Column]:
        """As assessments report it: the shift is added to the absolute mean."""
        metrics = {}
        for i, c in enumerate(self.columns):
            centre = F.abs(F.col(f"number_mean_{i}")) + self._shift(i)
            metrics[f"Precision_{c}"] = precision_score(F.col(f"number_deviation_{i}"), centre)
            metrics[f"Precision_Deviation_{c}"] = F.col(f"number_deviation_{i}")
        return metrics

    def profile_metrics(self) -> Mapping[str, Column]:
        """As profiling reports it: the shift is added to the signed mean, with extremes and moments."""
        metrics = {}
        for i, c in enumerate(self.columns):
            centre = F.col(f"number_mean_{i}") + self._shift(i)
            metrics[f"Precision_{c}"] = precision_score(F.col(f"number_deviation_{i}"), centre)
            metrics[f"Precision_Deviation_{c}"] = F.col(f"number_deviation_{i}")
            metrics[f"Min_Value_{c}"] = F.col(f"number_min_{i}")
            metrics[f"Max_Value_{c}"] = F.col(f"number_max_{i}")
            metrics[f"Number_Count_{c}"] = F.col(f"number_count_{i}")
            metrics[f"Number_Mean_{c}"] = F.col(f"number_mean_{i}")
            metrics[f"Pooled_Deviation_{c}"] = F.col(f"number_deviation_{i}")
        return metrics

    def value_table(self, summary: DataFrame, key_sets: Sequence[KeySet], whole_table: DataFrame) -> DataFrame:
        """Per key, with the shift of the whole table as a scalar subquery on its row.

        A shift moves every value of a group alike, so only the group's mean needs it.
        """
        rows, tables = groups(summary, key_sets), {}
        rows = rows.withColumns({f"shift_{i}": whole_table.select(self._shift(i)).scalar()
                                 for i in range(len(self.columns))})
        for i, c in enumerate(self.columns):
            mean, deviation = F.col(f"number_mean_{i}"), F.col(f"number_deviation_{i}")
            tables[c] = ([k for k in key_sets if c not in k],
                         {"Mean": mean, "Precision": precision_score(deviation, mean + F.col(f"shift_{i}")),
                          "StandardDeviation": deviation})
        return per_attribute(rows, tables)

    def attribute_table(self, summary: DataFrame, key_sets: Sequence[KeySet], whole_table: DataFrame,
                        confidence: float) -> DataFrame:
        """Mean of the groups' values; groups with a centre of 0 have no precision to average."""
        return (self.value_table(summary, key_sets, whole_table).groupBy("key_set", "attribute")
                .agg(F.avg("Mean").alias("Mean"), F.avg("Precision").alias("Precision"),
                     F.avg("StandardDeviation").alias("StandardDeviation"))
                .withColumn("Confidence", F.lit(float(confidence))))
