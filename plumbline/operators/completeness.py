"""Missing cells, for the whole table, per attribute, per key and per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import is_missing, is_present, key_set_name
from ..functions.scores import ratio
from ..plans.summary import WHOLE_TABLE, KeySet


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(add, columns, F.lit(0))


def completeness_row(df: DataFrame, columns: Sequence[str]) -> Column:
    """Share of a row's cells that are present."""
    present = _sum([is_present(df, c).cast("int") for c in columns])
    return ratio(present, F.lit(len(columns)))


class Completeness:
    """Missing cells per column; sees all rows, in scope or not."""

    def __init__(self, columns: Sequence[str]):
        if not columns:
            raise ValueError("completeness needs at least one column")
        self.columns = list(dict.fromkeys(columns))

    def row_columns(self, df: DataFrame, in_scope: Column) -> Mapping[str, Column]:
        return {f"missing_{i}": is_missing(df, c).cast("int") for i, c in enumerate(self.columns)}

    def aggregates(self) -> Sequence[Column]:
        return [F.coalesce(F.sum(f"missing_{i}"), F.lit(0)).alias(f"missing_{i}")
                for i in range(len(self.columns))]

    def _missing(self, without: Sequence[str] = ()) -> Column:
        return _sum([F.col(f"missing_{i}") for i, c in enumerate(self.columns) if c not in without])

    def global_metrics(self) -> Mapping[str, Column]:
        cells = F.col("rows") * len(self.columns)
        return {"Completeness_Missing": ratio(cells - self._missing(), cells)}

    def attribute_table(self, summary: DataFrame, key_sets: Sequence[KeySet], confidence: float) -> DataFrame:
        """Per key set, from the whole-table row: a key of several columns is one text, never missing."""
        entries = []
        for columns in key_sets:
            missing = (F.col(f"missing_{self.columns.index(columns[0])}") if len(columns) == 1
                       else F.lit(0).cast("long"))
            entries.append(F.struct(
                F.lit(key_set_name(columns)).alias("key_set"), missing.alias("MissingValues"),
                ratio(F.col("rows") - missing, F.col("rows")).alias("CompletenessMissingValue"),
                F.lit(float(confidence)).alias("Confidence")))
        return summary.filter(F.col("key_set") == WHOLE_TABLE).select(F.inline(F.array(*entries)))

    def value_table(self, summary: DataFrame, key_sets: Sequence[KeySet]) -> DataFrame:
        """Per key, over the columns that are not part of it; groups with a missing key are left out."""
        cases_missing, cases_cells = [], []
        for columns in key_sets:
            chosen = F.col("key_set") == key_set_name(columns)
            others = len([c for c in self.columns if c not in columns])
            cases_missing.append(F.when(chosen, self._missing(without=columns)))
            cases_cells.append(F.when(chosen, F.col("rows") * others))
        missing, cells = F.coalesce(*cases_missing), F.coalesce(*cases_cells)
        return (summary.filter(F.col("key_set").isin([key_set_name(k) for k in key_sets]) & ~F.col("key_missing"))
                .select("key_set", "key_value", missing.cast("long").alias("MissingValues"),
                        ratio(cells - missing, cells).alias("CompletenessMissingValue")))
