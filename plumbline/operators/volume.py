"""Volume: how many of the source's rows the selection holds, as a whole and per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import at_most_one, ratio
from ..plans.summary import KeySet, groups


def _total(total: int | Column) -> Column:
    """The number of rows before any filter: a number, or a scalar subquery."""
    return total if isinstance(total, Column) else F.lit(total)


def volume_global(total: int | Column) -> Mapping[str, Column]:
    """Metric columns over the whole-table row."""
    return {"Volume": at_most_one(ratio(F.col("rows_filled"), _total(total))),
            "Volume_TotalRows": F.col("rows_filled")}


def volume_value(summary: DataFrame, total: int | Column,
                 key_sets: Sequence[KeySet] | None = None) -> DataFrame:
    return groups(summary, key_sets).select("key_set", "key_value", F.col("rows_filled").alias("Count"),
                                            ratio(F.col("rows_filled"), _total(total)).alias("VolumeValue"))
