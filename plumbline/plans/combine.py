"""One-row frames side by side, without a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import cell


def side_by_side(frames: Sequence[DataFrame], key: str | None = None) -> DataFrame:
    """Frames of one row each, or one row per ``key``, as one. No column but the key is in two of them."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    columns = [F.max(cell(c)).alias(c) for c in union.columns if c != key]
    return union.groupBy(key).agg(*columns) if key else union.agg(*columns)


def local(df: DataFrame) -> DataFrame:
    """A frame of few rows, computed now and held by the driver: what is built from it runs without a job."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def old_and_new(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The columns of two frames of one row each, prefixed ``old_`` and ``new_``, as one local row."""
    old, new = stored.toArrow(), batch.toArrow()
    if old.num_rows != 1 or new.num_rows != 1:
        raise ValueError(f"one row is merged with one row, got {old.num_rows} and {new.num_rows}")
    names = [f"old_{c}" for c in stored.columns] + [f"new_{c}" for c in batch.columns]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, [*stored.schema.fields, *batch.schema.fields])])
    return batch.sparkSession.createDataFrame(pa.Table.from_arrays([*old.columns, *new.columns], names=names), schema)


def named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]
