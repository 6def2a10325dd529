from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.plans.staging import staging_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark) -> str:
    """A fresh folder below the cluster's checkpoint folder; a temporary one only if none is set and the driver runs the tasks."""
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    return staging_folder(spark, tempfile.gettempdir() if local else None)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, times as text, so that results compare by value."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            column = F.round(column, DIGITS)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("long")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def one_row(df: DataFrame, metrics) -> DataFrame:
    return rounded(df.select(*[c.alias(n) for n, c in metrics.items()]))


# SQL text shared by the checks

def sql_key(columns: Sequence[str]) -> str:
    return " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns)


def union(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def r6(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), {DIGITS})"


def clamp(expression: str, low: bool = True, high: bool = True) -> str:
    if high:
        expression = f"least({expression}, 1.0)"
    if low:
        expression = f"greatest({expression}, 0.0)"
    return expression
