"""Types of text columns and the dimensions each column qualifies for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import cell, is_missing, is_text, text_to_number
from ..functions.times import parse_time

FLOAT, DATETIME, STRING, ALL = "float", "datetime", "string", "all"
COUNTS_PER_SCAN = 120           # of one scan that infers types

# The column types each dimension can be measured on.
ALLOWED_TYPES = {
    "Completeness_Missing": (ALL,),
    "Completeness_Frequency": (DATETIME,),
    "Accuracy": (FLOAT,),
    "Completeness_Population": (FLOAT, STRING),
    "Volume": (FLOAT, STRING),
    "Precision": (FLOAT,),
    "Consistency": (ALL,),
    "Timeliness": (DATETIME,),
    "Distinctness": (FLOAT, STRING),
}
DIMENSIONS = tuple(ALLOWED_TYPES)


@dataclass(frozen=True)
class ColumnTypes:
    """Type of each column, and the time format of the text columns that hold times."""

    kinds: Mapping[str, str]
    formats: Mapping[str, str] = field(default_factory=dict)

    def of_kind(self, *kinds: str) -> list[str]:
        return [c for c, k in self.kinds.items() if k in kinds or ALL in kinds]

    def is_time(self, column: str) -> bool:
        return self.kinds.get(column) == DATETIME

    def columns_for(self, dimension: str) -> list[str]:
        """Columns a dimension applies to: those of any of its types, all of them for ``all``."""
        return self.of_kind(*ALLOWED_TYPES[dimension])


def declared_kind(data_type: T.DataType) -> str | None:
    """Kind of a typed column, None for a text whose content has to tell."""
    if is_text(data_type):
        return None
    if isinstance(data_type, T.NumericType):
        return FLOAT
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return DATETIME
    return STRING


Candidates = Mapping[str, Sequence[str]]


def all_candidates(columns: Sequence[str], time_formats: Sequence[str]) -> dict[str, list[str]]:
    """Types to try per column, in order of preference: ``float``, then the time formats."""
    return {c: [FLOAT, *time_formats] for c in columns}


def _order(candidates: Candidates) -> list[str]:
    """All candidates of any column, each in its place of preference."""
    return list(dict.fromkeys(c for tried in candidates.values() for c in tried))


def candidate_counts(df: DataFrame, candidates: Candidates) -> DataFrame:
    """Per text column its ``filled`` cells, and in ``read_<n>`` how many of them read as candidate ``n``.

    Cells are counted where they are read, without a row or a group per cell: one scan for every ``COUNTS_PER_SCAN`` counts, so that
    generated code stays small however many columns there are.
    """
    order, columns = _order(candidates), list(candidates)
    per_scan = max(1, COUNTS_PER_SCAN // (1 + len(order)))
    frames = [_counts_of(df, columns[i:i + per_scan], candidates, order) for i in range(0, len(columns), per_scan)]
    return reduce(DataFrame.unionByName, frames)


def _counts_of(df: DataFrame, columns: Sequence[str], candidates: Candidates, order: Sequence[str]) -> DataFrame:
    counters, rows = [], []
    for i, c in enumerate(columns):
        value = F.when(~is_missing(df, c), cell(c))
        counters.append(F.count(value).alias(f"filled_{i}"))
        for n, candidate in enumerate(order):
            read = F.lit(None) if candidate not in candidates[c] else text_to_number(value) if candidate == FLOAT else parse_time(value, candidate)
            counters.append(F.count(read).alias(f"read_{i}_{n}"))
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"filled_{i}").alias("filled"),
                             *[F.col(f"read_{i}_{n}").alias(f"read_{n}") for n in range(len(order))]))
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def inferred_types(df: DataFrame, candidates: Candidates) -> DataFrame:
    """``column, type, format`` of text columns: the first candidate that reads all filled cells, else string.

    Missing cells do not count; a column without a filled cell is a string.
    """
    kind = F.when(F.col("filled") == 0, _type(STRING))
    for n, candidate in enumerate(_order(candidates)):
        found = _type(FLOAT) if candidate == FLOAT else _type(DATETIME, candidate)
        kind = kind.when(F.col(f"read_{n}") == F.col("filled"), found)
    kind = kind.otherwise(_type(STRING))
    return candidate_counts(df, candidates).select("column", kind["type"].alias("type"), kind["format"].alias("format"))


def _type(kind: str, time_format: str | None = None) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit(time_format).cast("string").alias("format"))


def not_refuted(df: DataFrame, candidates: Candidates, rows: int) -> dict[str, list[str]]:
    """Candidates that the first rows do not already refute. One unreadable cell is proof, so this loses nothing."""
    left = {c: list(tried) for c, tried in candidates.items()}
    for counts in candidate_counts(df.limit(rows), candidates).collect():       # one row per column
        left[counts["column"]] = [c for n, c in enumerate(_order(candidates)) if counts[f"read_{n}"] == counts["filled"]
                                  and c in candidates[counts["column"]]]
    return left


def type_table(df: DataFrame, columns: Sequence[str], time_formats: Sequence[str], probe_rows: int = 1000) -> DataFrame:
    """``column, type, format`` of text columns from their whole content.

    A look at the first rows drops most candidates, so that the pass over the data only tries those left.
    """
    return inferred_types(df, not_refuted(df, all_candidates(columns, time_formats), probe_rows))


def infer_types(df: DataFrame, time_formats: Sequence[str] = (), probe_rows: int = 1000) -> ColumnTypes:
    """Types of all columns: declared ones from the schema, texts from their content."""
    kinds = {f.name: declared_kind(f.dataType) for f in df.schema.fields}
    texts = [c for c, k in kinds.items() if k is None]
    kinds |= {c: STRING for c in texts}
    formats = {}
    if texts:
        for row in type_table(df, texts, time_formats, probe_rows).collect():       # one row per column
            kinds[row["column"]] = row["type"]
            if row["format"]:
                formats[row["column"]] = row["format"]
    return ColumnTypes(kinds, formats)


def dimension_columns(types: ColumnTypes) -> dict[str, list[str]]:
    return {dimension: types.columns_for(dimension) for dimension in DIMENSIONS}
