"""Which columns and rows of a source an assessment looks at."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import all_filled, cell, dtype, is_text, number, typed_name
from ..functions.times import range_end, timestamp
from .inference import DATETIME, FLOAT, ColumnTypes


@dataclass(frozen=True)
class Range:
    """A range with its ends included; None leaves an end open."""

    low: str | None = None
    high: str | None = None

    @classmethod
    def parse(cls, text: str) -> "Range":
        low, colon, high = text.partition(":")
        if not colon or not (low or high):
            raise ValueError(f"a range is written low:high with one end at least, got {text!r}")
        return cls(low or None, high or None)


def _in_range(value: Column, end, limits: Range) -> Column:
    conditions = []
    if limits.low is not None:
        conditions.append(value >= end(limits.low))
    if limits.high is not None:
        conditions.append(value <= end(limits.high))
    return reduce(and_, conditions)


def in_ranges(df: DataFrame, name: str, ranges: Sequence[Range], types: ColumnTypes) -> Column:
    """Row is in one of the ranges: times by ``dd/mm/yyyy HH.MM.SS`` ends, numbers as numbers, texts as texts."""
    kind, typed_column = types.kinds.get(name), typed_name(name)
    if typed_column in df.columns:
        # A stored companion: the predicate reaches the scan.
        ends = range_end if kind == DATETIME else lambda end: F.lit(float(end.replace(",", ".")))      # noqa: E731
        limits = [_in_range(cell(typed_column), ends, r) for r in ranges]
    elif kind == DATETIME:
        if is_text(dtype(df, name)):
            value = timestamp(df, name, types.formats.get(name))
            limits = [_in_range(value, range_end, r) for r in ranges]
        else:
            # Compare in the column's own type, so that the predicate reaches the scan; a date has no
            # time of day and is compared as its midnight.
            own = dtype(df, name)
            own = T.TimestampType() if isinstance(own, T.DateType) else own
            value = timestamp(df, name) if isinstance(own, T.DateType) else cell(name)
            limits = [_in_range(value, lambda end: range_end(end).cast(own), r) for r in ranges]
    elif kind == FLOAT:
        typed = not is_text(dtype(df, name))
        value = cell(name) if typed else number(df, name)
        limits = [_in_range(value, lambda end: F.lit(float(end.replace(",", "."))), r) for r in ranges]
    else:
        limits = [_in_range(cell(name).cast("string"), F.lit, r) for r in ranges]
    return reduce(or_, limits)


def _number(text: str) -> float | None:
    try:
        return float(text.replace(",", "."))
    except ValueError:
        return None


def in_values(df: DataFrame, name: str, values: Sequence[str], types: ColumnTypes) -> Column:
    """Row has one of the listed values: as a number in a column of numbers, typed or text, as text in other texts, and in the column's type
    otherwise. A listed text that is no number is in no column of numbers."""
    own = dtype(df, name)
    if is_text(own) and types.kinds.get(name) == FLOAT:
        numbers = [n for n in map(_number, values) if n is not None]
        # A stored companion reaches the scan.
        value = cell(typed_name(name)) if typed_name(name) in df.columns else number(df, name)
        return value.isin(numbers) if numbers else F.lit(False)
    if is_text(own):
        return cell(name).isin(list(values))
    return cell(name).isin([F.lit(v).cast(own.simpleString()) for v in values])


def select_rows(df: DataFrame, columns: Sequence[str], ranges: Mapping[str, Sequence[Range]],
                values: Mapping[str, Sequence[str]], types: ColumnTypes) -> DataFrame:
    """The selected columns of the rows that satisfy every column's ranges and value list.

    Conditions on different columns must all hold, ranges of one column are alternatives, rows without a
    value in a restricted column are left out, and no row comes twice.
    """
    unknown = (set(ranges) | set(values)) - set(columns)
    if unknown:
        raise ValueError(f"ranges or values for columns that are not selected: {sorted(unknown)}")
    for name, limits in ranges.items():
        if limits:
            df = df.filter(cell(name).isNotNull() & in_ranges(df, name, limits, types))
    for name, listed in values.items():
        if listed:
            df = df.filter(cell(name).isNotNull() & in_values(df, name, listed, types))
    return df.select(*[cell(c) for c in columns])


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Random rows without replacement; the fraction is the confidence of what is computed from them."""
    if not 0 < fraction <= 1:
        raise ValueError(f"the sampled fraction must be in (0, 1], got {fraction}")
    return df if fraction == 1 else df.sample(False, fraction, seed)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with no NULL in any of the columns."""
    return df.filter(all_filled(columns))
