"""Formulas that turn measured values into quality scores. NULL in, NULL out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import SECONDS_PER_HOUR, seconds_between


def at_least_zero(column: Column) -> Column:
    return F.when(column.isNotNull(), F.greatest(column, F.lit(0.0)))


def at_most_one(column: Column) -> Column:
    return F.when(column.isNotNull(), F.least(column, F.lit(1.0)))


def clamp01(column: Column) -> Column:
    return at_least_zero(at_most_one(column))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def accuracy_score(value: Column, mean: float, width: float) -> Column:
    """1 at the expected mean, falling to 0 at half the allowed width on either side."""
    if not width > 0:
        raise ValueError(f"the allowed interval must be wider than 0, got {width}")
    return at_least_zero(1 - F.abs((value - F.lit(float(mean))) / F.lit(float(width) / 2)))


def shift_for_signs(low: Column, high: Column) -> Column:
    """Amount that moves values on both sides of 0 to one side: ``abs(low)``, otherwise 0."""
    return F.when((low < 0) & (high > 0), F.abs(low)).otherwise(F.lit(0.0))


def precision_score(deviation: Column, centre: Column) -> Column:
    """1 without spread, 0 when the deviation reaches the centre; NULL for a centre of 0."""
    return at_least_zero(1 - ratio(deviation, F.abs(centre)))


def timeliness_score(time: Column, as_of: Column, volatility_hours: float) -> Column:
    """1 at the analysis time, 0 after the validity window, negative beyond it."""
    if not volatility_hours > 0:
        raise ValueError(f"volatility must be positive, got {volatility_hours}")
    return 1 - seconds_between(as_of, time) / F.lit(volatility_hours * SECONDS_PER_HOUR)
