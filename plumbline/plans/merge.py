"""Quality of a source after a batch, from its stored quality and the batch's own."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import cell
from ..functions.scores import at_least_zero, ratio
from ..functions.times import SECONDS_PER_HOUR, seconds_between
from .combine import old_and_new

ROWS = "Volume_TotalRows"
UPDATES = "UpdatesCount"


@dataclass(frozen=True)
class Pair:
    """Stored and new metrics side by side; names the stored row lacks are NULL."""

    stored_names: frozenset[str]
    as_of: Column

    def old(self, name: str) -> Column:
        return cell(f"old_{name}") if name in self.stored_names else F.lit(None).cast("double")

    def new(self, name: str) -> Column:
        return cell(f"new_{name}")

    @property
    def old_rows(self) -> Column:
        return F.coalesce(self.old(ROWS), F.lit(0))

    @property
    def new_rows(self) -> Column:
        return self.new(ROWS)

    def mean(self, old: Column, new: Column) -> Column:
        """Mean weighted by rows; a side without a value leaves the other's."""
        return F.coalesce(ratio(old * self.old_rows + new * self.new_rows, self.old_rows + self.new_rows), new, old)


MergeRule = Callable[[Pair, str], Column]


def weighted(pair: Pair, name: str) -> Column:
    return pair.mean(pair.old(name), pair.new(name))


def lowest(pair: Pair, name: str) -> Column:
    return F.least(pair.old(name), pair.new(name))


def highest(pair: Pair, name: str) -> Column:
    return F.greatest(pair.old(name), pair.new(name))


def earliest(pair: Pair, name: str) -> Column:
    return F.least(pair.old(name).cast("timestamp"), pair.new(name))


def latest(pair: Pair, name: str) -> Column:
    return F.greatest(pair.old(name).cast("timestamp"), pair.new(name))


def added(pair: Pair, name: str) -> Column:
    return (F.coalesce(pair.old(name), F.lit(0)) + F.coalesce(pair.new(name), F.lit(0))).cast("long")


def replaced(pair: Pair, name: str) -> Column:
    return F.coalesce(pair.new(name), pair.old(name))


def analysed_now(pair: Pair, name: str) -> Column:
    return pair.as_of


def decayed(column: str, volatility_hours: float, how: str) -> MergeRule:
    """Stored timeliness has aged since the last analysis; it never falls below 0."""

    def rule(pair: Pair, name: str) -> Column:
        since = seconds_between(pair.as_of, pair.old(f"Last_Analysis_Timestamp_{column}").cast("timestamp"))
        old = at_least_zero(pair.old(name) - since / F.lit(volatility_hours * SECONDS_PER_HOUR))
        new = pair.new(name)
        return {"mean": pair.mean(old, new), "max": F.greatest(old, new), "min": F.least(old, new)}[how]

    return rule


def pooled(column: str, what: str) -> MergeRule:
    """Mean and deviation over the rows of both sides, from counts, means and deviations."""

    def rule(pair: Pair, name: str) -> Column:
        n_old = F.coalesce(pair.old(f"Number_Count_{column}"), F.lit(0)).cast("double")
        n_new = F.coalesce(pair.new(f"Number_Count_{column}"), F.lit(0)).cast("double")
        total = n_old + n_new
        m_old, m_new = pair.old(f"Number_Mean_{column}"), pair.new(f"Number_Mean_{column}")
        if what == "mean":
            return F.coalesce(ratio(n_old * m_old + n_new * m_new, total), m_new, m_old)
        s_old, s_new = pair.old(name), pair.new(name)
        within = n_old * s_old * s_old + n_new * s_new * s_new
        between = ratio(n_old * n_new, total) * (m_new - m_old) * (m_new - m_old)
        return F.coalesce(F.sqrt(ratio(within + between, total)), s_new, s_old)

    return rule


def precision_rules(columns: Sequence[str]) -> dict[str, MergeRule]:
    rules: dict[str, MergeRule] = {}
    for c in columns:
        rules |= {f"Precision_{c}": weighted, f"Precision_Deviation_{c}": weighted, f"Min_Value_{c}": lowest,
                  f"Max_Value_{c}": highest, f"Number_Count_{c}": added, f"Number_Mean_{c}": pooled(c, "mean"),
                  f"Pooled_Deviation_{c}": pooled(c, "deviation")}
    return rules


def timeliness_rules(columns: Sequence[str], volatility_hours: float) -> dict[str, MergeRule]:
    rules: dict[str, MergeRule] = {}
    for c in columns:
        rules |= {f"Minimum_Timestamp_{c}": earliest, f"Maximum_Timestamp_{c}": latest,
                  f"Last_Analysis_Timestamp_{c}": analysed_now}
        rules |= {f"Timeliness_{how.title()}_{c}": decayed(c, volatility_hours, how) for how in ("mean", "max", "min")}
    return rules


def distinctness_rules(columns: Sequence[str]) -> dict[str, MergeRule]:
    return {f"{metric}_{c}": replaced for c in columns for metric in ("Distinctness", "Distinct_Number")}


def merge_quality(stored: DataFrame | None, batch: DataFrame, rules: Mapping[str, MergeRule],
                  as_of: Column) -> DataFrame:
    """One row with the source's quality after the batch.

    ``batch`` is one row with ``source``, ``Volume_TotalRows`` and a column for every rule; ``stored`` the row
    this function gave for the batches before, or None for the first batch, which is then stored as it is. Both rows are
    computed here and merged on the driver.
    """
    if stored is None:
        return batch.select("source", F.lit(1).cast("long").alias(UPDATES), ROWS, *[cell(n) for n in rules])
    names = [c for c in stored.columns if c != "source"]
    pair = Pair(frozenset(names), as_of)
    types = {f.name: f.dataType for f in batch.schema.fields}

    def merged(name: str, rule: MergeRule) -> Column:
        kind = types[name]
        return rule(pair, name).cast(T.TimestampType() if isinstance(kind, T.TimestampType) else kind).alias(name)

    # A metric that is no longer measured keeps its stored value.
    kept = [pair.old(n).alias(n) for n in names if n not in rules and n not in (UPDATES, ROWS)]
    return old_and_new(stored, batch).select(
        F.col("new_source").alias("source"), (pair.old(UPDATES) + 1).alias(UPDATES), (pair.old_rows + pair.new_rows).alias(ROWS),
        *[merged(n, r) for n, r in rules.items()], *kept)
