"""One scan of the data for every measure, key set and the whole table.

A measure says which per-row columns it needs and how they aggregate. ``summarise`` projects those
columns once, below the Expand that grouping sets add, and aggregates them for each key set and for the
whole table together. The result is one row per group with partial statistics; the metric tables of all
measures are projections of it. Every aggregate is algebraic, so hot groups are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import all_filled, is_missing, key_cell, key_set_name, key_text

WHOLE_TABLE = ""                # key_set of the whole-table row
SETS_PER_SCAN = 12              # Expand copies each row once per set; more sets take another scan
KEYS_PER_SCAN = 60              # bits of a grouping id that are used

KeySet = Sequence[str]


class Measure(Protocol):
    """What a dimension needs from the summary scan."""

    def row_columns(self, df: DataFrame, in_scope: Column) -> Mapping[str, Column]:
        """Per-row columns; those of rows out of scope are NULL."""

    def aggregates(self) -> Sequence[Column]:
        """Named aggregates over the per-row columns."""


def distinct_key_sets(key_sets: Sequence[KeySet]) -> list[tuple[str, ...]]:
    sets = list(dict.fromkeys(tuple(k) for k in key_sets))
    for columns in sets:
        if not columns or len(set(columns)) != len(columns):
            raise ValueError(f"a key set needs one or more different columns, got {columns}")
    names = [key_set_name(columns) for columns in sets]
    if len(set(names)) != len(names):
        raise ValueError(f"key sets share a name: {sorted(names)}")
    return sets


def aggregate_sets(rows: DataFrame, sets: Sequence[Sequence[str]], aggregates: Sequence[Column],
                   sets_per_scan: int = SETS_PER_SCAN) -> DataFrame:
    """Aggregate by every set of columns; ``set_no`` is the set's place in ``sets``.

    One scan serves up to ``sets_per_scan`` sets. Sets of the same columns in another order share their groups.
    Columns that are not in a row's set are NULL.
    """
    places: dict[frozenset[str], list[int]] = {}
    for i, columns in enumerate(sets):
        places.setdefault(frozenset(columns), []).append(i)
    unique = [sets[found[0]] for found in places.values()]
    frames = [_aggregate_chunk(rows, chunk, [places[frozenset(c)] for c in chunk], aggregates)
              for chunk in _chunks(unique, sets_per_scan)]
    grouped = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if len(unique) == len(sets):
        return grouped.withColumn("set_no", F.col("set_nos")[0]).drop("set_nos")
    return grouped.withColumn("set_no", F.explode("set_nos")).drop("set_nos")


def _chunks(sets: Sequence[Sequence[str]], sets_per_scan: int) -> list[list[Sequence[str]]]:
    """Sets in order, so many at a time that their columns fit the bits of a grouping id."""
    chunks: list[list[Sequence[str]]] = []
    for columns in sets:
        full = not chunks or len(chunks[-1]) == sets_per_scan
        if full or len({c for s in [*chunks[-1], columns] for c in s}) > KEYS_PER_SCAN:
            chunks.append([])
        chunks[-1].append(columns)
    return chunks


def _aggregate_chunk(rows: DataFrame, sets: Sequence[Sequence[str]], places: Sequence[Sequence[int]],
                     aggregates: Sequence[Column]) -> DataFrame:
    numbers = [F.array(*[F.lit(i) for i in found]) for found in places]
    if len(sets) == 1:
        return rows.groupBy(*sets[0]).agg(*aggregates).withColumn("set_nos", numbers[0])
    keys = list(dict.fromkeys(c for columns in sets for c in columns))
    grouped = (rows.groupingSets([list(columns) for columns in sets], *keys)
               .agg(F.grouping_id().cast("long").alias("grouping"), *aggregates))
    # The grouping id has the bit of every key outside the set, the first key highest.
    ids = [sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in columns) for columns in sets]
    chosen = F.coalesce(*[F.when(F.col("grouping") == i, n) for i, n in zip(ids, numbers)])
    return grouped.withColumn("set_nos", chosen).drop("grouping")


def by_set(values: Sequence[Column]) -> Column:
    """The value that belongs to the row's set, given one per set."""
    return F.coalesce(*[F.when(F.col("set_no") == i, v) for i, v in enumerate(values)])


def summarise(df: DataFrame, measures: Sequence[Measure], key_sets: Sequence[KeySet] = (),
              whole_table: bool = False, scope: Sequence[str] | None = None,
              sets_per_scan: int = SETS_PER_SCAN) -> DataFrame:
    """Statistics per group: ``key_set, key_value, key_missing, rows, rows_filled`` and the aggregates.

    ``scope`` names the columns that must all be filled for a row to count in the measures (``rows_filled``
    counts such rows); without it every row counts. Measures that look at missing cells use all rows.
    """
    sets: list[tuple[str, ...]] = distinct_key_sets(key_sets)
    if whole_table:
        sets.append(())
    if not sets:
        raise ValueError("nothing to summarise: no key set and no whole table")
    names = list(dict.fromkeys(c for columns in sets for c in columns))

    in_scope = all_filled(scope) if scope else F.lit(True)
    columns: dict[str, Column] = {"filled_row": F.when(in_scope, F.lit(1))}
    for measure in measures:
        columns.update(measure.row_columns(df, in_scope))
    rows = df.select(*[key_cell(df, n).alias(f"key_{i}") for i, n in enumerate(names)],
                     *[column.alias(name) for name, column in columns.items()])
    key = {n: f"key_{i}" for i, n in enumerate(names)}
    aggregates = [F.count(F.lit(1)).alias("rows"), F.count("filled_row").alias("rows_filled"),
                  *[a for measure in measures for a in measure.aggregates()]]
    grouped = aggregate_sets(rows, [[key[c] for c in columns] for columns in sets], aggregates, sets_per_scan)
    # A key of several columns is one text and never missing.
    missing = [is_missing(grouped, key[columns[0]]) if len(columns) == 1 else F.lit(False) for columns in sets]
    statistics = [c for c in grouped.columns if c != "set_no" and c not in key.values()]
    return grouped.select(by_set([F.lit(key_set_name(columns)) for columns in sets]).alias("key_set"),
                          by_set([key_text([key[c] for c in columns]) for columns in sets]).alias("key_value"),
                          by_set(missing).alias("key_missing"), *statistics)


def whole(summary: DataFrame) -> DataFrame:
    """The whole-table row of a summary."""
    return summary.filter(F.col("key_set") == WHOLE_TABLE)


def groups(summary: DataFrame, key_sets: Sequence[KeySet] | None = None) -> DataFrame:
    """The groups of a summary that hold rows in scope, of all or of the given key sets."""
    found = summary.filter((F.col("key_set") != WHOLE_TABLE) & (F.col("rows_filled") > 0))
    if key_sets is None:
        return found
    return found.filter(F.col("key_set").isin([key_set_name(k) for k in key_sets]))


def per_attribute(rows: DataFrame, tables: Mapping[str, tuple[Sequence[KeySet], Mapping[str, Column]]],
                  keep: Sequence[str] = ("key_set", "key_value")) -> DataFrame:
    """Long form: one row per (row, measured column), without key sets that do not apply to it.

    ``tables`` maps each measured column to the key sets it is measured for and its metric columns.
    """
    entries = []
    for attribute, (key_sets, metrics) in tables.items():
        applies = F.col("key_set").isin([key_set_name(k) for k in key_sets]) if key_sets else F.lit(False)
        entries.append(F.when(applies, F.struct(F.lit(attribute).alias("attribute"),
                                                *[c.alias(n) for n, c in metrics.items()])))
    exploded = rows.select(*keep, F.explode(F.array(*entries)).alias("entry")).filter("entry IS NOT NULL")
    return exploded.select(*keep, "entry.*")


