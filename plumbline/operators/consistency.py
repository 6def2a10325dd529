"""Rules between columns, and rows checked against lists of valid combinations."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import NULL_TEXT, as_text, cell, dtype, key_cell, key_text
from ..functions.scores import ratio
from ..plans.lookup import BROADCAST_BYTES, Lookup, flag_known
from ..plans.rule_counts import HOT_ROWS, TASK_ROWS, hot_values, leads, rule_counts, value_numbers
from ..plans.summary import SETS_PER_SCAN, aggregate_sets, by_set

RULES_SCHEMA = "Antecedent string, Consequent string"
MAX_RULES = 10_000


@dataclass(frozen=True)
class Rule:
    """The columns of ``antecedent`` should determine the columns of ``consequent``."""

    antecedent: tuple[str, ...]
    consequent: tuple[str, ...]

    @property
    def left(self) -> str:
        return ",".join(self.antecedent)

    @property
    def right(self) -> str:
        return ",".join(self.consequent)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.antecedent + self.consequent))


def parse_rule(text: str) -> Rule | None:
    """``x1,x2:y1`` as a rule; None for an empty text."""
    if not text.strip():
        return None
    left, colon, right = text.partition(":")
    if not colon or not left or not right:
        raise ValueError(f"a rule is written antecedents:consequents, got {text!r}")
    return Rule(tuple(left.split(",")), tuple(right.split(",")))


def rule_set(stored: DataFrame | None, extra: Sequence[Rule], columns: Sequence[str]) -> list[Rule]:
    """Stored and extra rules whose columns are all at hand. Their names come to the driver, so there may be ``MAX_RULES`` at
    most; a longer list is an error, not cut."""
    rules = []
    if stored is not None:
        names = stored.select("Antecedent", "Consequent").distinct().limit(MAX_RULES + 1).collect()
        if len(names) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} stored rules")
        for row in sorted(names):
            rules.append(Rule(tuple(row["Antecedent"].split(",")), tuple(row["Consequent"].split(","))))
    rules.extend(extra)
    return [r for r in dict.fromkeys(rules) if set(r.columns) <= set(columns)]


def consistency_value(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule and antecedent value: share of its rows that have the most frequent consequent.

    One scan counts the combinations of all rules. They are combined before each shuffle, so an antecedent
    that holds most of the rows is spread over its consequents first and summed up from partial results.
    Up to ``SETS_PER_SCAN`` sets of columns are grouping sets; more are counted by ``rule_values``.
    """
    if not rules:
        raise ValueError("consistency needs at least one rule")
    if len({frozenset(r.columns) for r in rules}) > SETS_PER_SCAN:
        values = rule_values(df, rules)
    else:
        key = {n: f"key_{i}" for i, n in enumerate(dict.fromkeys(c for r in rules for c in r.columns))}
        rows = df.select(*[key_cell(df, n).alias(k) for n, k in key.items()])
        counted = aggregate_sets(rows, [[key[c] for c in r.columns] for r in rules], [F.count(F.lit(1)).alias("pairs")])
        pairs = counted.select("pairs", by_set([F.lit(r.left) for r in rules]).alias("RuleAntecedent"),
                               by_set([F.lit(r.right) for r in rules]).alias("RuleConsequent"),
                               by_set([key_text([key[c] for c in r.antecedent]) for r in rules]).alias("AntecedentValue"))
        values = pairs.groupBy("RuleAntecedent", "RuleConsequent", "AntecedentValue").agg(F.max("pairs").alias("top"), F.sum("pairs").alias("total"))
    return values.select("RuleAntecedent", "RuleConsequent", "AntecedentValue", ratio(F.col("top"), F.col("total")).alias("ConsistencyValue"),
                         F.concat_ws(" -> ", "RuleAntecedent", "RuleConsequent").alias("Rule"))


def covering_sets(rules: Sequence[Rule]) -> dict[frozenset[str], frozenset[str]]:
    """For the columns of each rule a set of columns to count by: themselves, unless other rules need more than those. Then the
    smallest such set that no other one contains."""
    sets = sorted({frozenset(r.columns) for r in rules}, key=lambda s: (-len(s), sorted(s)))
    widest: list[frozenset[str]] = []
    for columns in sets:
        if not any(columns < wider for wider in widest):
            widest.append(columns)
    return {columns: min((w for w in widest if columns <= w), key=lambda w: (len(w), sorted(w))) for columns in sets}


def _exact_cell(df: DataFrame, name: str) -> Column:
    """The cell as a text that two cells share if and only if grouping takes them as equal; what follows a zero character is not shown."""
    kind = dtype(df, name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce((cell(name) + F.lit(0.0)).cast("string"), F.lit(NULL_TEXT))       # 0.0 for -0.0
    if isinstance(kind, T.TimestampType):
        return F.concat(as_text(name), F.lit("\0"), F.coalesce(F.unix_micros(cell(name)).cast("string"), F.lit("")))
    return as_text(name)


def rule_values(df: DataFrame, rules: Sequence[Rule], hot_rows: int = HOT_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """``RuleAntecedent, RuleConsequent, AntecedentValue, top, total``: rows of the most frequent consequent, and all rows.

    Rules are data of the tasks that count them, so neither the plan nor the number of scans grows with them.
    """
    rules = list(dict.fromkeys(rules))
    columns = list(dict.fromkeys(c for r in rules for c in r.columns))
    place = {c: i for i, c in enumerate(columns)}
    cells = df.select(*[_exact_cell(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    # Estimates decide where rows are counted, not what is counted.
    values = value_numbers(df, columns)
    led: dict[int, list[int]] = {}
    for number, lead in enumerate(leads([frozenset(place[c] for c in r.columns) for r in rules], values, hot_rows)):
        led.setdefault(lead, []).append(number)
    groups = []
    for lead, numbers in sorted(led.items()):
        cover = covering_sets([rules[i] for i in numbers])
        sets: dict[tuple[int, ...], list] = {}
        for i in numbers:
            wide = tuple(sorted(place[c] for c in cover[frozenset(rules[i].columns)]))
            sets.setdefault(wide, []).append((i, *[tuple(place[c] for c in side) for side in (rules[i].antecedent, rules[i].consequent)]))
        groups.append((lead, sets))
    left, right = (F.from_json(F.lit(json.dumps(names)), "array<string>") for names in ([r.left for r in rules], [r.right for r in rules]))
    return rule_counts(cells, groups, hot_values(cells, groups, values, hot_rows), task_rows).select(
        F.get(left, F.col("rule")).alias("RuleAntecedent"), F.get(right, F.col("rule")).alias("RuleConsequent"), "AntecedentValue", "top", "total")


def consistency_attribute(values: DataFrame, confidence: float = 1.0) -> DataFrame:
    """Per rule: mean over the antecedent values, each counting once."""
    return (values.groupBy("RuleAntecedent", "RuleConsequent")
            .agg(F.avg("ConsistencyValue").alias("ConsistencyValue"))
            .withColumn("Confidence", F.lit(float(confidence))))


def applicable_bindings(bindings: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    """The lists of valid combinations whose columns are all at hand."""
    return [b for b in bindings if b.columns and set(b.columns) <= set(columns)]


def with_association(df: DataFrame, bindings: Sequence[DataFrame], name: str = "ASSOCIATION_CONSISTENCY",
                     broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add the share of binding lists that hold the row's values. Without a list there is no score to add.

    Values are compared as texts; a list never matches by a combination with a NULL in it.
    """
    lists = applicable_bindings(bindings, df.columns)
    if not lists:
        return df
    kept = [c for c in df.columns if c != name]
    lookups = [Lookup({c: as_text(c) for c in binding.columns},
                      binding.dropna("any").select(*[cell(c).cast("string").alias(c) for c in binding.columns]), f"__known_{i}")
               for i, binding in enumerate(lists)]
    result = flag_known(df.select(*[cell(c) for c in kept]), lookups, broadcast_bytes)
    flags = [F.col(lookup.flag).cast("int") for lookup in lookups]
    hits = sum(flags[1:], flags[0])
    return result.select(*[cell(c) for c in kept], ratio(hits, F.lit(len(lists))).alias(name))
