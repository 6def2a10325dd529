"""Most frequent consequent and number of rows per rule and antecedent, for more rules than one scan of grouping sets takes.

Every rule is counted at its lead: that of its columns with the most values. Rows go to tasks by the value of the lead, once per lead
instead of once per set of columns, and a task counts all sets of a lead over some whole values of it. Columns that have few combinations
together need no lead, one task counts those. An antecedent that holds the lead is complete in its task and is not shuffled again. Only
two kinds are: those without the lead, by their highest count and their sum, and those whose rows may lie in several tasks, by their pairs.
These are antecedents of lead values with too many rows for one task, which are dealt out, and such as share their text with others.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import KEY_SEPARATOR, as_text, cell, dtype

Places = tuple[int, ...]                                # of columns
Group = tuple[int, Mapping[Places, Sequence[tuple[int, Places, Places]]]]       # lead; per set to count its rules: number, antecedent, consequent

HOT_ROWS = 1 << 18              # different rows of one lead value that a task counts together; those of a value with more are dealt out
TASK_ROWS = 1 << 18             # rows a task holds at a time, or those of one lead value
SALTS = 256
NO_LEAD = -1
TRACKED = 10_000                # values of a column whose numbers of rows are estimated
SHOWN_END = "\0"                # what follows it in a cell tells cells apart, but is not shown


def leads(sets: Sequence[frozenset[int]], values: Sequence[int], task_values: int = HOT_ROWS) -> list[int]:
    """The lead of each set of places, given the number of values per place: the one with the most. Sets over columns that have few combinations
    together share a part that one task counts: ``NO_LEAD``."""
    order = sorted({i for s in sets for i in s}, key=lambda i: (-values[i], i))
    taken: set[int] = set()
    for lead in order:
        rest = {i for s in sets if not s & taken for i in s}
        if math.prod(values[i] for i in rest) <= task_values:
            break
        taken.add(lead)
    return [next((i for i in order if i in s & taken), NO_LEAD) for s in sets]


def value_numbers(df: DataFrame, columns: Sequence[str]) -> list[int]:
    """About how many values each column has, NULL included."""
    texts = [cell(c) if isinstance(dtype(df, c), T.AtomicType) else as_text(c) for c in columns]
    row = df.agg(*[F.approx_count_distinct(t) for t in texts], *[F.max(cell(c).isNull().cast("int")) for c in columns]).head()
    return [max(values + (nulls or 0), 1) for values, nulls in zip(row[:len(columns)], row[len(columns):])]


def hot_values(cells: DataFrame, groups: Sequence[Group], values: Sequence[int], hot_rows: int) -> list[list[str]]:
    """Per group the values of its lead that have more than ``hot_rows`` different rows, by estimates that decide where rows are counted and not what."""
    places = []
    for lead, sets in groups:
        others = {i for wide in sets for i in wide} - {lead}
        places.append(lead if lead != NO_LEAD and math.prod(values[i] for i in others) > hot_rows else NO_LEAD)
    risky = sorted(set(places) - {NO_LEAD})
    if not risky:
        return [[] for _ in places]
    row = cells.select(*[F.substring_index(cells.columns[i], SHOWN_END, 1).alias(f"lead_{i}") for i in risky]) \
        .agg(*[F.expr(f"approx_top_k(lead_{i}, {TRACKED}, {TRACKED})") for i in risky]).head()
    found = {i: [top["item"] for top in tops or () if top["count"] > hot_rows] for i, tops in zip(risky, row)}
    return [found.get(i, []) for i in places]


def rule_counts(cells: DataFrame, groups: Sequence[Group], hot: Sequence[Sequence[str]], task_rows: int = TASK_ROWS) -> DataFrame:
    """``rule, AntecedentValue, top, total``: rows of the most frequent consequent, and all rows. ``cells`` has a text per column and no NULL."""
    names = cells.columns
    used = [sorted({i for wide in sets for i in wide}) for _, sets in groups]
    table = json.dumps([[i in u for i in range(len(names))] for u in used])
    lead = F.get(F.from_json(F.lit(json.dumps([lead for lead, _ in groups])), "array<int>"), F.col("part"))
    dealt_out = [f"{part}:{value}" for part, found in enumerate(hot) for value in found]

    keyed = cells.select(*names, F.posexplode(F.from_json(F.lit(table), "array<array<boolean>>")).alias("part", "used")) \
        .select("part", *[F.when(F.get("used", F.lit(i)), F.col(c)).alias(c) for i, c in enumerate(names)])
    counted = keyed.groupBy("part", *names).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("lead", F.coalesce(F.substring_index(F.get(F.array(*names), lead), SHOWN_END, 1), F.lit("")))
    is_hot = F.array_contains(F.from_json(F.lit(json.dumps(dealt_out)), "array<string>"), F.concat_ws(":", "part", "lead"))
    dealt = counted.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64(*names), F.lit(SALTS)))) \
        .repartition("part", "lead", "salt").sortWithinPartitions("part", "lead", "salt")

    plan = [(lead_place, dict(sets)) for lead_place, sets in groups]
    whole = dealt.mapInArrow(counter(plan, names, True, task_rows), "rule int, AntecedentValue string, top bigint, total bigint")
    pairs = dealt.mapInArrow(counter(plan, names, False, task_rows), "rule int, AntecedentValue string, top bigint, total bigint, consequent array<string>")
    # Pairs have no highest count yet; the rest has no consequent.
    merged = pairs.groupBy("rule", "AntecedentValue", "consequent").agg(F.max("top").alias("top"), F.sum("total").alias("total")) \
        .groupBy("rule", "AntecedentValue").agg(F.max(F.coalesce("top", "total")).alias("top"), F.sum("total").alias("total"))
    return whole.unionByName(merged)


def counter(plan: Sequence[Group], names: Sequence[str], whole: bool, task_rows: int) -> Callable[[Iterator], Iterator]:
    """What counts rows sorted by ``part, lead, salt``: the antecedents that are complete in a task, or all others.
    Tasks get it by value, so they need not find this package."""
    end, separator, no_lead = SHOWN_END, KEY_SEPARATOR, NO_LEAD

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        class Cells:
            """Codes of a column's texts, and of those as shown."""

            def __init__(self, texts):
                coded = texts.combine_chunks().dictionary_encode()
                self.texts, self.codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
                self.shown, self.shown_codes, self.one_to_one = self.texts, self.codes, True
                if pc.any(pc.match_substring(self.texts, end)).as_py():
                    shown = pa.array([t.split(end, 1)[0] for t in self.texts.to_pylist()], pa.string()).dictionary_encode()
                    self.shown, self.shown_codes = shown.dictionary, shown.indices.to_numpy().astype(np.int64)[self.codes]
                    self.one_to_one = len(self.shown) == len(self.texts)
                self.split = pc.match_substring(self.shown, separator).to_numpy(zero_copy_only=False)
                self.any_split = bool(self.split.any())

        def group(keys, weights):
            """Position of a row of each group, the sum and the maximum of its weights; in the order of the keys."""
            code, span = np.zeros(len(weights), np.int64), 1
            for codes, size in keys:
                if span * size >= 1 << 62:
                    known, code = np.unique(code, return_inverse=True)
                    span = len(known)
                code, span = code * size + codes, span * size
            if span <= 2 * len(code):
                place = np.full(span, -1, np.int64)
                place[code] = np.arange(len(code))
                found = np.flatnonzero(place >= 0)
                total, top = np.zeros(span, np.int64), np.zeros(span, np.int64)
                np.add.at(total, code, weights)
                np.maximum.at(top, code, weights)
                return place[found], total[found], top[found]
            order = np.argsort(code)
            code, weights = code[order], weights[order]
            starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            return order[starts], np.add.reduceat(weights, starts), np.maximum.reduceat(weights, starts)

        def text(cells, antecedent, rows):
            shown = [cells[i].shown.take(pa.array(cells[i].shown_codes[rows])) for i in antecedent]
            return shown[0] if len(shown) == 1 else pc.binary_join_element_wise(*shown, separator)

        def counts(rule, texts, top, total, consequents=None):
            columns = {"rule": pa.array(np.full(len(total), rule, np.int32)), "AntecedentValue": texts,
                       "top": pa.nulls(len(total), pa.int64()) if top is None else pa.array(top), "total": pa.array(total)}
            if not whole:
                columns["consequent"] = pa.nulls(len(total), pa.list_(pa.string())) if consequents is None else consequents
            return pa.RecordBatch.from_pydict(columns)

        def consequents(cells, places, rows):
            flat = pa.concat_arrays([cells[i].texts.take(pa.array(cells[i].codes[rows])) for i in places])
            n = len(rows)
            return pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(places) + 1, len(places), dtype=np.int32)),
                                            flat.take(pa.array(np.arange(n * len(places)).reshape(len(places), n).T.ravel())))

        def counted(rows, lead, sets, hot):
            cells = {i: Cells(rows.column(names[i])) for i in {i for wide in sets for i in wide}}
            n, texts = rows.column("n").to_numpy(), {}

            def complete(antecedent):
                return not hot and (lead == no_lead or lead in antecedent)

            def shares_texts(antecedent):
                return any(not cells[i].one_to_one or len(antecedent) > 1 and cells[i].any_split for i in antecedent)

            for wide, rules in sets.items():
                # Complete ones only, or only what is left of them.
                own = [r for r in rules if (complete(r[1]) if whole else not complete(r[1]) or shares_texts(r[1]))]
                if not own:
                    continue
                exact = {i: (cells[i].codes, len(cells[i].texts)) for i in wide}
                found, sums, _ = group([exact[i] for i in wide], n)
                narrow = {frozenset(wide): (found, sums)}
                for rule, antecedent, consequent in own:
                    columns = frozenset(antecedent + consequent)
                    if columns not in narrow:
                        at, total, _ = group([(exact[i][0][found], exact[i][1]) for i in sorted(columns)], sums)
                        narrow[columns] = found[at], total
                    at, total = narrow[columns]
                    apart = np.full(len(at), hot or not all(cells[i].one_to_one for i in antecedent))
                    if len(antecedent) > 1:
                        for i in antecedent:
                            if cells[i].any_split:
                                apart |= cells[i].split[cells[i].shown_codes[at]]
                    if not whole and apart.any():
                        yield counts(rule, text(cells, antecedent, at[apart]), None, total[apart], consequents(cells, consequent, at[apart]))
                    if whole or not hot and not complete(antecedent):
                        if apart.any():
                            at, total = at[~apart], total[~apart]
                        if not len(at):
                            continue
                        place, total, top = group([(cells[i].shown_codes[at], len(cells[i].shown)) for i in antecedent], total)
                        if antecedent not in texts:     # the same groups in the same order for every consequent
                            texts[antecedent] = text(cells, antecedent, at[place])
                        yield counts(rule, texts[antecedent], top, total)

        def pieces():
            """Rows of whole lead values; those that are dealt out in any piece."""
            held, size, limit = [], 0, task_rows
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                if size < limit:
                    continue
                rows = pa.Table.from_batches(held)
                last = rows.slice(size - 1)
                cut = size
                if last.column("salt")[0].as_py() is None:
                    same = pc.and_(pc.equal(rows.column("part"), last.column("part")[0]), pc.equal(rows.column("lead"), last.column("lead")[0]))
                    cut = size - pc.sum(same).as_py()
                if cut:
                    yield rows.slice(0, cut)
                held, size = (rows.slice(cut).to_batches(), size - cut) if cut < size else ([], 0)
                limit = max(task_rows, 2 * size)
            if held:
                yield pa.Table.from_batches(held)

        def results():
            for rows in pieces():
                for part in pc.unique(rows.column("part")).to_pylist():
                    mine = rows.filter(pc.equal(rows.column("part"), part))
                    is_hot = pc.is_valid(mine.column("salt"))
                    for hot in (False, True):
                        some = mine.filter(is_hot if hot else pc.invert(is_hot))
                        if some.num_rows:
                            yield from counted(some, *plan[part], hot)

        ready, size = [], 0
        for batch in results():
            ready.append(batch)
            size += batch.num_rows
            if size >= 1 << 16:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready, size = [], 0
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return count
