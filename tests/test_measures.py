import datetime as dt
import math
import random
from collections import defaultdict
from itertools import combinations, permutations

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from plumbline.functions.times import instant
from plumbline.operators.accuracy import Accuracy, Expected
from plumbline.operators.completeness import Completeness, completeness_row
from plumbline.operators.consistency import Rule, consistency_attribute, consistency_value, covering_sets, rule_values
from plumbline.operators.distinctness import (DISTINCTNESS_SCHEMA, VALUES_SCHEMA, distinctness_attribute,
                                              distinctness_global, distinctness_in_two_steps,
                                              distinctness_update, new_values,
                                              population_attribute)
from plumbline.operators.frequency import frequency_attribute, frequency_global, frequency_hour, frequency_value
from plumbline.operators.precision import Precision
from plumbline.operators.timeliness import RowTimeliness, Timeliness, Validity, timeliness_row
from plumbline.operators.volume import volume_global, volume_value
from plumbline.plans.rule_counts import NO_LEAD, leads
from plumbline.plans.summary import aggregate_sets, summarise, whole

AS_OF_TEXT = "2024-02-01 00:00:00"


def metrics(frame, named):
    return frame.select(*[c.alias(n) for n, c in named.items()]).head().asDict()


@pytest.mark.parametrize("sets_per_scan", [1, 2, 12])
def test_summary_against_brute_force(rows, sets_per_scan):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None, "null", ""]), rng.choice([1, 2, None]), rng.choice([1.0, 2.5, -3.0, None]))
            for _ in range(300)]
    df = rows(data, "k string, g int, x double")
    sets = [["k"], ["g", "k"], ["k", "g"], ["g"]]
    precision, completeness = Precision(["x"]), Completeness(["k", "g", "x"])
    summary = summarise(df, [precision, completeness], sets, whole_table=True, scope=["k", "g", "x"],
                        sets_per_scan=sets_per_scan)
    expected = defaultdict(list)
    for k, g, x in data:
        text = ["null" if v is None else str(v) for v in (k, g)]
        expected["", ""].append((k, g, x))
        expected["k", text[0]].append((k, g, x))
        expected["g", text[1]].append((k, g, x))
        expected["g_k", f"{text[1]},{text[0]}"].append((k, g, x))
        expected["k_g", f"{text[0]},{text[1]}"].append((k, g, x))
    got = summary.collect()
    assert len(got) == len(expected)
    by_key = {(r["key_set"], r["key_value"] or ""): r for r in got}
    for key, members in expected.items():
        filled = [m for m in members if None not in m]
        row = by_key[key]
        assert (row["rows"], row["rows_filled"]) == (len(members), len(filled))
        assert row["key_missing"] == (key[0] in ("k", "g") and key[1] in ("null", ""))
        xs = [m[2] for m in filled]
        assert row["number_count_0"] == len(xs)
        assert row["missing_0"] == sum(m[0] in (None, "null", "") for m in members)
        if xs:
            mean = sum(xs) / len(xs)
            assert row["number_mean_0"] == pytest.approx(mean)
            assert row["number_deviation_0"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in xs) / len(xs)), abs=1e-9)


def test_many_key_sets_take_several_scans(spark):
    names = [f"c{i}" for i in range(70)]
    df = spark.range(20).select(*[(F.col("id") % (i + 1)).alias(n) for i, n in enumerate(names)])
    sets = [[n] for n in names] + [names[:65], names[5:]]
    counted = aggregate_sets(df, sets, [F.count(F.lit(1)).alias("n")]).groupBy("set_no").agg(F.count("*"), F.sum("n"))
    assert {r[0]: (r[1], r[2]) for r in counted.collect()} == {
        i: (min(i + 1, 20) if i < 70 else 20, 20) for i in range(72)}


def test_summary_rejects_ambiguous_key_sets(rows):
    df = rows([("x", "y", "z", "w")], "a string, b_c string, a_b string, c string")
    with pytest.raises(ValueError, match="share a name"):
        summarise(df, [], [["a", "b_c"], ["a_b", "c"]])
    with pytest.raises(ValueError, match="nothing"):
        summarise(df, [])


def test_completeness(rows):
    data = [("a", None), ("a", "x"), ("b", "null"), (None, "y"), ("nan", "z"), ("", None)]
    df = rows(data, "k string, v string")
    measure, keys = Completeness(["k", "v"]), [["k"], ["k", "v"]]
    summary = summarise(df, [measure], keys, whole_table=True)
    assert metrics(whole(summary), measure.global_metrics())["Completeness_Missing"] == pytest.approx(6 / 12)
    values = as_dicts(measure.value_table(summary, keys), "key_set", "key_value")
    assert {k[1] for k in values if k[0] == "k"} == {"a", "b"}
    assert values["k", "a"]["MissingValues"] == 1 and values["k", "a"]["CompletenessMissingValue"] == 0.5
    assert values["k", "b"]["CompletenessMissingValue"] == 0.0
    # No other column is left for the second key set.
    assert values["k_v", "null,y"]["CompletenessMissingValue"] is None
    attributes = as_dicts(measure.attribute_table(summary, [["k"], ["v"], ["k", "v"]], 0.5), "key_set")
    assert attributes["k"]["MissingValues"] == 3 and attributes["k"]["CompletenessMissingValue"] == 0.5
    assert attributes["k_v"] == {"key_set": "k_v", "MissingValues": 0, "CompletenessMissingValue": 1.0, "Confidence": 0.5}
    assert [r[0] for r in df.select(completeness_row(df, df.columns)).collect()] == [0.5, 1.0, 0.5, 0.5, 0.5, 0.0]


def test_volume(rows):
    summary = summarise(rows([("a",), ("a",), ("b",)], "k string"), [], [["k"]], whole_table=True)
    assert metrics(whole(summary), volume_global(6)) == {"Volume": 0.5, "Volume_TotalRows": 3}
    assert metrics(whole(summary), volume_global(2))["Volume"] == 1.0
    assert as_dicts(volume_value(summary, 6), "key_value")["a"]["VolumeValue"] == pytest.approx(1 / 3)


def test_accuracy(rows):
    df = rows([("a", "25"), ("a", "35"), ("b", "27,5"), ("b", "x")], "k string, v string")
    measure = Accuracy([Expected("v", 25, 20)])
    summary = summarise(df, [measure], [["k"], ["v"]], whole_table=True)
    assert metrics(whole(summary), measure.global_metrics()) == {
        "Accuracy_Static_v": pytest.approx(2 / 3), "Accuracy_Dynamic_v": pytest.approx(1.75 / 3)}
    values = as_dicts(measure.value_table(summary, [["k"], ["v"]]), "key_set", "key_value")
    assert set(values) == {("k", "a"), ("k", "b")}          # a column is not measured by itself
    assert values["k", "a"]["AccuracyDynamic"] == 0.5 and values["k", "b"]["AccuracyStatic"] == 1.0
    attribute = measure.attribute_table(summary, [["k"]], 1.0).head()
    assert attribute["AccuracyDynamic"] == pytest.approx((0.5 + 0.75) / 2)      # groups weigh the same


def test_precision_groups(rows):
    df = rows([("one", 4.0), ("zero", -2.0), ("zero", 2.0), ("same", 3.0), ("same", 3.0), ("empty", None)], "k string, x double")
    measure = Precision(["x"])
    summary = summarise(df, [measure], [["k"]], whole_table=True)
    values = as_dicts(measure.value_table(summary, [["k"]], whole(summary)), "key_value")
    assert values["one"]["Precision"] == 1.0 and values["one"]["StandardDeviation"] == 0.0
    assert values["zero"]["Mean"] == 0.0 and values["zero"]["Precision"] == 0.0       # shifted by 2: 1 - 2/2
    assert values["same"]["Mean"] == 3.0 and values["same"]["Precision"] == 1.0
    assert values["empty"]["Precision"] is None
    attribute = measure.attribute_table(summary, [["k"]], whole(summary), 1.0).head()
    assert attribute["Precision"] == pytest.approx(2 / 3)


def test_precision_without_sign_change(rows):
    df = rows([("z", 0.0), ("z", 0.0), ("n", -4.0), ("n", -6.0)], "k string, x double")
    measure = Precision(["x"])
    summary = summarise(df, [measure], [["k"]], whole_table=True)
    values = as_dicts(measure.value_table(summary, [["k"]], whole(summary)), "key_value")
    assert values["z"]["Precision"] is None                 # a mean of 0 has no precision
    assert values["n"]["Precision"] == pytest.approx(1 - 1 / 5)
    got = metrics(whole(summary), measure.global_metrics())
    assert got["Precision_x"] == pytest.approx(max(0, 1 - got["Precision_Deviation_x"] / 2.5))


def test_precision_signs_of_profile_and_assessment(rows):
    df = rows([(-5.0,), (-4.0,), (1.0,)], "x double")
    measure = Precision(["x"])
    row = whole(summarise(df, [measure], whole_table=True))
    mean, deviation = -8 / 3, math.sqrt(((-5 + 8 / 3) ** 2 + (-4 + 8 / 3) ** 2 + (1 + 8 / 3) ** 2) / 3)
    assert metrics(row, measure.global_metrics())["Precision_x"] == pytest.approx(1 - deviation / (abs(mean) + 5))
    assert metrics(row, measure.profile_metrics())["Precision_x"] == pytest.approx(max(0, 1 - deviation / abs(mean + 5)))


def test_timeliness(rows):
    data = [("a", "01/01/24 00:00:00"), ("a", "31/01/24 00:00:00"), ("b", "01/11/23 00:00:00"), ("b", "bad"), ("b", None)]
    df = rows(data, "k string, t string")
    validity = Validity("t", "%d/%m/%y %H:%M:%S", 31 * 24)
    assert [round(r[0], 6) for r in df.select(timeliness_row(df, validity, instant(AS_OF_TEXT))).collect()] == [
        0.0, round(30 / 31, 6), 0.0, 0.0, 0.0]
    measure = Timeliness([validity], instant(AS_OF_TEXT))
    summary = summarise(df, [measure], [["k"]], whole_table=True)
    old = 1 - 92 / 31
    got = metrics(whole(summary), measure.global_metrics())
    assert got["Timeliness_Mean_t"] == max(0.0, (0 + 30 / 31 + old) / 3) == 0.0
    assert got["Timeliness_Max_t"] == pytest.approx(30 / 31) and got["Timeliness_Min_t"] == 0.0
    assert got["Last_Analysis_Timestamp_t"] == dt.datetime(2024, 2, 1)
    values = as_dicts(measure.value_table(summary, [["k"]]), "key_value")
    assert values["a"]["TimelinessMean"] == pytest.approx(15 / 31) and values["b"]["TimelinessMax"] == 0.0
    attribute = measure.attribute_table(summary, [["k"]], 1.0).head()
    assert attribute["TimelinessMean"] == pytest.approx(max(0, (15 / 31 + old) / 2))    # clamped after the mean
    assert attribute["TimelinessMax"] == pytest.approx(30 / 31) and attribute["TimelinessMin"] == 0.0


def test_timeliness_without_a_readable_time(rows):
    df = rows([("bad",), (None,)], "t string")
    measure = RowTimeliness([Validity("t", "%Y", 10)], instant(AS_OF_TEXT))
    got = metrics(whole(summarise(df, [measure], whole_table=True)), measure.profile_metrics())
    assert all(v is None for v in got.values())


def stamp(day, hour, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def test_frequency_by_hour(rows):
    times = [stamp(1, 5)] * 3 + [stamp(2, 5, 30)] + [stamp(1, 7)] * 2 + [stamp(1, 9)]
    df = rows([(t,) for t in times] + [(None,)], "t timestamp")
    rates = rows([(5, 4 / 3600), (7, 1 / 3600), (5, 1 / 3600), (9, 0.0), (12, 1.0)], "Hour int, Frequency double")
    hours = as_dicts(frequency_hour(df, "t", rates), "Hour")
    assert set(hours) == {5, 7, 9}                          # an hour without rows is not joined
    assert hours[5]["RecordNumber"] == 4 and hours[5]["CompletenessFrequency"] == pytest.approx(4 / (4 * 2))
    assert hours[7]["CompletenessFrequency"] == 1.0 and hours[9]["CompletenessFrequency"] is None
    assert as_dicts(frequency_hour(df, "t", rates, per_day=False), "Hour")[5]["CompletenessFrequency"] == 1.0
    assert as_dicts(frequency_hour(df, "t", rates, sample=0.5), "Hour")[5]["CompletenessFrequency"] == 1.0
    mean = frequency_global(frequency_hour(df, "t", rates), "t").head()
    assert mean["Completeness_Frequency_t"] == pytest.approx((0.5 + 1.0) / 2)


def test_frequency_by_value(rows):
    data = [("a", 1, stamp(1, 0)), ("a", 1, stamp(1, 0, 30)), ("a", 2, stamp(1, 1)), ("a", 2, stamp(1, 3)),
            ("b", 1, stamp(1, 0)), ("c", 1, stamp(1, 0)), ("c", 1, stamp(1, 1))]
    df = rows(data, "k string, n int, t timestamp")
    rates = rows([("k", "a", 0, 2 / 3600), ("k", "a", 0, 1 / 3600), ("k", "a", 1, 4 / 3600), ("k", "b", 0, 1.0),
                  ("k", "c", 0, 0.0), ("k", "c", 1, 0.0), ("k_n", "a,1", 0, 1 / 900)],
                 "Key string, Value string, Hour int, Frequency double")
    values = frequency_value(df, "t", [["k"], ["k", "n"], ["t"]], rates)
    got = as_dicts(values, "key_set", "key_value")
    # One instant (b), a rate of 0 (c) and hours without a rate (a at 3) are left out.
    assert set(got) == {("k", "a"), ("k_n", "a,1")}
    assert got["k", "a"]["RecordNumber"] == 3
    assert got["k", "a"]["CompletenessFrequencyValue"] == pytest.approx(3 / (3600 * 3 / 3600))
    assert got["k_n", "a,1"]["CompletenessFrequencyValue"] == pytest.approx(2 / (1800 / 900))
    attribute = as_dicts(frequency_attribute(values, 0.5), "key_set")
    assert attribute["k"]["RecordNumber"] == 3 and attribute["k"]["Confidence"] == 0.5


@pytest.mark.parametrize("digest", [False, True])
def test_distinctness_of_rows(rows, digest):
    data = [(1, "a")] + [(2, "a")] * 2 + [(3, None)] * 3 + [(None, "b")] * 4
    got = distinctness_global(rows(data, "a int, b string"), ["a", "b"], digest).head()
    assert got["Distinctness"] == pytest.approx(1 - (1.5 + 2) / 10)
    assert got["DistinctRatio"] == pytest.approx(4 / 10)


def test_digest_groups_as_rows_do(spark, rows):
    zeros = rows([(0.0, 1.5), (-0.0, 1.5), (0.0, 1.5), (float("nan"), 2.0), (float("nan"), 2.0)], "x double, y float")
    plain, digest = (distinctness_global(zeros, ["x", "y"], d).head() for d in (False, True))
    assert plain == digest and digest["DistinctRatio"] == 0.4
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:        # the hour that is there twice when summer time ends
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        times = spark.sql("SELECT timestamp_seconds(s) AS t, CAST(unhex(h) AS BINARY) AS b, array(s) AS a FROM VALUES (1698537600L, 'FF'), (1698541200L, 'FE') AS v(s, h)")
        for columns in (["t"], ["b"], ["a"], ["t", "b", "a"]):
            assert distinctness_global(times, columns, True).head()["DistinctRatio"] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_digest_keeps_rows_apart(rows):
    df = rows([("1:a", "b"), ("1:a1:b", ""), ("-", None), (None, "-"), ("a", "bc"), ("ab", "c")], "a string, b string")
    assert distinctness_global(df, ["a", "b"], digest=True).head()["DistinctRatio"] == 1.0


def test_distinct_keys_and_population(rows):
    summary = summarise(rows([("a", 1), ("a", 2), ("b", 1), ("a", 1)], "k string, n int"), [], [["k"], ["k", "n"]])
    distinct = as_dicts(distinctness_attribute(summary, [["k"], ["k", "n"]], 1.0), "key_set")
    assert distinct["k"]["DistinctCount"] == 2 and distinct["k_n"]["Distinctness"] == 0.75
    stored = rows([("k", 8, 100, 0.08)], DISTINCTNESS_SCHEMA)
    population = population_attribute(summary, [["k"], ["k", "n"]], stored, 1.0).collect()
    assert [(r["key_set"], r["CompletenessPopulationValue"]) for r in population] == [("k", 0.25)]


def test_distinctness_over_batches(spark, rows):
    empty_values, empty_state = spark.createDataFrame([], VALUES_SCHEMA), spark.createDataFrame([], DISTINCTNESS_SCHEMA)
    first, second = rows([("a", 1), ("b", 1), (None, 1)], "k string, n int"), rows([("b", 2), ("c", 1)], "k string, n int")
    count = lambda df: df.agg(F.count(F.lit(1)).alias("rows"))      # noqa: E731
    added = new_values(first, ["k", "n"], empty_values)
    state = distinctness_update(count(first), ["k", "n"], added, empty_state)
    assert as_dicts(state, "Attribute")["k"] == {"Attribute": "k", "Count": 3, "TotalRows": 3, "DistinctnessValue": 1.0}
    more = new_values(second, ["k", "n"], added)
    assert sorted((r["attribute"], r["value"]) for r in more.collect()) == [("k", "c"), ("n", "2")]
    later = as_dicts(distinctness_update(count(second), ["k", "n"], more, state), "Attribute")
    assert (later["k"]["Count"], later["k"]["TotalRows"]) == (4, 5) and later["n"]["DistinctnessValue"] == 0.4
    again = new_values(second, ["k", "n"], added.unionByName(more))
    assert as_dicts(distinctness_update(count(second), ["k", "n"], again, state), "Attribute")["n"]["Count"] == 1


def _mean_by_hand(rows, rule, columns):
    """Mean over the antecedents of the share that the most frequent consequent has."""
    seen = {}
    for row in rows:
        cells = dict(zip(columns, row))
        left = ",".join("null" if cells[c] is None else str(cells[c]) for c in rule.antecedent)
        right = tuple(cells[c] for c in rule.consequent)
        seen.setdefault(left, {}).setdefault(right, 0)
        seen[left][right] += 1
    return {left: max(n.values()) / sum(n.values()) for left, n in seen.items()}


def test_many_rules_by_lattice(spark):
    columns = ["a", "b", "c", "d", "e"]
    rows = [(f"x{i % 3}", None if i % 5 == 0 else i % 4, f"p,{i % 2}", "" if i % 7 else None, i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b int, c string, d string, e int")
    rules = [Rule(left, right) for n in (1, 2, 3) for left in permutations(columns, n) for right in permutations([c for c in columns if c not in left], 1)]
    assert len(rules) == 20 + 60 + 120
    got = {}
    for r in consistency_value(df, rules).collect():
        got.setdefault((r["RuleAntecedent"], r["RuleConsequent"]), {})[r["AntecedentValue"]] = r["ConsistencyValue"]
    assert got == {(r.left, r.right): pytest.approx(_mean_by_hand(rows, r, columns)) for r in rules}
    # Only the widest sets are counted, and fewer rules give the same by grouping sets.
    assert len(set(covering_sets(rules).values())) == 5
    few = {(r["RuleAntecedent"], r["RuleConsequent"], r["AntecedentValue"]): r["ConsistencyValue"] for r in consistency_value(df, rules[:5] + rules[-3:]).collect()}
    assert all(got[left, right][value] == score for (left, right, value), score in few.items())


def test_rules_are_counted_once_per_lead():
    """Of 287 rules between seven columns (35 sets of four columns), those with the widest column go to tasks by its values, once; one task has the rest."""
    sets = [frozenset(s) for n in (2, 3, 4) for s in combinations(range(7), n)]
    assert leads(sets, [3, 2, 7, 50, 11, 9, 1000]) == [6 if 6 in s else NO_LEAD for s in sets]
    assert leads(sets, [3, 2, 7, 50, 11, 9, 1000], 10_000) == [6 if 6 in s else 3 if 3 in s else NO_LEAD for s in sets]
    assert leads(sets, [3, 2, 7, 50, 11, 9, 1000], 1 << 28) == [NO_LEAD] * len(sets)


@pytest.mark.parametrize(("hot_rows", "task_rows"), [(1 << 18, 1 << 18), (0, 1), (4, 7), (60, 1000)])
def test_rules_of_hot_leads_and_shared_texts(spark, hot_rows, task_rows):
    """Leads dealt out over tasks, antecedents that share a text by its commas, and NULL beside its text give the counts of one plain loop."""
    columns = ["a", "b", "c", "d", "e"]
    texts = ["x", "x,y", "y", "y,x", ",", "", None, "null", "é,"]
    rows = [(0 if i % 3 else i, texts[i % 9], texts[i * i % 7], None if i % 4 == 0 else i % 5, float(i % 6) if i % 11 else -0.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, c string, d int, e double")
    rules = [Rule(left, right) for n in (1, 2, 3) for left in combinations(columns, n) for k in (1, 2)
             for right in combinations([c for c in columns if c not in left], k)] + [Rule(("c", "b"), ("a",)), Rule(("b",), ("b", "c"))]
    got = {}
    for r in rule_values(df, rules, hot_rows, task_rows).collect():
        key = (r["RuleAntecedent"], r["RuleConsequent"]), r["AntecedentValue"]
        assert key not in got
        got[key] = r["top"], r["total"]
    want = {}
    for rule in rules:
        seen = {}
        for row in rows:
            cells = {c: "null" if v is None else str(v + 0.0 if isinstance(v, float) else v) for c, v in zip(columns, row)}
            pairs = seen.setdefault(",".join(cells[c] for c in rule.antecedent), {})
            right = tuple(cells[c] for c in rule.consequent)
            pairs[right] = pairs.get(right, 0) + 1
        want.update({((rule.left, rule.right), left): (max(n.values()), sum(n.values())) for left, n in seen.items()})
    assert got == want
    assert rule_values(df.limit(0), rules, hot_rows, task_rows).count() == 0


def test_plan_does_not_grow_with_rules(spark):
    df = spark.createDataFrame([tuple(range(60))], ", ".join(f"c{i} int" for i in range(60)))
    every = [Rule((f"c{i}",), (f"c{j}",)) for i in range(60) for j in range(60) if i != j]
    sizes = {}
    for n in (40, 500, 3000):
        plan = consistency_attribute(consistency_value(df, every[:n]))._jdf.queryExecution().optimizedPlan()
        text = plan.treeString()
        sizes[n] = (text.count("\n"), text.count("LogicalRDD") + text.count("LocalRelation"))
    assert sizes[40] == sizes[500] == sizes[3000] and sizes[500][1] <= 2
    assert consistency_attribute(consistency_value(df, every[:500])).count() == 500


def test_lattice_takes_equal_cells_as_grouping_does(spark):
    rows = [(0.0, "a", dt.datetime(2024, 1, 1)), (-0.0, "a", dt.datetime(2024, 1, 1)), (1.0, "b", dt.datetime(2024, 1, 2)), (float("nan"), "b", None)]
    df = spark.createDataFrame([(*r, *[str(i) for i in range(6)]) for r in rows], "z double, k string, t timestamp, " + ", ".join(f"f{i} string" for i in range(6)))
    rules = [Rule(("k",), ("z",)), Rule(("k",), ("t",)), Rule(("t",), ("z",)), *[Rule(("z",), (f"f{i}",)) for i in range(6)], *[Rule(("t",), (f"f{i}",)) for i in range(6)]]
    by_lattice = {(r["Rule"], r["AntecedentValue"]): r["ConsistencyValue"] for r in consistency_value(df, rules).collect()}
    plain = {(r["Rule"], r["AntecedentValue"]): r["ConsistencyValue"] for r in consistency_value(df, rules[:3]).collect()}
    assert plain == {key: score for key, score in by_lattice.items() if key[0] in {k for k, _ in plain}}
    assert by_lattice["k -> z", "a"] == 1.0


def test_digest_of_nested_cells_groups_as_rows_do(spark):
    schema = "a array<double>, s struct<x:double,y:array<struct<z:float>>>, t array<timestamp>"
    at = dt.datetime(2024, 1, 1)
    cells = [([0.0], (0.0, [(0.0,)]), [at]), ([-0.0], (-0.0, [(-0.0,)]), [at]), ([0.0], (0.0, [(0.0,)]), [at]), ([None], None, None), (None, (None, None), []),
             ([], (None, []), [None]), ([float("nan")], (1.0, [None]), [at]), ([1.0, 2.0], (1.0, [(None,)]), [at, at])]
    df = spark.createDataFrame(cells, schema)
    for columns in (["a"], ["s"], ["t"], ["a", "s", "t"]):
        plain, digest = (distinctness_global(df, columns, d).head() for d in (False, True))
        assert plain == digest, columns
    assert distinctness_global(df.limit(3).select("a"), ["a"], True).head()["DistinctRatio"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_two_steps_give_what_grouping_gives(spark, tmp_path, broadcast):
    schema = "a array<double>, s struct<x:double,y:array<string>>, w string, z double"
    wide = "x" * 5000
    cells = [([0.0], (0.0, ["k"]), wide, -0.0), ([-0.0], (-0.0, ["k"]), wide, 0.0), ([0.0], (0.0, ["k"]), wide, 0.0), ([1.0], None, wide + "y", 2.0), (None, None, None, None),
             (None, None, None, None), ([float("nan")], (1.0, None), "", float("nan")), ([float("nan")], (1.0, None), "", float("nan")), ([], (1.0, []), "null", 1.0)]
    df = spark.createDataFrame(cells, schema)
    for i, columns in enumerate((["z"], ["a", "s"], ["a", "s", "w", "z"], ["w"])):
        plain = distinctness_global(df, columns).head()
        assert distinctness_in_two_steps(df, columns, str(tmp_path / f"{i}"), broadcast).head() == plain
    empty = distinctness_in_two_steps(df.limit(0), ["w"], str(tmp_path / "empty"), broadcast).head()
    assert empty == distinctness_global(df.limit(0), ["w"]).head() and empty["DistinctRatio"] is None
    alone = distinctness_in_two_steps(spark.range(50).select(F.col("id").cast("string").alias("w")), ["w"], str(tmp_path / "alone"), broadcast).head()
    assert alone["Distinctness"] == 1.0 == alone["DistinctRatio"]


def test_only_repeated_hashes_are_written(spark, tmp_path, monkeypatch):
    import plumbline.operators.distinctness as D

    monkeypatch.setattr(D, "HOT_COPIES", 3, raising=False)
    copies = F.when(F.col("id") % 10 == 0, 0).when(F.col("id") % 10 == 1, F.col("id") % 30).otherwise(F.col("id"))
    df = spark.range(1000).select(copies.alias("id"), (F.col("id") % 1).cast("double").alias("z"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise("w").alias("w"))
    for i, columns in enumerate((["id", "z"], ["id", "w"])):
        for broadcast in (0, 1000):
            got = distinctness_in_two_steps(df, columns, str(tmp_path / f"{i}_{broadcast}"), broadcast).head()
            assert got == distinctness_global(df, columns).head()
            assert spark.read.parquet(str(tmp_path / f"{i}_{broadcast}" / "row_hashes")).count() < 10


def test_rows_that_come_once_are_not_shuffled_whole(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 90).alias("id"), F.lit("wide").alias("w"))
    for broadcast in (0, 1000):
        plan = distinctness_in_two_steps(df, ["id", "w"], str(tmp_path / f"{broadcast}"), broadcast)._jdf.queryExecution().executedPlan().toString()
        # Whole rows are dealt out by their cells only after the join that leaves the others out.
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(id" in line]
        assert bool(exchanges) == bool(broadcast) and (not broadcast or plan.index("LeftSemi") > plan.index("Exchange hashpartitioning(id"))
