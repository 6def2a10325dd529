"""Whole jobs: batches profiled into a source, its merged quality, and assessments."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import AssessmentSpec, ProfileSpec, Reference, assess_frame, profile_batch
from plumbline.functions.times import instant
from plumbline.operators.consistency import Rule
from plumbline.operators.inference import ColumnTypes
from plumbline.operators.selection import Range
from plumbline.plans.merge import merge_quality
from plumbline.plans.profile import batch_metrics, extend_rows
from plumbline.sources.state import SourceState

from .numbers import _precision_sql
from .registry import clamp, query, r6, rounded, table, union, work_folder

SPLIT, FIRST_RUN, SECOND_RUN, HOURS = "2024-01-16 00:00:00", "2024-01-16 00:00:00", "2024-02-01 00:00:00", 1000.0
COLUMNS = ["event_type", "value", "ts"]
TYPES = ColumnTypes({"event_type": "string", "value": "float", "ts": "datetime"})
RULE = Rule(("event_type",), ("value",))


def _halves(spark, sf_dir):
    events, split = table(spark, sf_dir, "events"), F.lit(SPLIT).cast("timestamp_ntz")
    return [events.filter(condition).select(*COLUMNS) for condition in (F.col("ts") < split, F.col("ts") >= split)]


# Quality of the source after both halves, by the merge rules

def _half_sql(condition: str, as_of: str) -> str:
    score = f"greatest(1 - (epoch_us(TIMESTAMP '{as_of}') - epoch_us(ts)) / 1e6 / ({HOURS} * 3600.0), 0.0)"
    return f"""SELECT count(*) AS n, avg(value) AS m, stddev_pop(value) AS s, min(value) AS lo, max(value) AS hi,
    {_precision_sql("stddev_pop(value)", "avg(value) + CASE WHEN min(value) < 0 AND max(value) > 0 THEN abs(min(value)) ELSE 0 END")} AS p,
    min(ts) AS t0, max(ts) AS t1, avg({score}) AS sm, max({score}) AS sx, min({score}) AS sn,
    sum(CASE WHEN isnan(value) OR value IS NULL THEN 1 ELSE 0 END) AS gaps FROM events WHERE {condition}"""


def _rule_half(condition: str) -> str:
    return f"""(SELECT avg(x) FROM (SELECT max(k) / CAST(sum(k) AS DOUBLE) AS x FROM
    (SELECT event_type, count(*) AS k FROM events WHERE {condition} GROUP BY event_type, value) GROUP BY event_type))"""


BEFORE, AFTER = f"ts < TIMESTAMP '{SPLIT}'", f"ts >= TIMESTAMP '{SPLIT}'"
DECAY = f"(epoch_us(TIMESTAMP '{SECOND_RUN}') - epoch_us(TIMESTAMP '{FIRST_RUN}')) / 1e6 / ({HOURS} * 3600.0)"


def _weighted(old: str, new: str) -> str:
    return r6(f"({old} * a.n + {new} * b.n) / CAST(a.n + b.n AS DOUBLE)")


MERGED_SQL = f"""
WITH a AS ({_half_sql(BEFORE, FIRST_RUN)}), b AS ({_half_sql(AFTER, SECOND_RUN)})
SELECT CAST(2 AS BIGINT) AS "UpdatesCount", a.n + b.n AS "Volume_TotalRows",
  {_weighted("(1 - a.gaps / (a.n * 3.0))", "(1 - b.gaps / (b.n * 3.0))")} AS "Completeness_Missing",
  {_weighted("a.p", "b.p")} AS "Precision_value", {_weighted("a.s", "b.s")} AS "Precision_Deviation_value",
  {r6("least(a.lo, b.lo)")} AS "Min_Value_value", {r6("greatest(a.hi, b.hi)")} AS "Max_Value_value",
  a.n + b.n AS "Number_Count_value", {r6("(SELECT avg(value) FROM events)")} AS "Number_Mean_value",
  {r6("(SELECT stddev_pop(value) FROM events)")} AS "Pooled_Deviation_value",
  strftime(least(a.t0, b.t0), '%Y-%m-%d %H:%M:%S') AS "Minimum_Timestamp_ts",
  strftime(greatest(a.t1, b.t1), '%Y-%m-%d %H:%M:%S') AS "Maximum_Timestamp_ts",
  {_weighted(f"greatest(a.sm - {DECAY}, 0.0)", "b.sm")} AS "Timeliness_Mean_ts",
  {r6(f"greatest(a.sx - {DECAY}, b.sx)")} AS "Timeliness_Max_ts",
  {r6(f"least(greatest(a.sn - {DECAY}, 0.0), b.sn)")} AS "Timeliness_Min_ts",
  '{SECOND_RUN}' AS "Last_Analysis_Timestamp_ts"
  {{more}}
FROM a, b"""


@query("source_merge", MERGED_SQL.format(
    more=f""", {_weighted(_rule_half(BEFORE), _rule_half(AFTER))} AS "Consistency_event_type_value" """))
def merged_halves(spark, sf_dir):
    stored = None
    for half, as_of in zip(_halves(spark, sf_dir), (FIRST_RUN, SECOND_RUN)):
        metrics, rules = batch_metrics(half, TYPES, HOURS, instant(as_of), rules=[RULE])
        stored = merge_quality(stored, metrics, rules, instant(as_of))
    return rounded(stored.drop("source"))


# The same through the profiling job: state tables, ledger, distinct values

DISTINCT_SQL = "".join(f""", {r6(f"(SELECT count(DISTINCT {c}) / CAST(count(*) AS DOUBLE) FROM events)")} AS "Distinctness_{c}",
  (SELECT count(DISTINCT {c}) FROM events) AS "Distinct_Number_{c}" """ for c in ("event_type", "value"))


def _profiled(spark, sf_dir) -> SourceState:
    folder = work_folder(spark)
    spec = ProfileSpec(folder, volatility_hours=HOURS)
    first, second = _halves(spark, sf_dir)
    profile_batch(spark, first, "half_1", spec, FIRST_RUN)
    profile_batch(spark, second, "half_2", spec, SECOND_RUN)
    profile_batch(spark, second, "half_2", spec, SECOND_RUN)       # in the ledger by now, so it changes nothing
    return SourceState(spark, folder)


@query("profiled_source_quality", MERGED_SQL.format(more=DISTINCT_SQL))
def profiled_source_quality(spark, sf_dir):
    state = _profiled(spark, sf_dir)
    return rounded(state.source_quality(state.version()).drop("source"))


@query("profiled_batch_rows", f"""
SELECT event_type, round(value, 6) AS value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(1.0 AS DOUBLE) AS "COMPLETENESS_MISSING",
       {r6(f"greatest(1 - (epoch_us(TIMESTAMP '{SECOND_RUN}') - epoch_us(ts)) / 1e6 / ({HOURS} * 3600.0), 0.0)")} AS "TIMELINESS_ts",
       'half_2' AS batch FROM events WHERE {AFTER}""")
def profiled_batch_rows(spark, sf_dir):
    state = _profiled(spark, sf_dir)
    return rounded(state.extended(state.metadata(), state.correct_batches(["half_2", "half_3"])))


# Rows with their scores

@query("extended_rows", f"""
SELECT event_id, event_type, CAST(1.0 AS DOUBLE) AS "COMPLETENESS_MISSING",
       {r6(f"greatest(1 - (epoch_us(TIMESTAMP '{SECOND_RUN}') - epoch_us(ts)) / 1e6 / ({HOURS} * 3600.0), 0.0)")} AS "TIMELINESS_ts",
       CASE WHEN EXISTS (SELECT 1 FROM events e WHERE e.event_type = events.event_type AND e.user_id = events.user_id AND {BEFORE.replace('ts', 'e.ts', 1)})
            THEN 1.0 ELSE 0.0 END::DOUBLE AS "ASSOCIATION_CONSISTENCY" FROM events""")
def extended_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    types = ColumnTypes({"event_id": "float", "ts": "datetime", "user_id": "float", "event_type": "string",
                         "value": "float", "props": "string"})
    seen = events.filter(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")).select("event_type", "user_id")
    rows = extend_rows(events, types, HOURS, instant(SECOND_RUN), [seen])
    return rounded(rows.select("event_id", "event_type", "COMPLETENESS_MISSING", "TIMELINESS_ts",
                               "ASSOCIATION_CONSISTENCY"))


# An assessment of shipped lines with every dimension

LINE_TYPES = ColumnTypes({"l_returnflag": "string", "l_linestatus": "string", "l_quantity": "float",
                          "l_extendedprice": "float", "l_shipdate": "datetime"})
LINE_SPEC = AssessmentSpec(
    columns=tuple(LINE_TYPES.kinds), key_sets=[("l_returnflag", "l_linestatus"), ("l_linestatus",), ("l_quantity",)],
    dimensions={"Volume": ["global", "value"], "Completeness_Missing": ["global", "attribute", "value"],
                "Accuracy": ["global", "attribute", "value"], "Precision": ["global", "attribute", "value"],
                "Timeliness": ["global", "attribute", "value"], "Completeness_Frequency": ["global"],
                "Distinctness": ["global", "attribute"], "Completeness_Population": ["attribute"],
                "Consistency": ["attribute", "value"]},
    ranges={"l_shipdate": [Range("01/01/1995 00.00.00", None)]},
    values={"l_returnflag": ["A", "R"]}, expected={"l_quantity": (25.0, 20.0)},
    volatility_hours={"l_shipdate": 60000.0}, extra_rules=[Rule(("l_returnflag",), ("l_linestatus",))])
LINE_AS_OF = "2002-01-01 00:00:00"
LINE_SCORE = f"(1 - (epoch_us(TIMESTAMP '{LINE_AS_OF}') - epoch_us(l_shipdate)) / 1e6 / (60000 * 3600.0))"
LINE_WHERE = "l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_returnflag IN ('A', 'R')"
LINES = f"lines AS (SELECT l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_shipdate FROM lineitem WHERE {LINE_WHERE})"
LINE_ACCURACY = "greatest(0.0, 1 - abs((l_quantity - 25.0) / 10.0))"


def _assessed(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    source = lineitem.select(*LINE_SPEC.columns)
    hour = spark.range(24).select(F.col("id").cast("int").alias("Hour"), F.lit(0.001).alias("Frequency"))
    stored = lineitem.agg(F.count_distinct("l_quantity").alias("Count"), F.count(F.lit(1)).alias("TotalRows")).select(
        F.lit("l_quantity").alias("Attribute"), "Count", "TotalRows")
    reference = Reference(hourly_rates={"l_shipdate": hour}, distinctness=stored)
    return assess_frame(source, LINE_TYPES, LINE_SPEC, LINE_AS_OF, work_folder(spark), reference)


@query("final_quality", f"""
WITH {LINES},
grouped AS (SELECT count(*) AS n FROM lines GROUP BY l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_shipdate),
hours AS (SELECT {clamp("count(*) / (0.001 * (date_diff('day', min(l_shipdate)::DATE, max(l_shipdate)::DATE) + 1) * 3600.0)")} AS f
          FROM lines GROUP BY hour(l_shipdate))
SELECT {r6("least(1.0, count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE))")} AS "Volume", count(*) AS "Volume_TotalRows",
  CAST(1.0 AS DOUBLE) AS "Completeness_Missing",
  {r6(f"avg(ceil({LINE_ACCURACY}))")} AS "Accuracy_Static_l_quantity", {r6(f"avg({LINE_ACCURACY})")} AS "Accuracy_Dynamic_l_quantity",
  {r6(_precision_sql("stddev_pop(l_quantity)", "avg(l_quantity)"))} AS "Precision_l_quantity",
  {r6("stddev_pop(l_quantity)")} AS "Precision_Deviation_l_quantity",
  {r6(_precision_sql("stddev_pop(l_extendedprice)", "avg(l_extendedprice)"))} AS "Precision_l_extendedprice",
  {r6("stddev_pop(l_extendedprice)")} AS "Precision_Deviation_l_extendedprice",
  {r6(clamp(f"avg({LINE_SCORE})", high=False))} AS "Timeliness_Mean_l_shipdate",
  {r6(clamp(f"max({LINE_SCORE})", high=False))} AS "Timeliness_Max_l_shipdate",
  {r6(clamp(f"min({LINE_SCORE})", high=False))} AS "Timeliness_Min_l_shipdate",
  '{LINE_AS_OF}' AS "Last_Analysis_Timestamp_l_shipdate",
  {r6("(SELECT avg(f) FROM hours)")} AS "Completeness_Frequency_l_shipdate",
  {r6("(SELECT greatest(0.0, 1 - coalesce(sum(CASE WHEN n > 2 THEN n / 2.0 END), 0.0) / sum(n)) FROM grouped)")} AS "Distinctness",
  {r6("(SELECT count(*) / CAST(sum(n) AS DOUBLE) FROM grouped)")} AS "DistinctRatio",
  CAST(1.0 AS DOUBLE) AS "Confidence"
FROM lines""")
def final_quality(spark, sf_dir):
    return rounded(_assessed(spark, sf_dir)["final_quality"])


LINE_KEYS = {"l_returnflag_l_linestatus": ["l_returnflag", "l_linestatus"], "l_linestatus": ["l_linestatus"],
             "l_quantity": ["l_quantity"]}


def _assessed_sql(name, keys):
    """Every attribute-level metric of a key set, one row per metric."""
    by = ", ".join(keys)
    groups = f"""(SELECT count(*) AS n, avg({LINE_ACCURACY}) AS dynamic, avg(l_extendedprice) AS mean,
        {_precision_sql("stddev_pop(l_extendedprice)", "avg(l_extendedprice)")} AS precise, avg({LINE_SCORE}) AS score
        FROM lines GROUP BY {by})"""
    parts = [("Distinctness", "count(*) / CAST(sum(n) AS DOUBLE)"), ("Precision", "avg(precise)"), ("Mean", "avg(mean)"),
             ("TimelinessMean", clamp("avg(score)", high=False))]
    if "l_quantity" not in keys:
        parts.append(("AccuracyDynamic", "avg(dynamic)"))
    return [f"SELECT '{name}' AS key_set, '{metric}' AS metric, {r6(expression)} AS score FROM {groups}"
            for metric, expression in parts]


@query("assessed_attributes", f"WITH {LINES}\n" + union([p for n, k in LINE_KEYS.items() for p in _assessed_sql(n, k)] + [
    f"""SELECT 'l_quantity' AS key_set, 'CompletenessPopulationValue' AS metric,
    {r6("(SELECT count(DISTINCT l_quantity) FROM lines) / CAST((SELECT count(DISTINCT l_quantity) FROM lineitem) AS DOUBLE)")} AS score"""]))
def assessed_attributes(spark, sf_dir):
    tables = _assessed(spark, sf_dir)

    def metric(name, table_name, only=None):
        rows = tables[table_name].filter(only) if only else tables[table_name]
        return rows.select("key_set", F.lit(name).alias("metric"), F.col(name).alias("score"))

    price = "attribute = 'l_extendedprice'"
    found = [metric("Distinctness", "distinctness_attributes"), metric("Precision", "precision_attributes", price),
             metric("Mean", "precision_attributes", price), metric("TimelinessMean", "timeliness_attributes"),
             metric("AccuracyDynamic", "accuracy_attributes"),
             metric("CompletenessPopulationValue", "completeness_population_attributes")]
    merged = found[0]
    for frame in found[1:]:
        merged = merged.unionByName(frame)
    return rounded(merged)
