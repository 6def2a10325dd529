"""Timeliness and frequency of the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.cells import key_set_name
from plumbline.functions.times import instant
from plumbline.operators.frequency import frequency_attribute, frequency_global, frequency_hour, frequency_value
from plumbline.operators.timeliness import RowTimeliness, Timeliness, Validity, timeliness_row
from plumbline.plans.summary import summarise, whole

from .registry import clamp, one_row, query, r6, rounded, sql_key, table, union

AS_OF = "2024-02-01 00:00:00"
HOURS = 480                             # some events are older, so clamping shows
EVENT_KEYS = [["event_type"], ["user_id"], ["event_type", "user_id"]]
SCORE = f"(1 - (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 1e6 / ({HOURS} * 3600.0))"
VALIDITY = Validity("ts", volatility_hours=HOURS)


def _timeliness(spark, sf_dir, **what):
    measure = Timeliness([VALIDITY], instant(AS_OF))
    return measure, summarise(table(spark, sf_dir, "events"), [measure], **what)


@query("timeliness_global", "SELECT " + ", ".join(
    f"""{r6(clamp(f"{f}({SCORE})", high=False))} AS "Timeliness_{n}_ts" """
    for f, n in (("avg", "Mean"), ("max", "Max"), ("min", "Min"))) +
    f""", '{AS_OF}' AS "Last_Analysis_Timestamp_ts" FROM events""")
def timeliness_global(spark, sf_dir):
    measure, summary = _timeliness(spark, sf_dir, whole_table=True)
    return one_row(whole(summary), measure.global_metrics())


@query("timeliness_profile", f"""
SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS "Minimum_Timestamp_ts",
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS "Maximum_Timestamp_ts",
       {r6(f"avg(greatest({SCORE}, 0.0))")} AS "Timeliness_Mean_ts", {r6(f"max(greatest({SCORE}, 0.0))")} AS "Timeliness_Max_ts",
       {r6(f"min(greatest({SCORE}, 0.0))")} AS "Timeliness_Min_ts", '{AS_OF}' AS "Last_Analysis_Timestamp_ts" FROM events""")
def timeliness_profile(spark, sf_dir):
    measure = RowTimeliness([VALIDITY], instant(AS_OF))
    summary = summarise(table(spark, sf_dir, "events"), [measure], whole_table=True)
    return one_row(whole(summary), measure.profile_metrics())


TIMELINESS_VALUES = "WITH v AS (" + union([f"""
SELECT '{key_set_name(k)}' AS key_set, {sql_key(k)} AS key_value, avg({SCORE}) AS a, max({SCORE}) AS b, min({SCORE}) AS c
FROM events GROUP BY {', '.join(k)}""" for k in EVENT_KEYS]) + ")"


@query("timeliness_value", f"""{TIMELINESS_VALUES}
SELECT key_set, key_value, 'ts' AS attribute, {r6(clamp("a", high=False))} AS "TimelinessMean",
       {r6(clamp("b", high=False))} AS "TimelinessMax", {r6(clamp("c", high=False))} AS "TimelinessMin",
       '{AS_OF}' AS "AnalysisTime" FROM v""")
def timeliness_value(spark, sf_dir):
    measure, summary = _timeliness(spark, sf_dir, key_sets=EVENT_KEYS)
    return rounded(measure.value_table(summary, EVENT_KEYS))


@query("timeliness_attribute", f"""{TIMELINESS_VALUES}
SELECT key_set, 'ts' AS attribute, {r6(clamp("avg(a)", high=False))} AS "TimelinessMean",
       {r6(clamp("max(b)", high=False))} AS "TimelinessMax", {r6(clamp("min(c)", high=False))} AS "TimelinessMin",
       CAST(1.0 AS DOUBLE) AS "Confidence", '{AS_OF}' AS "AnalysisTime" FROM v GROUP BY key_set""")
def timeliness_attribute(spark, sf_dir):
    measure, summary = _timeliness(spark, sf_dir, key_sets=EVENT_KEYS)
    return rounded(measure.attribute_table(summary, EVENT_KEYS, 1.0))


@query("timeliness_tuple", f"""SELECT event_id, {r6(f"greatest({SCORE}, 0.0)")} AS "TIMELINESS_ts" FROM events""")
def timeliness_tuple(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(events.select("event_id", timeliness_row(events, VALIDITY, instant(AS_OF)).alias("TIMELINESS_ts")))


# Texts in a two-digit-year format, as batches of text sources hold them
@query("timeliness_text", f"""
WITH t AS (SELECT event_id, date_trunc('second', ts) AS ts FROM events)
SELECT event_id, {r6(f"greatest({SCORE}, 0.0)")} AS "TIMELINESS_t" FROM t""")
def timeliness_text(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "dd/MM/yy HH:mm:ss,000000").alias("t"))
    validity = Validity("t", "%d/%m/%y %H:%M:%S,%f", HOURS)
    return rounded(texts.select("event_id", timeliness_row(texts, validity, instant(AS_OF)).alias("TIMELINESS_t")))


# Frequency: rates come from the events before a split, counts from all events

SPLIT = "2024-01-16 00:00:00"
EARLIER_SECONDS = 15 * 3600.0
EARLIER = f"(SELECT * FROM events WHERE ts < TIMESTAMP '{SPLIT}')"
HOURLY_SQL = f"rates AS (SELECT hour(ts) AS h, 1.2 * count(*) / {EARLIER_SECONDS} AS f FROM {EARLIER} GROUP BY 1)"
HOURS_SQL = f"""{HOURLY_SQL},
counts AS (SELECT hour(ts) AS h, count(*) AS n, date_diff('day', min(ts)::DATE, max(ts)::DATE) + 1 AS days FROM events GROUP BY 1)
"""


def _earlier(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))


def _hourly_rates(spark, sf_dir):
    return (_earlier(spark, sf_dir).groupBy(F.hour("ts").alias("Hour"))
            .agg((1.2 * F.count(F.lit(1)) / EARLIER_SECONDS).alias("Frequency")))


@query("frequency_hour", f"""WITH {HOURS_SQL}
SELECT h AS "Hour", n AS "RecordNumber", {r6(clamp("n / (f * days * 3600.0)"))} AS "CompletenessFrequency"
FROM counts JOIN rates USING (h)""")
def hours(spark, sf_dir):
    return rounded(frequency_hour(table(spark, sf_dir, "events"), "ts", _hourly_rates(spark, sf_dir)))


@query("frequency_global", f"""WITH {HOURS_SQL}
SELECT {r6(f"avg({clamp('n / (f * days * 3600.0)')})")} AS "Completeness_Frequency_ts" FROM counts JOIN rates USING (h)""")
def hours_mean(spark, sf_dir):
    hourly = frequency_hour(table(spark, sf_dir, "events"), "ts", _hourly_rates(spark, sf_dir))
    return rounded(frequency_global(hourly, "ts"))


@query("frequency_profile", f"""WITH {HOURS_SQL}
SELECT {r6(f"avg({clamp('n / (f * 30 * 3600.0)')})")} AS "Completeness_Frequency_ts" FROM counts JOIN rates USING (h)""")
def hours_mean_one_day(spark, sf_dir):
    rates = _hourly_rates(spark, sf_dir).withColumn("Frequency", F.col("Frequency") * 30)
    hourly = frequency_hour(table(spark, sf_dir, "events"), "ts", rates, per_day=False)
    return rounded(frequency_global(hourly, "ts"))


VALUE_RATES_SQL = "rates AS (" + union([f"""
SELECT '{key_set_name(k)}' AS key_set, {sql_key(k)} AS key_value, hour(ts) AS h, count(*) / (30 * {EARLIER_SECONDS}) AS f
FROM {EARLIER} GROUP BY {', '.join(k)}, hour(ts)""" for k in EVENT_KEYS]) + ")"
FREQUENCY_VALUES = f"""WITH {VALUE_RATES_SQL},
joined AS ({union([f'''
SELECT r.key_set, r.key_value, r.h, r.f, e.ts FROM
(SELECT {sql_key(k)} AS key_value, hour(ts) AS h, ts FROM events) e JOIN rates r
ON r.key_set = '{key_set_name(k)}' AND r.key_value = e.key_value AND r.h = e.h''' for k in EVENT_KEYS])}),
per_hour AS (SELECT key_set, key_value, h, max(f) AS f, count(*) AS n, max(ts) AS hi, min(ts) AS lo FROM joined GROUP BY 1, 2, 3),
per_key AS (SELECT key_set, key_value, avg(f) AS f, CAST(sum(n) AS BIGINT) AS n,
            (epoch_us(max(hi)) - epoch_us(min(lo))) / 1e6 AS t FROM per_hour GROUP BY 1, 2),
v AS (SELECT key_set, key_value, n, least(1.0, n / (t * f)) AS score FROM per_key WHERE t * f <> 0)
"""


def _frequency_value(spark, sf_dir):
    earlier = _earlier(spark, sf_dir)
    rates = None
    for keys in EVENT_KEYS:
        value = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
        counted = (earlier.groupBy(F.lit(key_set_name(keys)).alias("Key"), value.alias("Value"), F.hour("ts").alias("Hour"))
                   .agg((F.count(F.lit(1)) / (30 * EARLIER_SECONDS)).alias("Frequency")))
        rates = counted if rates is None else rates.unionByName(counted)
    return frequency_value(table(spark, sf_dir, "events"), "ts", EVENT_KEYS, rates)


@query("frequency_value", f"""{FREQUENCY_VALUES}
SELECT key_set, key_value, 'ts' AS attribute, n AS "RecordNumber", {r6("score")} AS "CompletenessFrequencyValue" FROM v""")
def frequency_by_key(spark, sf_dir):
    return rounded(_frequency_value(spark, sf_dir))


@query("frequency_attribute", f"""{FREQUENCY_VALUES}
SELECT key_set, 'ts' AS attribute, CAST(sum(n) AS BIGINT) AS "RecordNumber", {r6("avg(score)")} AS "CompletenessFrequencyValue",
       CAST(1.0 AS DOUBLE) AS "Confidence" FROM v GROUP BY key_set""")
def frequency_by_attribute(spark, sf_dir):
    return rounded(frequency_attribute(_frequency_value(spark, sf_dir), 1.0))
