"""Volume, accuracy and precision."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.cells import key_set_name
from plumbline.operators.accuracy import Accuracy, Expected
from plumbline.operators.inference import ColumnTypes
from plumbline.operators.precision import Precision
from plumbline.operators.selection import Range, select_rows
from plumbline.operators.volume import volume_global, volume_value
from plumbline.plans.summary import summarise, whole

from .registry import clamp, one_row, query, r6, rounded, sql_key, table, union

FLAGS = [["l_returnflag"], ["l_returnflag", "l_linestatus"], ["l_linenumber"]]
SHIPPED = {"l_shipdate": [Range("01/01/1996 00.00.00", "31/12/1998 23.59.59")]}
SHIPPED_SQL = "l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' AND l_shipdate <= TIMESTAMP '1998-12-31 23:59:59'"
LINEITEM_TYPES = ColumnTypes({"l_returnflag": "string", "l_linestatus": "string", "l_linenumber": "float",
                              "l_shipdate": "datetime", "l_quantity": "float", "l_extendedprice": "float"})


def _shipped(spark, sf_dir):
    """Selected lines, and the count before the selection as a scalar subquery."""
    lineitem = table(spark, sf_dir, "lineitem")
    total = lineitem.agg(F.count(F.lit(1))).scalar()
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate"]
    return select_rows(lineitem, columns, SHIPPED, {}, LINEITEM_TYPES), total


@query("volume_global", f"""
SELECT {r6("least(1.0, count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE))")} AS "Volume",
       count(*) AS "Volume_TotalRows"
FROM lineitem WHERE {SHIPPED_SQL}""")
def volume_of_selection(spark, sf_dir):
    rows, total = _shipped(spark, sf_dir)
    return one_row(whole(summarise(rows, [], whole_table=True)), volume_global(total))


@query("volume_value", union([f"""
SELECT '{key_set_name(k)}' AS key_set, {sql_key(k)} AS key_value, count(*) AS "Count",
       {r6("count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE)")} AS "VolumeValue"
FROM lineitem WHERE {SHIPPED_SQL} GROUP BY {', '.join(k)}""" for k in FLAGS]))
def volume_by_key(spark, sf_dir):
    rows, total = _shipped(spark, sf_dir)
    return rounded(volume_value(summarise(rows, [], FLAGS), total))


# Accuracy

EXPECTED = [Expected("l_quantity", 25, 20), Expected("l_extendedprice", 50000, 60000)]


def _score(e: Expected) -> str:
    return f"greatest(0.0, 1 - abs(({e.column} - {float(e.mean)}) / {float(e.width) / 2}))"


def _accuracy_value_sql(key_set, e):
    return f"""SELECT '{key_set_name(key_set)}' AS key_set, {sql_key(key_set)} AS key_value, '{e.column}' AS attribute,
    avg({_score(e)}) AS dynamic, avg(ceil({_score(e)})) AS static FROM lineitem GROUP BY {', '.join(key_set)}"""


ACCURACY_VALUES = "WITH v AS (" + union([_accuracy_value_sql(k, e) for k in FLAGS for e in EXPECTED]) + ")"


def _accuracy(spark, sf_dir, **what):
    measure = Accuracy(EXPECTED)
    return measure, summarise(table(spark, sf_dir, "lineitem"), [measure], **what)


@query("accuracy_global", "SELECT " + ", ".join(
    f"""{r6(f"avg(ceil({_score(e)}))")} AS "Accuracy_Static_{e.column}",
        {r6(f"avg({_score(e)})")} AS "Accuracy_Dynamic_{e.column}" """ for e in EXPECTED) + " FROM lineitem")
def accuracy_global(spark, sf_dir):
    measure, summary = _accuracy(spark, sf_dir, whole_table=True)
    return one_row(whole(summary), measure.global_metrics())


@query("accuracy_value", f"""{ACCURACY_VALUES}
SELECT key_set, key_value, attribute, {r6("dynamic")} AS "AccuracyDynamic", {r6("static")} AS "AccuracyStatic" FROM v""")
def accuracy_value(spark, sf_dir):
    measure, summary = _accuracy(spark, sf_dir, key_sets=FLAGS)
    return rounded(measure.value_table(summary, FLAGS))


@query("accuracy_attribute", f"""{ACCURACY_VALUES}
SELECT key_set, attribute, {r6("avg(dynamic)")} AS "AccuracyDynamic", {r6("avg(static)")} AS "AccuracyStatic",
       CAST(1.0 AS DOUBLE) AS "Confidence" FROM v GROUP BY key_set, attribute""")
def accuracy_attribute(spark, sf_dir):
    measure, summary = _accuracy(spark, sf_dir, key_sets=FLAGS)
    return rounded(measure.attribute_table(summary, FLAGS, 1.0))


# Precision: the balances lie on both sides of 0, so they are shifted by their minimum

NUMBERS = ["c_acctbal", "c_custkey"]
SEGMENTS = [["c_mktsegment"], ["c_nationkey", "c_mktsegment"], ["c_custkey"]]
PRECISION_KEYS = [(k, c) for k in SEGMENTS for c in NUMBERS if c not in k]


def _shift_sql(c: str) -> str:
    return f"(SELECT CASE WHEN min({c}) < 0 AND max({c}) > 0 THEN abs(min({c})) ELSE 0.0 END FROM customer)"


def _precision_sql(deviation: str, centre: str) -> str:
    """A centre of 0 has no precision; greatest() alone would turn its NULL into 0."""
    return f"CASE WHEN {centre} <> 0 THEN greatest(0.0, 1 - {deviation} / abs({centre})) END"


def _precision_value_sql(key_set, c):
    return f"""SELECT '{key_set_name(key_set)}' AS key_set, {sql_key(key_set)} AS key_value, '{c}' AS attribute,
    avg({c}) AS mean, {_precision_sql(f"stddev_pop({c})", f"avg({c}) + {_shift_sql(c)}")} AS precise,
    stddev_pop({c}) AS deviation FROM customer GROUP BY {', '.join(key_set)}"""


PRECISION_VALUES = "WITH v AS (" + union([_precision_value_sql(k, c) for k, c in PRECISION_KEYS]) + ")"


@query("precision_global", "SELECT " + ", ".join(
    f"""{r6(_precision_sql(f"stddev_pop({c})", f"abs(avg({c})) + {_shift_sql(c)}"))} AS "Precision_{c}",
        {r6(f"stddev_pop({c})")} AS "Precision_Deviation_{c}" """ for c in NUMBERS) + " FROM customer")
def precision_global(spark, sf_dir):
    measure = Precision(NUMBERS)
    summary = summarise(table(spark, sf_dir, "customer"), [measure], whole_table=True)
    return one_row(whole(summary), measure.global_metrics())


@query("precision_profile", "SELECT " + ", ".join(
    f"""{r6(_precision_sql(f"stddev_pop({c})", f"avg({c}) + {_shift_sql(c)}"))} AS "Precision_{c}",
        {r6(f"stddev_pop({c})")} AS "Precision_Deviation_{c}", {r6(f"min({c})")} AS "Min_Value_{c}",
        {r6(f"max({c})")} AS "Max_Value_{c}", count({c}) AS "Number_Count_{c}",
        {r6(f"avg({c})")} AS "Number_Mean_{c}", {r6(f"stddev_pop({c})")} AS "Pooled_Deviation_{c}" """
    for c in NUMBERS) + " FROM customer")
def precision_profile(spark, sf_dir):
    measure = Precision(NUMBERS)
    summary = summarise(table(spark, sf_dir, "customer"), [measure], whole_table=True)
    return one_row(whole(summary), measure.profile_metrics())


# Only whole numbers of two digits and more and decimals with digits around the point pass the literal pattern
@query("precision_digits_only", f"""
WITH n AS (SELECT l_quantity, CAST(l_quantity AS BIGINT)::VARCHAR AS t FROM lineitem),
     d AS (SELECT CAST(t AS DOUBLE) AS x FROM n WHERE regexp_matches(t, '^\\d+?(\\.|\\,)?\\d+?$'))
SELECT {r6(_precision_sql("stddev_pop(x)", "avg(x)"))} AS "Precision_quantity", {r6("stddev_pop(x)")} AS "Precision_Deviation_quantity",
       {r6("min(x)")} AS "Min_Value_quantity", {r6("max(x)")} AS "Max_Value_quantity", count(x) AS "Number_Count_quantity",
       {r6("avg(x)")} AS "Number_Mean_quantity", {r6("stddev_pop(x)")} AS "Pooled_Deviation_quantity" FROM d""")
def precision_digits_only(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("long").cast("string").alias("quantity"))
    measure = Precision(["quantity"], digits_only=True)
    return one_row(whole(summarise(texts, [measure], whole_table=True)), measure.profile_metrics())


def _precision_groups(spark, sf_dir):
    customer, measure = table(spark, sf_dir, "customer"), Precision(NUMBERS)
    return measure, summarise(customer, [measure], SEGMENTS), summarise(customer, [measure], whole_table=True)


@query("precision_value", f"""{PRECISION_VALUES}
SELECT key_set, key_value, attribute, {r6("mean")} AS "Mean", {r6("precise")} AS "Precision",
       {r6("deviation")} AS "StandardDeviation" FROM v""")
def precision_value(spark, sf_dir):
    measure, summary, whole_table = _precision_groups(spark, sf_dir)
    return rounded(measure.value_table(summary, SEGMENTS, whole_table))


@query("precision_attribute", f"""{PRECISION_VALUES}
SELECT key_set, attribute, {r6("avg(mean)")} AS "Mean", {r6("avg(precise)")} AS "Precision",
       {r6("avg(deviation)")} AS "StandardDeviation", CAST(1.0 AS DOUBLE) AS "Confidence"
FROM v GROUP BY key_set, attribute""")
def precision_attribute(spark, sf_dir):
    measure, summary, whole_table = _precision_groups(spark, sf_dir)
    return rounded(measure.attribute_table(summary, SEGMENTS, whole_table, 1.0))
