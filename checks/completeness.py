"""Documents with their labels, which most documents lack, give the missing cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.functions.cells import key_set_name
from plumbline.operators.completeness import Completeness, completeness_row
from plumbline.plans.summary import summarise, whole

from .registry import one_row, query, r6, rounded, sql_key, table, union

COLUMNS = ["doc_id", "lang", "source", "text", "quality", "toxic"]
KEY_SETS = [["lang"], ["lang", "source"], ["quality"]]
LABELLED = "labelled AS (SELECT d.doc_id, d.lang, d.source, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
TEXTS = ("lang", "source", "text")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
            .select(*COLUMNS))


def gap(column: str) -> str:
    """1 for a missing cell."""
    missing = f"{column} IS NULL" + (f" OR {column} IN ('', 'null', 'nan')" if column in TEXTS else "")
    return f"(CASE WHEN {missing} THEN 1 ELSE 0 END)"


def gaps(columns) -> str:
    return "(" + " + ".join(map(gap, columns)) + ")"


@query("completeness_global", f"""
WITH {LABELLED}
SELECT {r6(f"(count(*) * {len(COLUMNS)} - sum({gaps(COLUMNS)})) / CAST(count(*) * {len(COLUMNS)} AS DOUBLE)")} AS "Completeness_Missing"
FROM labelled""")
def completeness_global(spark, sf_dir):
    measure = Completeness(COLUMNS)
    summary = summarise(labelled(spark, sf_dir), [measure], whole_table=True)
    return one_row(whole(summary), measure.global_metrics())


def _attribute_sql(key_set):
    missing = f"CAST(sum({gap(key_set[0])}) AS BIGINT)" if len(key_set) == 1 else "CAST(0 AS BIGINT)"
    return f"""SELECT '{key_set_name(key_set)}' AS key_set, {missing} AS "MissingValues",
    {r6(f"(count(*) - {missing}) / CAST(count(*) AS DOUBLE)")} AS "CompletenessMissingValue",
    CAST(1.0 AS DOUBLE) AS "Confidence" FROM labelled"""


@query("completeness_attribute", f"WITH {LABELLED}\n" + union([_attribute_sql(k) for k in KEY_SETS]))
def completeness_attribute(spark, sf_dir):
    measure = Completeness(COLUMNS)
    summary = summarise(labelled(spark, sf_dir), [measure], whole_table=True)
    return rounded(measure.attribute_table(summary, KEY_SETS, 1.0))


def _value_sql(key_set):
    others = [c for c in COLUMNS if c not in key_set]
    where = f"WHERE {gap(key_set[0])} = 0" if len(key_set) == 1 else ""
    return f"""SELECT '{key_set_name(key_set)}' AS key_set, {sql_key(key_set)} AS key_value,
    CAST(sum({gaps(others)}) AS BIGINT) AS "MissingValues",
    {r6(f"(count(*) * {len(others)} - sum({gaps(others)})) / CAST(count(*) * {len(others)} AS DOUBLE)")} AS "CompletenessMissingValue"
    FROM labelled {where} GROUP BY {', '.join(key_set)}"""


@query("completeness_value", f"WITH {LABELLED}\n" + union([_value_sql(k) for k in KEY_SETS]))
def completeness_value(spark, sf_dir):
    measure = Completeness(COLUMNS)
    summary = summarise(labelled(spark, sf_dir), [measure], KEY_SETS)
    return rounded(measure.value_table(summary, KEY_SETS))


@query("completeness_tuple", f"""
WITH {LABELLED}
SELECT doc_id, {r6(f"({len(COLUMNS)} - {gaps(COLUMNS)}) / {len(COLUMNS)}.0")} AS "COMPLETENESS_MISSING" FROM labelled""")
def completeness_tuple(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return rounded(rows.select("doc_id", completeness_row(rows, COLUMNS).alias("COMPLETENESS_MISSING")))
