"""Selection, text sources and type inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators.inference import (ColumnTypes, DIMENSIONS, dimension_columns, infer_types,
                                           type_table)
from plumbline.operators.sampling import sampled_means
from plumbline.operators.selection import Range, drop_incomplete, sample_rows, select_rows
from plumbline.sources.readers import TextLayout, clean_line, split_cells

from .completeness import LABELLED, labelled
from .registry import query, r6, rounded, table, union

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_TYPES = ColumnTypes({"o_orderkey": "float", "o_custkey": "float", "o_orderstatus": "string",
                           "o_totalprice": "float", "o_orderdate": "datetime", "o_orderpriority": "string"})
ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders"


@query("range_filter", f"""{ORDER_SQL}
WHERE ((o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1995-06-30 00:00:00')
    OR (o_orderdate >= TIMESTAMP '1995-03-01 00:00:00' AND o_orderdate <= TIMESTAMP '1995-09-30 00:00:00')
    OR o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')
  AND o_totalprice >= 9000.5 AND o_totalprice <= 250000""")
def ranges(spark, sf_dir):
    limits = {"o_orderdate": [Range.parse(r) for r in (
                  "01/01/1995 00.00.00:30/06/1995 00.00.00", "01/03/1995 00.00.00:30/09/1995 00.00.00",
                  "01/01/2001 00.00.00:")],
              "o_totalprice": [Range.parse("9000.5:250000")]}
    return rounded(select_rows(table(spark, sf_dir, "orders"), ORDER_COLUMNS, limits, {}, ORDER_TYPES))


@query("range_filter_text", f"""{ORDER_SQL}
WHERE (o_orderpriority >= '2' AND o_orderpriority <= '4' OR o_orderpriority <= '1-URGENT') AND o_orderstatus >= 'O'""")
def ranges_of_texts(spark, sf_dir):
    limits = {"o_orderpriority": [Range("2", "4"), Range(None, "1-URGENT")], "o_orderstatus": [Range("O")]}
    return rounded(select_rows(table(spark, sf_dir, "orders"), ORDER_COLUMNS, limits, {}, ORDER_TYPES))


@query("value_filter", f"""{ORDER_SQL}
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus IN ('F', 'P')""")
def value_lists(spark, sf_dir):
    listed = {"o_orderpriority": ["1-URGENT", "5-LOW"], "o_orderstatus": ["F", "P"]}
    return rounded(select_rows(table(spark, sf_dir, "orders"), ORDER_COLUMNS, {}, listed, ORDER_TYPES))


# Numbers written in several ways in a text column: a listed number finds them all
@query("value_filter_text", """
SELECT CASE l_linenumber % 3 WHEN 0 THEN '0' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',0'
       ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity, l_returnflag FROM lineitem WHERE l_quantity IN (5, 17) AND l_returnflag IN ('A', 'N')""")
def value_list_of_texts(spark, sf_dir):
    whole, kind = F.col("l_quantity").cast("long").cast("string"), F.col("l_linenumber") % 3
    rows = table(spark, sf_dir, "lineitem").select(F.when(kind == 0, F.concat(F.lit("0"), whole)).when(kind == 1, F.concat(whole, F.lit(",0"))).otherwise(whole).alias("quantity"),
                                                   "l_returnflag")
    types = ColumnTypes({"quantity": "float", "l_returnflag": "string"})
    return select_rows(rows, ["quantity", "l_returnflag"], {}, {"quantity": ["5", "17,0", "x"], "l_returnflag": ["A", "N"]}, types)


@query("drop_incomplete", f"""WITH {LABELLED}
SELECT doc_id, lang, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labelled
WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def complete_rows(spark, sf_dir):
    columns = ["doc_id", "lang", "quality", "toxic"]
    return rounded(drop_incomplete(labelled(spark, sf_dir), columns).select(*columns))


# What holds for any sample: rows of the table, none twice, about as many as asked for
@query("sample_confidence", """
SELECT true AS subset, true AS no_repeats, count(*) > 0 AS share_is_near, CAST(0.25 AS DOUBLE) AS "Confidence" FROM lineitem""")
def sampled(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey")
    rows = sample_rows(lineitem, 0.25, seed=7)
    facts = lineitem.groupBy(*lineitem.columns).agg(F.count(F.lit(1)).alias("there")).join(
        rows.groupBy(*lineitem.columns).agg(F.count(F.lit(1)).alias("taken")), lineitem.columns, "full")
    return facts.agg(F.max("there").isNotNull().alias("some"), F.bool_and(F.col("there").isNotNull()).alias("subset"),
                     F.bool_and(F.coalesce("taken", F.lit(0)) <= F.col("there")).alias("no_repeats"),
                     (F.abs(F.sum("taken") / F.sum("there") - 0.25) < 0.02).alias("share_is_near")) \
        .select("subset", "no_repeats", "share_is_near", F.lit(0.25).alias("Confidence"))


# Text batches

LINE = "'[' || l_orderkey || '][' || l_linenumber || '][\"' || l_returnflag || '\"][' || replace(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS {text}), '.', ',') || ']'"


@query("text_source", """
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, CAST(l_linenumber AS VARCHAR) AS linenumber, l_returnflag AS flag,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS price, CAST(NULL AS VARCHAR) AS absent FROM lineitem""")
def lines_with_layout(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(LINE.format(text="STRING") + " AS value")
    return split_cells(lines, ["orderkey", "linenumber", "flag", "price", "absent"], TextLayout("[", "]"))


@query("line_cleaning", r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '"', '', 'g'), '\\', '', 'g'),
                              '(\d+),(\d+)', '\1.\2', 'g') AS cleaned FROM documents""")
def cleaned_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_line(F.col("text")).alias("cleaned"))


# Types of text columns: numbers with decimal commas, two time formats, and a column of both numbers and words

FORMATS = ["%d/%m/%y %H:%M:%S", "%Y-%m-%d"]
FORMAT_SQL = {"%d/%m/%y %H:%M:%S": "'%d/%m/%y %H:%M:%S'", "%Y-%m-%d": "'%Y-%m-%d'"}
TEXTS = ["quantity", "flag", "shipped", "day", "mixed", "part"]


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.regexp_replace(F.col("l_quantity").cast("decimal(12,2)").cast("string"), r"\.", ",").alias("quantity"),
        F.col("l_returnflag").alias("flag"), F.date_format("l_shipdate", "dd/MM/yy HH:mm:ss").alias("shipped"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("l_linenumber") > 6, "many").otherwise(F.col("l_linenumber").cast("string")).alias("mixed"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("part"))


INFERENCE_SQL = f"""
WITH t AS (SELECT replace(CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS quantity, l_returnflag AS flag,
    strftime(l_shipdate, '%d/%m/%y %H:%M:%S') AS shipped, strftime(l_shipdate, '%Y-%m-%d') AS "day",
    CASE WHEN l_linenumber > 6 THEN 'many' ELSE CAST(l_linenumber AS VARCHAR) END AS mixed,
    lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS part FROM lineitem),
kinds AS ({union([f'''SELECT '{c}' AS "column", CASE
    WHEN count(TRY_CAST(replace("{c}", ',', '.') AS DOUBLE)) = count("{c}") THEN 'float'
    {" ".join(f"WHEN count(try_strptime({chr(34)}{c}{chr(34)}, {FORMAT_SQL[f]})) = count({chr(34)}{c}{chr(34)}) THEN '{f}'" for f in FORMATS)}
    ELSE 'string' END AS kind FROM t''' for c in TEXTS])})
"""


@query("type_inference", f"""{INFERENCE_SQL}
SELECT "column", CASE WHEN kind IN ('float', 'string') THEN kind ELSE 'datetime' END AS type,
       CASE WHEN kind IN ('float', 'string') THEN NULL ELSE kind END AS format FROM kinds""")
def types_of_texts(spark, sf_dir):
    return type_table(_texts(spark, sf_dir), TEXTS, FORMATS)


# The column types each dimension can be measured on, stated again for the SQL.
ALLOWED_SQL = {"Completeness_Missing": "float string datetime", "Completeness_Frequency": "datetime",
               "Accuracy": "float", "Completeness_Population": "float string", "Volume": "float string",
               "Precision": "float", "Consistency": "float string datetime", "Timeliness": "datetime",
               "Distinctness": "float string"}


@query("dimension_columns", f"""{INFERENCE_SQL},
allowed AS ({union([f"SELECT '{d}' AS dimension, '{k}' AS type" for d, kinds in ALLOWED_SQL.items() for k in kinds.split()])})
SELECT dimension, "column" FROM kinds JOIN allowed
ON type = CASE WHEN kind IN ('float', 'string') THEN kind ELSE 'datetime' END""")
def columns_of_dimensions(spark, sf_dir):
    found = dimension_columns(infer_types(_texts(spark, sf_dir), FORMATS))
    return spark.createDataFrame([(d, c) for d in DIMENSIONS for c in found[d]], "dimension string, column string")


# Means of row scores from a sample of every key, beside the exact ones: these lie within the bounds

SUM_ERROR = 1e-12               # of a mean of doubles between 0 and 1, by the order they are added in
SCORE = "greatest(0.0, 1 - abs((l_quantity - 25.0) / 20.0))"


@query("sample_bounds", f"""
SELECT 'accuracy' AS metric, {r6(f"avg({SCORE})")} AS exact, true AS within, true AS narrow, count(*) AS "rows" FROM lineitem
UNION ALL SELECT 'cheap', {r6("avg(CASE WHEN l_extendedprice < 20000 THEN 1.0 ELSE 0.0 END)")}, true, true, count(*) FROM lineitem""")
def bounds_of_sampled_means(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    scores = {"accuracy": F.greatest(F.lit(0.0), 1 - F.abs((F.col("l_quantity") - 25.0) / 20.0)), "cheap": (F.col("l_extendedprice") < 20000).cast("double")}
    found = sampled_means(lines, scores, ["l_returnflag", "l_linestatus", "l_linenumber"], 1000, sigmas=4.0)
    exact = lines.agg(*[F.avg(c).alias(n) for n, c in scores.items()]).select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("exact")) for n in scores])))
    # Where every stratum is taken whole, the bounds are one number: the same sum, added up in another order.
    within = F.col("exact").between(F.col("low") - SUM_ERROR, F.col("high") + SUM_ERROR)
    return rounded(found.join(exact, "metric").select("metric", "exact", within.alias("within"),
                                                      (F.col("high") - F.col("low") < 0.05).alias("narrow"), "rows"))
