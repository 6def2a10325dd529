"""Batches read from files: written from the tables into the work folder, profiled, assessed, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import AssessmentSpec, ProfileSpec, Range, SourceState, TextLayout, assess, profile_files
from plumbline.functions.times import dated_names
from plumbline.operators.inference import infer_types
from plumbline.sources.readers import parse_batch, read_batch

from .registry import query, r6, rounded, table, union, work_folder

HOURS, FIRST_RUN, SECOND_RUN, ASSESSED = 1000.123457, "2024-01-16 00:00:00", "2024-02-01 00:00:00", "2024-02-10 00:00:00"
FORMAT, DAYS = "%d/%m/%y %H:%M:%S", ("20240101", "20240116")
BEFORE, AFTER = "ts < TIMESTAMP '2024-01-16 00:00:00'", "ts >= TIMESTAMP '2024-01-16 00:00:00'"
TEXTS_SQL = "event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, strftime(ts, '%d/%m/%y %H:%M:%S') AS ts"


def _age(as_of: str) -> str:
    return r6(f"greatest(1 - (epoch_us(TIMESTAMP '{as_of}') - epoch_us(date_trunc('second', ts))) / 1e6 / ({HOURS} * 3600.0), 0.0)")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
                                                 F.date_format("ts", "dd/MM/yy HH:mm:ss").alias("ts"), F.col("ts").alias("at"))


def _profiled_files(spark, sf_dir) -> tuple[SourceState, str]:
    """Two days' JSON files, named by a dated series, profiled one after the other."""
    folder = work_folder(spark)
    names = dated_names(f"{folder}/in/events_%Y%m%d", f"{folder}/in/events_{DAYS[0]}", f"{folder}/in/events_{DAYS[1]}", 15)
    spec = ProfileSpec(f"{folder}/source", HOURS, (FORMAT,))
    for name, half, as_of in zip(names, (F.col("at") < F.lit(FIRST_RUN).cast("timestamp_ntz"), F.col("at") >= F.lit(FIRST_RUN).cast("timestamp_ntz")),
                                 (FIRST_RUN, SECOND_RUN), strict=True):
        _events(spark, sf_dir).filter(half).drop("at").write.json(name)
        profile_files(spark, [name], spec, as_of)
    return SourceState(spark, spec.result_folder), folder


@query("json_batches", union([f"""
SELECT {TEXTS_SQL}, CAST(1.0 AS DOUBLE) AS "COMPLETENESS_MISSING", {_age(as_of)} AS "TIMELINESS_ts", 'events_{day}' AS batch FROM events WHERE {half}"""
                              for day, half, as_of in zip(DAYS, (BEFORE, AFTER), (FIRST_RUN, SECOND_RUN))]))
def json_batches(spark, sf_dir):
    state, _ = _profiled_files(spark, sf_dir)
    return rounded(state.extended(state.metadata()))


@query("json_batch_metadata", union([f"""
SELECT '{column}' AS "column", '{kind}' AS kind, {form} AS format, {hours} AS hours, count(*) > 0 AS filled FROM events"""
                                     for column, kind, form in (("event_type", "string", "NULL"), ("value", "float", "NULL"), ("ts", "datetime", f"'{FORMAT}'"))
                                     for hours in (f"CAST({HOURS} AS DOUBLE)",)]))
def json_batch_metadata(spark, sf_dir):
    state, _ = _profiled_files(spark, sf_dir)
    found = state.metadata()
    filled = state.extended(found).agg(*[(F.count(c) > 0).alias(c) for c in found.columns]).head()
    return spark.createDataFrame([(c, found.types.kinds[c], found.types.formats.get(c), found.volatility_hours, filled[c]) for c in found.columns],
                                 "column string, kind string, format string, hours double, filled boolean")


@query("source_summary_only", f"""
SELECT CAST(2 AS BIGINT) AS "UpdatesCount", count(*) AS "Volume_TotalRows", {r6("min(CAST(value AS DECIMAL(18,2)))")} AS "Min_Value_value",
  {r6("max(CAST(value AS DECIMAL(18,2)))")} AS "Max_Value_value", count(DISTINCT event_type) AS "Distinct_Number_event_type" FROM events""")
def source_summary_only(spark, sf_dir):
    state, folder = _profiled_files(spark, sf_dir)
    result = assess(spark, AssessmentSpec((), {}, source_folder=state.root, output_folder=f"{folder}/out", source_summary=True), ASSESSED)
    return rounded(spark.read.parquet(result.tables["source_quality"]).select(
        "UpdatesCount", "Volume_TotalRows", "Min_Value_value", "Max_Value_value", "Distinct_Number_event_type"))


def _assessed(spark, sf_dir, **more):
    """A range of days on the text column, the rows scored again, and a list of valid combinations the source does not know."""
    state, folder = _profiled_files(spark, sf_dir)
    table(spark, sf_dir, "events").filter("event_id % 2 = 0").select("event_type").distinct().write.json(f"{folder}/valid")
    spec = AssessmentSpec(
        ("event_type", "value", "ts"), {"Volume": ["global"], "Precision": ["global"], "Timeliness": ["global", "tuple"], "Consistency": ["tuple"]},
        source_folder=state.root, output_folder=f"{folder}/out", binding_paths=(f"{folder}/valid",),
        ranges={"ts": [Range("05/01/2024 00.00.00", "20/01/2024 12.00.00")], "value": [Range("10", None)]}, **more)
    result = assess(spark, spec, ASSESSED)
    assert not result.errors, result.errors
    return {name: spark.read.parquet(path) for name, path in result.tables.items()}


SELECTED = """date_trunc('second', ts) >= TIMESTAMP '2024-01-05 00:00:00' AND date_trunc('second', ts) <= TIMESTAMP '2024-01-20 12:00:00'
    AND CAST(value AS DECIMAL(18,2)) >= 10"""


@query("assessed_text_source", f"""
SELECT {r6("least(1.0, count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE))")} AS "Volume", count(*) AS "Volume_TotalRows",
  {r6("stddev_pop(CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE))")} AS "Precision_Deviation_value" FROM events WHERE {SELECTED}""")
def assessed_text_source(spark, sf_dir):
    return rounded(_assessed(spark, sf_dir)["final_quality"].select("Volume", "Volume_TotalRows", "Precision_Deviation_value"))


@query("assessed_rows_rescored", f"""
SELECT {TEXTS_SQL}, CAST(1.0 AS DOUBLE) AS "COMPLETENESS_MISSING", {_age(ASSESSED)} AS "TIMELINESS_ts",
  CASE WHEN event_type IN (SELECT event_type FROM events WHERE event_id % 2 = 0) THEN 1.0 ELSE 0.0 END::DOUBLE AS "ASSOCIATION_CONSISTENCY" FROM events""")
def assessed_rows_rescored(spark, sf_dir):
    rows = _assessed(spark, sf_dir)["extended_dataset"]
    return rounded(rows.select("event_type", "value", "ts", "COMPLETENESS_MISSING", "TIMELINESS_ts", "ASSOCIATION_CONSISTENCY"))


# Text files whose first lines name the columns, and delimited text with reader options

LINES_SQL = "SELECT l_returnflag AS flag, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS price, strftime(l_shipdate, '%d/%m/%y %H:%M:%S') AS day FROM lineitem"


FILE_ROWS = 500_000             # of a text file, about: one task writes it


def _text_files(spark, sf_dir, header: bool) -> str:
    """Text files of the lines, four or more as there are rows, each with its header line first."""
    lineitem = table(spark, sf_dir, "lineitem")
    n = max(4, -(-lineitem.count() // FILE_ROWS))
    lines = lineitem.select(
        F.concat(F.lit("["), F.col("l_returnflag"), F.lit("]["), F.col("l_extendedprice").cast("decimal(14,2)").cast("string"), F.lit("]["),
                 F.date_format("l_shipdate", "dd/MM/yy HH:mm:ss"), F.lit("]")).alias("value"), F.floor(F.rand(3) * n).cast("int").alias("file"), F.lit(1).alias("row"))
    if header:
        lines = lines.unionByName(spark.range(n).select(F.lit("flag,price,day").alias("value"), F.col("id").cast("int").alias("file"), F.lit(0).alias("row")))
    path = f"{work_folder(spark)}/lines"
    lines = lines.repartitionById(n, F.col("file"))
    (lines.sortWithinPartitions("row") if header else lines).select("value").write.text(path)
    return path


@query("header_line_source", LINES_SQL)
def header_line_source(spark, sf_dir):
    return read_batch(spark, [_text_files(spark, sf_dir, True)], "text", TextLayout("[", "]"))


@query("text_layout_types", f"""WITH t AS ({LINES_SQL})
SELECT 'flag' AS "column", 'string' AS kind, NULL AS format, count(flag) AS filled FROM t UNION ALL
SELECT 'price', 'float', NULL, count(price) FROM t UNION ALL SELECT 'day', 'datetime', '{FORMAT}', count("day") FROM t""")
def text_layout_types(spark, sf_dir):
    layout = TextLayout("[", "]", ("flag", "price", "day"), (FORMAT,))
    rows = read_batch(spark, [_text_files(spark, sf_dir, False)], "text", layout)
    types = infer_types(rows, ProfileSpec("", file_format="text", layout=layout).all_time_formats)
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).head()
    return spark.createDataFrame([(c, types.kinds[c], types.formats.get(c), filled[c]) for c in rows.columns],
                                 "column string, kind string, format string, filled bigint")


@query("csv_source", LINES_SQL)
def csv_source(spark, sf_dir):
    path = f"{work_folder(spark)}/csv"
    table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").cast("decimal(14,2)").cast("string").alias("price"),
        F.date_format("l_shipdate", "dd/MM/yy HH:mm:ss").alias("day")).write.option("header", "true").option("sep", ";").csv(path)
    return read_batch(spark, [path], "csv", options={"header": "true", "sep": ";"})


# Raw lines parsed once: objects, arrays of objects, and lines that are neither

ODD_LINES_SQL = "SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS \"user\", event_id % 10 AS kind FROM events"


def _odd_batch(spark, sf_dir):
    """Events as JSON lines: an object each, every tenth as an array of itself and a copy, every tenth cut off."""
    folder = work_folder(spark)
    event = F.to_json(F.struct("event_type", F.col("user_id").cast("string").alias("user")))
    kind = F.col("event_id") % 10
    lines = table(spark, sf_dir, "events").select(
        F.when(kind == 3, F.concat(F.lit("["), event, F.lit(", "), event, F.lit("]"))).when(kind == 7, F.rtrim(event, F.lit("}"))).otherwise(event).alias("value"))
    lines.write.text(f"{folder}/lines")
    return parse_batch(spark, [f"{folder}/lines"], f"{folder}/staged")


@query("json_parsed_once", f"""
WITH e AS ({ODD_LINES_SQL})
SELECT event_type, "user", CAST(sum(CASE WHEN kind = 3 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM e WHERE kind <> 7 GROUP BY event_type, "user"
""")
def json_parsed_once(spark, sf_dir):
    return _odd_batch(spark, sf_dir).rows.groupBy("event_type", "user").agg(F.count(F.lit(1)).alias("n"))


@query("json_line_counts", f"""
WITH e AS ({ODD_LINES_SQL})
SELECT CAST(sum(CASE kind WHEN 3 THEN 2 WHEN 7 THEN 0 ELSE 1 END) AS BIGINT) AS n_rows, count(*) FILTER (WHERE kind = 7) AS n_malformed,
       count(DISTINCT event_type || "user") FILTER (WHERE kind = 7) AS n_lines FROM e""")
def json_line_counts(spark, sf_dir):
    batch = _odd_batch(spark, sf_dir)
    return batch.malformed.agg(F.lit(batch.n_rows).cast("long").alias("n_rows"), F.lit(batch.n_malformed).cast("long").alias("n_malformed"),
                               F.count_distinct("line").alias("n_lines"))
