"""Batches of a source: JSON lines, delimited text with a layout, and typed tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import cell, is_text
from ..plans.staging import stage

DIGEST_DIGITS = 16              # of the digest of a batch's paths
CORRUPT = "_corrupt_record"
CELLS = "map<string,string>"
MAX_FIELDS = 10_000


def json_entries(lines: DataFrame) -> DataFrame:
    """``cells, line`` of text lines in column ``value``: a row with its cells for each JSON object, those of an array of objects too, and a row
    with the line itself where it holds anything else. Every line is parsed once and is either data or malformed.

    Cells are texts; a nested one is its JSON text. Blank lines are nothing, an empty array is data without a row. Of a field that an object
    names twice the first one counts.
    """
    kept = lines.filter(F.trim("value") != "")
    many = F.ltrim("value").startswith("[")
    parsed = F.when(many, F.from_json("value", "array<map<string,string>>")).otherwise(F.array(F.from_json("value", "map<string,string>")))
    whole = parsed.isNotNull() & F.forall(parsed, lambda cells: cells.isNotNull())
    found = kept.select("value", F.when(F.col("value").isNotNull(), F.struct(parsed.alias("entries"), whole.alias("whole"))).alias("p"))
    rows = F.transform("p.entries", lambda cells: F.struct(cells.alias("cells"), F.lit(None).cast("string").alias("line")))
    bad = F.array(F.struct(F.lit(None).cast(CELLS).alias("cells"), F.col("value").alias("line")))
    return found.select(F.inline(F.when(F.col("p.whole"), rows).otherwise(bad)))


def field_names(entries: DataFrame, source: object) -> list[str]:
    """Names of all fields of parsed objects, in order. They come to the driver, so more than ``MAX_FIELDS`` are an error."""
    names = entries.select(F.explode(F.map_keys("cells")).alias("name")).distinct().limit(MAX_FIELDS + 1).collect()
    if not names:
        raise ValueError(f"no JSON objects in {source}")
    if len(names) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields in {source}")
    return sorted(r["name"] for r in names)


def entry_cells(entries: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The cells of parsed objects as text columns; fields that are not named are left out."""
    return entries.filter(F.col("cells").isNotNull()).select(*[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns])


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def read_json(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """JSON lines, every cell a text. Without ``columns`` the field names are found by a pass over the data.

    Lines that hold anything but objects are neither rows nor columns; ``malformed_lines`` has them.
    """
    entries = json_entries(_lines(spark, paths))
    return entry_cells(entries, columns or field_names(entries, paths))


def malformed_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``line`` of every line of JSON files that ``read_json`` takes no row from."""
    return json_entries(_lines(spark, paths)).filter(F.col("line").isNotNull()).select("line")


@dataclass(frozen=True)
class ParsedBatch:
    """A batch of files, parsed once and staged: its rows, how many they are, and the lines that are no data."""

    rows: DataFrame
    n_rows: int
    malformed: DataFrame | None = None
    n_malformed: int = 0


def parse_batch(spark: SparkSession, paths: Sequence[str], folder: str, file_format: str = "json", layout: "TextLayout | None" = None,
                columns: Sequence[str] | None = None, options: Mapping[str, str] | None = None) -> ParsedBatch:
    """Read a batch of text or JSON files in one scan, which also counts rows and malformed lines, into tables below ``folder``.

    All that follows (field names, types, rows) reads those tables, a column at a time. Files of typed formats are read as they are.
    """
    counts = Observation()
    if file_format == "json" and layout is None:
        entries = json_entries(_lines(spark, paths))
        if columns:
            cells = [F.try_element_at("cells", F.lit(c)).alias(f"c{i}") for i, c in enumerate(columns)]
            entries = entries.select(F.col("cells").isNotNull().alias("row"), "line", *cells)
        else:
            entries = entries.select(F.col("cells").isNotNull().alias("row"), "line", "cells")
        found = stage(entries.observe(counts, F.count_if("row").alias("rows"), F.count("line").alias("malformed")), folder, "parsed")
        if columns:
            rows = found.filter("row").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
        else:
            rows = stage(entry_cells(found, field_names(found, paths)), folder, "rows")
        return ParsedBatch(rows, counts.get["rows"], found.filter("NOT row").select("line"), counts.get["malformed"])
    rows = read_batch(spark, paths, file_format, layout, columns, options)
    if not all(is_text(f.dataType) for f in rows.schema.fields):
        return ParsedBatch(rows, -1)
    rows = stage(rows.observe(counts, F.count(F.lit(1)).alias("rows")), folder, "parsed")
    return ParsedBatch(rows, counts.get["rows"])


@dataclass(frozen=True)
class TextLayout:
    """How to cut lines into cells: each cell stands between one of ``before`` and one of ``after``.

    Without a ``header`` the first line names the columns, separated by commas, and is not data.
    """

    before: str
    after: str
    header: tuple[str, ...] | None = None
    time_formats: tuple[str, ...] = ()

    @property
    def cell_pattern(self) -> str:
        def char_class(chars: str) -> str:
            unique = "".join(dict.fromkeys(chars.replace('"', "")))
            if not unique:
                raise ValueError("a text layout needs at least one character before and after a cell")
            return "[" + re.sub(r"([\\\[\]^&-])", r"\\\1", unique) + "]"
        return char_class(self.before) + "(.*?)" + char_class(self.after)


def clean_line(line: Column) -> Column:
    """Without double quotes and backslashes, decimal commas as points."""
    cleaned = F.replace(F.replace(line, F.lit('"'), F.lit("")), F.lit("\\"), F.lit(""))
    return F.regexp_replace(cleaned, r"(\d++),(\d++)", "$1.$2")


def split_cells(lines: DataFrame, header: Sequence[str], layout: TextLayout) -> DataFrame:
    """Cells of a frame of text lines in column ``value``; a line that is short of cells ends in NULLs."""
    kept = lines.filter(F.replace(F.col("value"), F.lit('"'), F.lit("")) != "")
    # One extraction per line, then the cells by position.
    cells = kept.select(F.regexp_extract_all(clean_line(F.col("value")), F.lit(layout.cell_pattern), F.lit(1))
                        .alias("cells"))
    return cells.select(*[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(header)])


def read_text(spark: SparkSession, paths: str | Sequence[str], layout: TextLayout) -> DataFrame:
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    header = layout.header
    if header is None:
        first = lines.first()
        if first is None:
            raise ValueError(f"no lines in {paths}, and the layout has no header")
        header = tuple(first["value"].split(","))
        lines = lines.filter(cell("value") != first["value"])
    return split_cells(lines, header, layout)


def read_batch(spark: SparkSession, paths: str | Sequence[str], file_format: str = "json",
               layout: TextLayout | None = None, columns: Sequence[str] | None = None,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """A batch in any supported form: ``json``, ``text`` with a layout, or a format Spark reads, with its reader's ``options``
    (for delimited text ``csv`` with ``header`` and ``sep``)."""
    if layout is not None or file_format == "text":
        if layout is None:
            raise ValueError("text batches need a layout")
        return read_text(spark, paths, layout)
    if file_format == "json":
        return read_json(spark, paths, columns)
    return spark.read.format(file_format).options(**(options or {})).load(paths if isinstance(paths, str) else list(paths))


def batch_name(paths: Sequence[str]) -> str:
    """Readable name of a batch from its files: first and last file name without ``.txt``. Several batches may share it."""
    names = [p.rstrip("/").rsplit("/", 1)[-1].removesuffix(".txt") for p in paths]
    if not names or not all(names):
        raise ValueError(f"cannot name a batch from {list(paths)}")
    return names[0] if len(names) == 1 else f"{names[0]}_{names[-1]}"


def batch_digest(paths: Sequence[str]) -> str:
    """Identity of a batch of files: a digest of all full paths, in any order."""
    full = sorted({p.rstrip("/") for p in paths})
    return hashlib.sha256("\n".join(full).encode()).hexdigest()[:DIGEST_DIGITS]
