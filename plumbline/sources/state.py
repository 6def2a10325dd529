"""The running state of a source, kept as tables below its result folder.

Every attempt at a batch writes directories of its own name and is recorded in the ledger last. Readers follow the ledger, so what
a failed or killed run left behind is never seen. The ledger's entries have numbers that one writer only can take: of two
writers that profile batches at once, the first to finish is recorded and the other one is told and has changed nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import cell, typed_name
from ..functions.times import DEFAULT_VOLATILITY_HOURS
from ..operators.consistency import RULES_SCHEMA
from ..operators.distinctness import DISTINCTNESS_SCHEMA
from ..operators.inference import ColumnTypes, dimension_columns
from ..operators.sketches import SKETCH_SCHEMA
from .buckets import BUCKETS, MERGE_AFTER, ValueBuckets
from .log import CHECKPOINT_EVERY, CommitLog, Files, NumberTaken
from .readers import CORRUPT, DIGEST_DIGITS

LEDGER_SCHEMA = "fileName string, correctAnalysis int, analysisTime string, version int, paths string, attempt string"
HOURLY_RATE_SCHEMA = "Hour int, Frequency double"
VALUE_RATE_SCHEMA = "Key string, Value string, Hour int, Frequency double"
METADATA_SCHEMA = ("header array<string>, volatility double, datatypes array<string>, timeFormats array<string>, "
                   "dimensionAttributeName map<string,array<string>>, timelinessNames array<string>, "
                   "consistencyRuleFiles array<string>, columnSchema string, typedColumns array<string>, distinctState string")


def read_or_none(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                 file_format: str = "json") -> DataFrame | None:
    """A table, or None where nothing has been written."""
    if not any(c in path for c in "*?[{") and not Files(spark).exists(path):
        return None
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class SourceMetadata:
    """What is fixed with the first batch: columns, their types and time formats, validity, binding lists."""

    types: ColumnTypes
    schema: T.StructType
    volatility_hours: float = DEFAULT_VOLATILITY_HOURS
    binding_paths: tuple[str, ...] = ()
    typed: tuple[str, ...] = ()         # text columns of numbers or times that are stored in their type as well
    distinct_state: str = "exact"       # what is kept of distinct values

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


class ConcurrentWriter(RuntimeError):
    """Another writer brought the source to a new version meanwhile."""


@dataclass(frozen=True)
class Head:
    """Where the ledger ends: its last entry, the version of the source, and the attempts that wrote this version and the first one."""

    number: int = 0
    version: int = 0
    attempt: str = ""
    first: str = ""


class SourceState:
    """Tables below ``root``; ``version`` is that of the last batch that was analysed correctly. An object is one attempt of a writer."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, merge_after: int = MERGE_AFTER, checkpoint_every: int = CHECKPOINT_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.attempt = uuid.uuid4().hex[:12]
        self.written: set[int | str] = set()
        self.known: dict[int, str] = {}
        self.log = CommitLog(spark, self.path("source_analysed_updates"), LEDGER_SCHEMA, checkpoint_every)
        self.values = ValueBuckets(spark, self.root, self.place, buckets, merge_after)

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    # Ledger

    def head(self) -> Head:
        """Read without a Spark job: every entry tells the version it leaves the source at."""
        number = self.log.head()
        if not number:
            return Head()
        entry = self.log.read(number)
        found = Head(number, entry["latest"], entry["latestAttempt"], entry["firstAttempt"])
        if found.version:
            self.known |= {1: found.first, found.version: found.attempt}
        return found

    def ledger(self) -> DataFrame:
        return self.log.entries()

    def _correct(self) -> DataFrame:
        return self.ledger().filter("correctAnalysis = 1")

    def correct_batches(self, requested: Sequence[str] | None = None) -> DataFrame:
        """Names of correctly analysed batches, of all or of the requested ones, and the attempts that wrote them."""
        names = self._correct().select(F.col("fileName").alias("batch"), "attempt")
        if requested is None:
            return names
        # Batches of other files with the same name carry a digest; the plain name asks for all of them.
        readable = F.regexp_replace("batch", f"-[0-9a-f]{{{DIGEST_DIGITS}}}$", "")
        return names.filter(F.col("batch").isin(list(requested)) | readable.isin(list(requested)))

    def progress(self, batch: str) -> tuple[int, bool]:
        """Version of the source, and whether a batch was analysed correctly before."""
        head = self.head()
        return head.version, bool(head.version) and not self._correct().filter(F.col("fileName") == batch).isEmpty()

    def place_of(self, name: str, digest: str) -> tuple[int, bool, str]:
        """Version of the source, whether the files with this digest of their paths were analysed correctly before, and the name of their
        batch: the plain one, unless batches of other files have it. A ledger without digests goes by names."""
        head = self.head()
        if not head.version:
            return 0, False, name
        own = (F.col("paths") == digest) | (F.col("paths").isNull() & (F.col("fileName") == name))
        other = (F.col("fileName") == name) & (F.col("paths") != digest)
        row = self._correct().agg(F.coalesce(F.max(own), F.lit(False)).alias("analysed"), F.coalesce(F.max(other), F.lit(False)).alias("taken")).head()
        return head.version, row["analysed"], f"{name}-{digest}" if row["taken"] else name

    def is_analysed(self, batch: str) -> bool:
        return self.progress(batch)[1]

    def version(self) -> int:
        return self.head().version

    def record(self, batch: str, correct: bool, analysis_time: str, version: int | None, paths: str | None = None) -> None:
        """Enter a batch in the ledger. A correct one makes ``version`` the source's; raises ``ConcurrentWriter`` if another writer has
        done so since the version before it was read."""
        while True:
            head = self.head()
            if correct and head.version != version - 1:
                raise ConcurrentWriter(f"batch {batch} was analysed on version {version - 1} of {self.root}, which another writer has brought to "
                                       f"version {head.version} meanwhile; analyse it again")
            latest, attempt, first = (version, self.attempt, head.first or self.attempt) if correct else (head.version, head.attempt, head.first)
            try:
                self.log.append(head.number + 1, {
                    "fileName": batch, "correctAnalysis": int(correct), "analysisTime": analysis_time, "version": version, "paths": paths,
                    "attempt": self.attempt, "latest": latest, "latestAttempt": attempt, "firstAttempt": first})
                return
            except NumberTaken:
                continue        # another entry came first; what it says decides

    # Tables of a version

    def place(self, version: int) -> str:
        """Folder of a version: of this attempt if it wrote it or is about to, else of the attempt that the ledger names."""
        if version in self.written or version > self.head().version:
            return f"version={version}-{self.attempt}"
        if version not in self.known:
            row = self._correct().filter(F.col("version") == version).select("attempt").head()
            self.known[version] = row["attempt"]
        return f"version={version}-{self.known[version]}"

    def write_version(self, df: DataFrame, table: str, version: int) -> str:
        self.written.add(version)
        path = self.path(table, self.place(version))
        df.write.mode("overwrite").parquet(path)
        return path

    def read_version(self, table: str, version: int, schema: str | T.StructType | None = None) -> DataFrame | None:
        return read_or_none(self.spark, self.path(table, self.place(version)), schema, "parquet")

    def source_quality(self, version: int) -> DataFrame | None:
        return self.read_version("source_quality", version)

    def source_distinctness(self, version: int) -> DataFrame:
        found = self.read_version("source_distinctness", version, DISTINCTNESS_SCHEMA) if version else None
        return found if found is not None else self.spark.createDataFrame([], DISTINCTNESS_SCHEMA)

    def source_sketches(self, version: int) -> DataFrame | None:
        """Sketches of the distinct values up to a version, of a source that keeps those instead of the values."""
        return self.read_version("source_distinct_sketches", version, SKETCH_SCHEMA) if version else None

    def distinct_values(self, version: int) -> DataFrame:
        """Distinct values up to a version: the directories that its list names."""
        return self.values.values(version)

    def write_values(self, added: DataFrame, version: int) -> None:
        """Store the values a version shows first."""
        self.written.add(version)
        self.values.add(added, version)

    def added_values(self, version: int) -> DataFrame:
        """Distinct values a version was the first to show, committed or not."""
        return self.values.added(version)

    # Extended rows

    def write_extended(self, df: DataFrame, batch: str) -> None:
        """Rows with their scores, in a folder of this attempt at the batch."""
        self.written.add(batch)
        (df.withColumns({"batch": F.lit(batch), "attempt": F.lit(self.attempt)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "attempt").parquet(self.path("extended_dataset")))

    def write_malformed(self, lines: DataFrame, batch: str) -> None:
        """Keep the lines of a batch that could not be read."""
        lines.write.mode("overwrite").parquet(self.path("malformed_lines", f"batch={batch}"))

    def malformed(self) -> DataFrame:
        """``batch, line`` of all lines that could not be read."""
        found = read_or_none(self.spark, self.path("malformed_lines"), "line string, batch string", "parquet")
        return found if found is not None else self.spark.createDataFrame([], "line string, batch string")

    def _extended(self, metadata: SourceMetadata, typed: bool = False) -> DataFrame:
        schema = self.extended_schema(metadata, typed).add("attempt", T.StringType())
        return self.spark.read.schema(schema).parquet(self.path("extended_dataset"))

    def extended(self, metadata: SourceMetadata, batches: DataFrame | None = None, typed: bool = False) -> DataFrame:
        """Profiled rows of the correctly analysed batches, with the typed companions of text columns if asked for. The names prune the
        partitions that are read."""
        names = self.correct_batches()
        if batches is not None:
            names = batches if "attempt" in batches.columns else names.join(batches, "batch", "left_semi")
        return self._extended(metadata, typed).join(names, ["batch", "attempt"], "left_semi") \
            .select(*[cell(f) for f in self.extended_schema(metadata, typed).fieldNames()])

    def extended_batch(self, metadata: SourceMetadata, batch: str) -> DataFrame:
        """Rows of one batch: those this attempt wrote, or those in the ledger."""
        names = F.col("attempt") == self.attempt
        if batch not in self.written:
            row = self._correct().filter(F.col("fileName") == batch).select("attempt").head()
            names = F.col("attempt") == (row["attempt"] if row else "")
        return self._extended(metadata).filter((F.col("batch") == batch) & names).drop("attempt")

    @staticmethod
    def extended_schema(metadata: SourceMetadata, typed: bool = False) -> T.StructType:
        schema = T.StructType(list(metadata.schema.fields))
        for name in metadata.typed if typed else ():
            schema = schema.add(typed_name(name), T.TimestampType() if metadata.types.is_time(name) else T.DoubleType())
        for name in extended_columns(metadata):
            schema = schema.add(name, T.DoubleType())
        return schema.add("batch", T.StringType())

    # Metadata

    def save_metadata(self, metadata: SourceMetadata, version: int) -> None:
        types = metadata.types
        row = (metadata.columns, float(metadata.volatility_hours),
               [types.kinds[c] for c in metadata.columns], [types.formats.get(c) for c in metadata.columns],
               dimension_columns(types), [f"TIMELINESS_{c}" for c in types.columns_for("Timeliness")],
               list(metadata.binding_paths), metadata.schema.json(), list(metadata.typed), metadata.distinct_state)
        self.written.add(version)
        self.spark.createDataFrame([row], METADATA_SCHEMA).write.mode("overwrite").json(self.path("preliminary_information", self.place(version)))

    def metadata(self, version: int | None = None) -> SourceMetadata | None:
        """Metadata of the first correct batch, None before there is one. ``version`` spares a look at the ledger."""
        if (self.version() if version is None else version) == 0:
            return None
        row = (self.spark.read.schema(METADATA_SCHEMA)
               .json(self.path("preliminary_information", self.place(1))).head())
        header, formats = row["header"], row["timeFormats"]
        types = ColumnTypes(dict(zip(header, row["datatypes"])), {c: f for c, f in zip(header, formats) if f})
        return SourceMetadata(types, T.StructType.fromJson(json.loads(row["columnSchema"])), row["volatility"],
                              tuple(row["consistencyRuleFiles"] or ()), tuple(row["typedColumns"] or ()), row["distinctState"] or "exact")

    # Tables the source's owner provides

    def hourly_rates(self, column: str) -> DataFrame | None:
        return read_or_none(self.spark, self.path(f"update_rate_global_{column}"), HOURLY_RATE_SCHEMA)

    def value_rates(self, column: str) -> DataFrame | None:
        return read_or_none(self.spark, self.path(f"update_rate_values_{column}"), VALUE_RATE_SCHEMA)

    def association_rules(self) -> DataFrame | None:
        return read_or_none(self.spark, self.path("association_rules"), RULES_SCHEMA)


def extended_columns(metadata: SourceMetadata) -> list[str]:
    """Score columns of the extended rows, in order."""
    names = ["COMPLETENESS_MISSING", *[f"TIMELINESS_{c}" for c in metadata.types.columns_for("Timeliness")]]
    return names + (["ASSOCIATION_CONSISTENCY"] if metadata.binding_paths else [])


def read_bindings(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """Lists of valid combinations, one JSON-lines table each. A list that cannot be read whole is an error: without it, or
    without some of its lines, every score would change."""
    tables = []
    for path in paths:
        found = read_or_none(spark, path)
        if found is None or not found.columns:
            raise ValueError(f"no valid combinations at {path}")
        if CORRUPT in found.columns:
            raise ValueError(f"{path} holds lines that are no JSON objects")
        tables.append(found)
    return tables


def write_table(df: DataFrame, folder: str, name: str, file_format: str = "parquet",
                mode: str = "errorifexists") -> str:
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode(mode).format(file_format).save(path)
    return path
