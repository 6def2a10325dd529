"""Assess the profiled rows of a source, or any frame, along the requested dimensions."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import cell, typed_name
from ..functions.times import DEFAULT_VOLATILITY_HOURS, instant
from ..operators.accuracy import Accuracy, Expected
from ..operators.completeness import Completeness
from ..operators.consistency import (applicable_bindings, consistency_attribute, consistency_value, rule_set,
                                     with_association)
from ..operators.distinctness import distinctness_attribute, distinctness_global, distinctness_in_two_steps, population_attribute
from ..operators.frequency import frequency_attribute, frequency_global, frequency_hour, frequency_value
from ..operators.inference import ColumnTypes
from ..operators.precision import Precision
from ..operators.selection import drop_incomplete, sample_rows, select_rows
from ..operators.timeliness import Timeliness, Validity, timeliness_row
from ..operators.volume import volume_global, volume_value
from ..sources.state import SourceState, read_bindings, write_table
from ..spec import ATTRIBUTE, GLOBAL, TUPLE, VALUE, AssessmentSpec
from .combine import named, side_by_side
from .staging import stage, staging_folder
from .summary import summarise, whole

log = logging.getLogger(__name__)

CONCURRENT_WRITES = 4
SUMMARISED = ("Volume", "Completeness_Missing", "Accuracy", "Precision", "Timeliness", "Distinctness",
              "Completeness_Population")


@dataclass(frozen=True)
class Reference:
    """What the source knows beyond its rows; every part is optional."""

    hourly_rates: Mapping[str, DataFrame] = field(default_factory=dict)
    value_rates: Mapping[str, DataFrame] = field(default_factory=dict)
    rules: DataFrame | None = None
    distinctness: DataFrame | None = None
    volatility_hours: float = DEFAULT_VOLATILITY_HOURS


def assess_frame(source: DataFrame, types: ColumnTypes, spec: AssessmentSpec, as_of: dt.datetime | str,
                 staging: str, reference: Reference = Reference(),
                 errors: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The metric tables of an assessment by name, except the rescored rows.

    One scan of the selected rows gives a staged summary that holds the groups of all key sets and the whole
    table; volume, completeness, accuracy, precision, timeliness, distinct keys and population are projections
    of it at every level. Whole-row distinctness, rules and frequency are one scan each, if asked for.

    With ``errors`` a dimension of the summary, or another part, that fails is noted there under its name and the others go on;
    otherwise it raises.
    """
    now = instant(as_of)
    selected = select_rows(source, spec.columns, spec.ranges, spec.values, types)
    if spec.sample < 1:
        # Written once, so that every scan below sees the same sample.
        selected = stage(sample_rows(selected, spec.sample, spec.seed), staging, "sample")

    plan = _Plan(spec, types, reference, now, source, selected, staging, errors)
    tables: dict[str, DataFrame] = {}
    global_frames: list[DataFrame] = []
    parts = {"summary": plan.summary_part, "consistency": plan.consistency_part, "frequency": plan.frequency_part,
             "distinctness": plan.distinctness_part}
    with ThreadPoolExecutor(len(parts)) as pool:
        running = {name: pool.submit(part) for name, part in parts.items()}
    for name, part in running.items():
        error = part.exception()
        if error is None:
            part_tables, part_globals = part.result()
            tables |= part_tables
            global_frames += part_globals
        elif errors is None:
            raise error
        else:
            log.error("%s failed", name, exc_info=error)
            errors[name] = str(error)
    tables["final_quality"] = _final_quality(global_frames, spec.sample, source.sparkSession)
    return tables


Part = tuple[dict[str, DataFrame], list[DataFrame]]         # tables by name, and one-row frames of global metrics


def _final_quality(frames: Sequence[DataFrame], confidence: float, spark: SparkSession) -> DataFrame:
    """All whole-table metrics as one row. They come from the same rows, so their mean confidence is that of each."""
    row = side_by_side(frames) if frames else spark.range(1).select()
    return row.withColumn("Confidence", F.lit(float(confidence)))


class _Plan:
    """The tables of one assessment over its selected rows."""

    def __init__(self, spec: AssessmentSpec, types: ColumnTypes, reference: Reference, now: Column, source: DataFrame,
                 selected: DataFrame, staging: str, errors: dict[str, str] | None = None):
        self.types, self.reference, self.staging = types, reference, staging
        self.selected = selected
        self.filled = drop_incomplete(selected, spec.columns)
        # Grouping by a time is of no use; attribute completeness alone takes such keys.
        self.key_sets = [k for k in spec.key_sets if not any(types.is_time(c) for c in k)]
        columns = lambda dimension: [c for c in types.columns_for(dimension) if c in spec.columns]      # noqa: E731
        self.validities = validities_of(spec, types, reference.volatility_hours)
        build = {
            "Volume": lambda: source.count(),
            "Completeness_Missing": lambda: Completeness(spec.columns),
            "Accuracy": lambda: Accuracy([Expected(c, *spec.expected[c]) for c in columns("Accuracy") if c in spec.expected]),
            "Precision": lambda: Precision(columns("Precision")),
            "Timeliness": lambda: Timeliness(self.validities, now),
        }
        # A dimension that cannot be built is left out, so that the others still share their scan.
        built: dict[str, object] = {}
        together = self._fit(build, spec.dimensions)
        for dimension in [d for d in build if d in spec.dimensions]:
            try:
                built[dimension] = together[dimension] if dimension in together else build[dimension]()
                if dimension not in together:
                    self._checked([built[dimension]])
            except Exception as error:      # noqa: BLE001 - reported, the other dimensions go on
                if errors is None:
                    raise
                log.error("%s failed", dimension, exc_info=error)
                errors[dimension] = str(error)
                spec = replace(spec, dimensions={d: g for d, g in spec.dimensions.items() if d != dimension})
        self.spec = spec
        self.total = built.get("Volume", 0)
        self.completeness = built.get("Completeness_Missing") or Completeness(spec.columns)
        self.accuracy = built.get("Accuracy") or Accuracy([])
        self.precision = built.get("Precision") or Precision([])
        self.timeliness = built.get("Timeliness") or Timeliness([], now)

    def _checked(self, measures) -> None:
        """Analyses the columns and aggregates of measures over the rows; those that do not fit raise."""
        measures = [m for m in measures if not isinstance(m, int)]
        columns = {n: c for m in measures for n, c in m.row_columns(self.selected, F.lit(True)).items()}
        self.selected.select(*named(columns)).agg(F.count(F.lit(1)), *[a for m in measures for a in m.aggregates()]).schema

    def _fit(self, build, dimensions) -> dict[str, object]:
        """All measures, analysed at once. None if one of them fails, which a look at each by itself then tells."""
        try:
            built = {d: build[d]() for d in build if d in dimensions}
            self._checked(built.values())
            return built
        except Exception:       # noqa: BLE001 - raised again, or reported, for the dimension at fault
            return {}

    def summary_part(self) -> Part:
        if not any(d in self.spec.dimensions for d in SUMMARISED):
            return {}, []
        summary = stage(self.summary(), self.staging, "summary")
        if whole(summary).isEmpty():
            # No row was selected. Grouping sets leave out even the whole table then, a plain aggregate does not.
            summary = stage(self.summary(keyed=False), self.staging, "empty_summary")
        metrics = self.summary_globals()
        return self.summary_tables(summary), [whole(summary).select(*named(metrics))] if metrics else []

    def summary(self, keyed: bool = True) -> DataFrame:
        spec = self.spec
        measures = [m for d, m in (("Accuracy", self.accuracy), ("Precision", self.precision),
                                   ("Timeliness", self.timeliness)) if d in spec.dimensions]
        per_key = keyed and any(spec.asks(d, ATTRIBUTE, VALUE) for d in SUMMARISED)
        key_sets = self.key_sets if per_key else []
        if "Completeness_Missing" in spec.dimensions:
            # Rows with a missing cell count for completeness only: they stay, and the measures skip them.
            return summarise(self.selected, [self.completeness, *measures], key_sets, whole_table=True,
                             scope=spec.columns)
        return summarise(self.filled, measures, key_sets, whole_table=True)

    def summary_globals(self) -> dict[str, Column]:
        metrics: dict[str, Column] = {}
        for dimension, build in (("Volume", lambda: volume_global(self.total)),
                                 ("Completeness_Missing", self.completeness.global_metrics),
                                 ("Accuracy", self.accuracy.global_metrics),
                                 ("Precision", self.precision.global_metrics),
                                 ("Timeliness", self.timeliness.global_metrics)):
            if self.spec.asks(dimension, GLOBAL):
                metrics |= build()
        return metrics

    def summary_tables(self, summary: DataFrame) -> dict[str, DataFrame]:
        spec, keys, sample = self.spec, self.key_sets, self.spec.sample
        tables: dict[str, DataFrame] = {}
        if spec.asks("Completeness_Missing", ATTRIBUTE) and spec.key_sets:
            tables["completeness_missing_attributes"] = self.completeness.attribute_table(summary, spec.key_sets, sample)
        if not keys:
            return tables
        if spec.asks("Completeness_Missing", VALUE):
            tables["completeness_missing_values"] = self.completeness.value_table(summary, keys)
        if spec.asks("Volume", VALUE):
            tables["volume_values"] = volume_value(summary, self.total)
        if self.accuracy.expected:
            if spec.asks("Accuracy", VALUE):
                tables["accuracy_values"] = self.accuracy.value_table(summary, keys)
            if spec.asks("Accuracy", ATTRIBUTE):
                tables["accuracy_attributes"] = self.accuracy.attribute_table(summary, keys, sample)
        if self.precision.columns:
            if spec.asks("Precision", VALUE):
                tables["precision_values"] = self.precision.value_table(summary, keys, whole(summary))
            if spec.asks("Precision", ATTRIBUTE):
                tables["precision_attributes"] = self.precision.attribute_table(summary, keys, whole(summary), sample)
        if self.validities:
            if spec.asks("Timeliness", VALUE):
                tables["timeliness_values"] = self.timeliness.value_table(summary, keys)
            if spec.asks("Timeliness", ATTRIBUTE):
                tables["timeliness_attributes"] = self.timeliness.attribute_table(summary, keys, sample)
        if spec.asks("Distinctness", ATTRIBUTE):
            tables["distinctness_attributes"] = distinctness_attribute(summary, keys, sample)
        if spec.asks("Completeness_Population", ATTRIBUTE) and self.reference.distinctness is not None:
            tables["completeness_population_attributes"] = population_attribute(
                summary, keys, self.reference.distinctness, sample)
        return tables

    def distinctness_part(self) -> Part:
        spec = self.spec
        if not spec.asks("Distinctness", GLOBAL):
            return {}, []
        if spec.hash_rows:
            return {}, [distinctness_in_two_steps(self.filled, spec.columns, self.staging)]
        return {}, [distinctness_global(self.filled, spec.columns, spec.digest_rows)]

    def consistency_part(self) -> Part:
        spec = self.spec
        rules = rule_set(self.reference.rules, spec.extra_rules, spec.columns) if spec.asks(
            "Consistency", ATTRIBUTE, VALUE) else []
        if not rules:
            return {}, []
        values = stage(consistency_value(self.filled, rules), self.staging, "consistency")
        tables = {}
        if spec.asks("Consistency", VALUE):
            tables["consistency_values"] = values.select("AntecedentValue", "Rule", "ConsistencyValue")
        if spec.asks("Consistency", ATTRIBUTE):
            tables["consistency_attributes_mean_per_rule"] = consistency_attribute(values, spec.sample)
        return tables, []

    def frequency_part(self) -> Part:
        spec, sample = self.spec, self.spec.sample
        hours, values, global_frames = [], [], []
        for v in self.validities:
            hourly = self.reference.hourly_rates.get(v.column)
            if hourly is not None and spec.asks("Completeness_Frequency", GLOBAL):
                table = stage(frequency_hour(self.filled, v.column, hourly, v.time_format, sample), self.staging,
                              f"hours_{len(hours)}")
                hours.append(table.select(F.lit(v.column).alias("attribute"), *table.columns))
                global_frames.append(frequency_global(table, v.column))
            by_value = self.reference.value_rates.get(v.column)
            keys = [k for k in self.key_sets if v.column not in k]
            if by_value is not None and keys and spec.asks("Completeness_Frequency", ATTRIBUTE, VALUE):
                values.append(stage(frequency_value(self.filled, v.column, keys, by_value, v.time_format, sample),
                                    self.staging, f"frequency_{len(values)}"))
        tables = {}
        if hours:
            tables["completeness_frequency_global_hour"] = reduce(DataFrame.unionByName, hours)
        if values:
            merged = reduce(DataFrame.unionByName, values)
            if spec.asks("Completeness_Frequency", VALUE):
                tables["completeness_frequency_values"] = merged
            if spec.asks("Completeness_Frequency", ATTRIBUTE):
                tables["completeness_frequency_attributes"] = frequency_attribute(merged, sample)
        return tables, global_frames


def validities_of(spec: AssessmentSpec, types: ColumnTypes, default_hours: float) -> list[Validity]:
    return [Validity(c, types.formats.get(c), spec.volatility_hours.get(c, default_hours))
            for c in types.columns_for("Timeliness") if c in spec.columns]


def rescore_rows(rows: DataFrame, types: ColumnTypes, spec: AssessmentSpec, as_of: dt.datetime | str,
                 bindings: Sequence[DataFrame] = (), known_bindings: Sequence[str] = (),
                 default_hours: float = DEFAULT_VOLATILITY_HOURS) -> DataFrame:
    """All rows of the source with the row scores brought up to date.

    Timeliness is computed again for the selected time columns. The association score is computed again if the
    binding lists are others than the source's own or a refresh is asked for, by the lists whose columns are all
    selected. Other scores stay as profiling left them.
    """
    if spec.asks("Timeliness", TUPLE):
        now = instant(as_of)
        rows = rows.withColumns({f"TIMELINESS_{v.column}": timeliness_row(rows, v, now)
                                 for v in validities_of(spec, types, default_hours)})
    changed = set(spec.binding_paths) != set(known_bindings)
    if spec.asks("Consistency", TUPLE) and (changed or spec.refresh_association):
        rows = with_association(rows, applicable_bindings(bindings, spec.columns))
    return rows


@dataclass
class AssessmentResult:
    """Paths of the tables written, and the error of each table that could not be."""

    folder: str
    tables: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def output_folder(spec: AssessmentSpec, as_of: dt.datetime | str) -> str:
    if not spec.output_folder:
        raise ValueError("the assessment has no output folder")
    time = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(as_of)
    return f"{spec.output_folder}_{time.strftime('%Y%m%d-%H%M%S')}_confidence_{spec.sample}"


def assess(spark: SparkSession, spec: AssessmentSpec, as_of: dt.datetime | str) -> AssessmentResult:
    """Run an assessment on a profiled source and write its tables. One failing table does not stop the others."""
    if not spec.source_folder:
        raise ValueError("the assessment has no source folder")
    state, result = SourceState(spark, spec.source_folder), AssessmentResult(output_folder(spec, as_of))
    metadata = state.metadata()
    if metadata is None:
        raise ValueError(f"{spec.source_folder} holds no correctly analysed batch")
    version = state.version()
    if spec.source_summary:
        _write(result, "source_quality", state.source_quality(version), spec.file_format)
        return result

    missing = set(spec.columns) - set(metadata.columns)
    if missing:
        raise ValueError(f"columns the source does not have: {sorted(missing)}")
    types = metadata.types
    times = [c for c in types.columns_for("Timeliness") if c in spec.columns]
    reference = Reference(
        hourly_rates={c: r for c in times if (r := state.hourly_rates(c)) is not None},
        value_rates={c: r for c in times if (r := state.value_rates(c)) is not None},
        rules=state.association_rules(), distinctness=state.source_distinctness(version),
        volatility_hours=metadata.volatility_hours)
    batches = state.correct_batches(spec.batches)
    extended = state.extended(metadata, batches)
    staging = staging_folder(spark, result.folder + "/_staging")
    # Ranges and value lists on text columns compare the stored numbers and times, which the scan can skip by.
    typed = [typed_name(c) for c in spec.columns if (spec.ranges.get(c) or spec.values.get(c)) and c in metadata.typed]
    source = state.extended(metadata, batches, bool(typed)).select(*[cell(c) for c in (*spec.columns, *typed)])
    tables = assess_frame(source, types, spec, as_of, staging, reference, result.errors)
    if any(spec.asks(d, TUPLE) for d in spec.dimensions):
        try:
            tables["extended_dataset"] = rescore_rows(extended, types, spec, as_of, read_bindings(spark, spec.binding_paths),
                                                      metadata.binding_paths, metadata.volatility_hours)
        except Exception as error:      # noqa: BLE001 - reported with the result, the other tables go on
            log.exception("the rows could not be scored")
            result.errors["extended_dataset"] = str(error)
    # Most tables are small: a few jobs at a time keep the executors busy.
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        list(pool.map(lambda item: _write(result, *item, spec.file_format), tables.items()))
    return result


def _write(result: AssessmentResult, name: str, table: DataFrame, file_format: str) -> None:
    try:
        result.tables[name] = write_table(table, result.folder, name, file_format)
    except Exception as error:      # noqa: BLE001 - reported with the result, the other tables go on
        log.exception("table %s failed", name)
        result.errors[name] = str(error)
