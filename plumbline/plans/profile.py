"""Profile a batch of a source and bring the source's quality up to date."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import cell, is_text, number, typed_name
from ..functions.scores import ratio
from ..functions.times import instant, timestamp
from ..operators.completeness import Completeness, completeness_row
from ..operators.consistency import Rule, consistency_attribute, consistency_value, rule_set, with_association
from ..operators.distinctness import distinct_values, distinctness_totals
from ..operators.frequency import frequency_global, frequency_hour
from ..operators.inference import ColumnTypes, infer_types
from ..operators.precision import Precision
from ..operators.sketches import merged_sketches, sketch_counts, value_sketches
from ..operators.timeliness import RowTimeliness, Validity, timeliness_row
from ..sources.readers import batch_digest, batch_name, parse_batch
from ..sources.state import SourceMetadata, SourceState, read_bindings
from ..spec import SKETCH, ProfileSpec
from .combine import local, named, side_by_side
from .merge import (ROWS, MergeRule, distinctness_rules, merge_quality, precision_rules, timeliness_rules, weighted)
from .staging import staging_folder
from .summary import summarise, whole

log = logging.getLogger(__name__)


def validities(types: ColumnTypes, volatility_hours: float) -> list[Validity]:
    return [Validity(c, types.formats.get(c), volatility_hours) for c in types.columns_for("Timeliness")]


def extend_rows(df: DataFrame, types: ColumnTypes, volatility_hours: float, as_of: Column,
                bindings: Sequence[DataFrame] = ()) -> DataFrame:
    """The rows with their scores; built-in expressions and, for binding lists, a look-up."""
    scores = {"COMPLETENESS_MISSING": completeness_row(df, df.columns)}
    for v in validities(types, volatility_hours):
        scores[f"TIMELINESS_{v.column}"] = timeliness_row(df, v, as_of)
    return with_association(df.withColumns(scores), bindings)


def batch_metrics(df: DataFrame, types: ColumnTypes, volatility_hours: float, as_of: Column,
                  hourly_rates: Mapping[str, DataFrame] | None = None, rules: Sequence[Rule] = (),
                  digits_only: bool = False, source: str = "source") -> tuple[DataFrame, dict[str, MergeRule]]:
    """All whole-batch metrics but distinctness as one row, and how each merges into the source's.

    Completeness, volume, precision and timeliness share one scan; frequency and rules aggregate on their own.
    """
    columns = list(types.kinds)
    completeness = Completeness(columns)
    precision = Precision(types.columns_for("Precision"), digits_only)
    timeliness = RowTimeliness(validities(types, volatility_hours), as_of)
    summary = summarise(df, [completeness, precision, timeliness], whole_table=True)
    metrics = {ROWS: F.col("rows"), **completeness.global_metrics(), **precision.profile_metrics(),
               **timeliness.profile_metrics()}
    merge: dict[str, MergeRule] = {"Completeness_Missing": weighted, **precision_rules(precision.columns),
                                   **timeliness_rules(types.columns_for("Timeliness"), volatility_hours)}
    frames = [whole(summary).select(F.lit(source).alias("source"), *named(metrics))]

    for column, rates in (hourly_rates or {}).items():
        hours = frequency_hour(df, column, rates, types.formats.get(column), per_day=False)
        frames.append(frequency_global(hours, column).withColumn("source", F.lit(source)))
        merge[f"Completeness_Frequency_{column}"] = weighted
    if rules:
        per_rule = consistency_attribute(consistency_value(df, rules))
        frames.append(per_rule.agg(*[
            F.max(F.when((F.col("RuleAntecedent") == r.left) & (F.col("RuleConsequent") == r.right),
                         F.col("ConsistencyValue"))).alias(f"Consistency_{r.left}_{r.right}")
            for r in rules]).withColumn("source", F.lit(source)))
        merge |= {f"Consistency_{r.left}_{r.right}": weighted for r in rules}
    return side_by_side(frames, "source"), merge


def distinctness_metrics(update: DataFrame, columns: Sequence[str], source: str = "source") -> DataFrame:
    """The per-column distinctness state as metrics of one row."""
    return update.agg(*[F.max(F.when(F.col("Attribute") == c, F.col(value))).alias(f"{metric}_{c}")
                        for c in columns
                        for metric, value in (("Distinctness", "DistinctnessValue"), ("Distinct_Number", "Count"))]
                      ).withColumn("source", F.lit(source))


def profile_batch(spark: SparkSession, batch: DataFrame, name: str, spec: ProfileSpec,
                  as_of: dt.datetime | str, paths: str | None = None) -> bool:
    """Profile one batch. False if the ledger says it was analysed before; a failure is recorded and raised. ``paths`` is the digest of
    a batch of files."""
    state = SourceState(spark, spec.result_folder)
    version, analysed = state.progress(name)
    if analysed:
        log.info("batch %s was analysed before", name)
        return False
    version += 1
    try:
        _profile(state, batch, name, spec, as_of, version)
    except Exception:
        state.record(name, False, str(as_of), None, paths)
        raise
    state.record(name, True, str(as_of), version, paths)
    return True


def _profile(state: SourceState, batch: DataFrame, name: str, spec: ProfileSpec, as_of: dt.datetime | str,
             version: int) -> None:
    spark, now = state.spark, instant(as_of)
    metadata = state.metadata(version - 1)
    if metadata is None:
        found = infer_types(batch, spec.all_time_formats)
        metadata = SourceMetadata(found, batch.schema, spec.volatility_hours, tuple(spec.binding_paths), tuple(
            f.name for f in batch.schema.fields if is_text(f.dataType) and (found.is_time(f.name) or f.name in found.columns_for("Precision"))),
            spec.distinct_state)
        state.save_metadata(metadata, version)
    types, volatility = metadata.types, metadata.volatility_hours
    bindings = read_bindings(spark, metadata.binding_paths)

    # The scored rows are written first: everything else reads their columns instead of the raw batch.
    own = batch.select(*[cell(f.name).cast(f.dataType).alias(f.name) for f in metadata.schema.fields])
    scored = extend_rows(own, types, volatility, now, bindings)
    state.write_extended(scored.withColumns({
        typed_name(c): timestamp(own, c, types.formats.get(c)) if types.is_time(c) else number(own, c) for c in metadata.typed}), name)
    rows = state.extended_batch(metadata, name).select(*map(cell, metadata.columns))

    rates = {c: r for c in types.columns_for("Timeliness") if (r := state.hourly_rates(c)) is not None}
    rules = rule_set(state.association_rules(), (), metadata.columns)
    metrics, merge = batch_metrics(rows, types, volatility, now, rates, rules, spec.digits_only)
    metrics = local(metrics)        # one row; all that follows is as small

    distinct_columns = types.columns_for("Distinctness")
    if distinct_columns:
        update = local(_distinctness(state, rows, metrics, distinct_columns, metadata.distinct_state, spec.sketch_lg_k, version))
        state.write_version(update, "source_distinctness", version)
        metrics = local(side_by_side([metrics, distinctness_metrics(update, distinct_columns)], "source"))
        merge |= distinctness_rules(distinct_columns)

    stored = state.source_quality(version - 1) if version > 1 else None
    state.write_version(merge_quality(stored, metrics, merge, now), "source_quality", version)


def _distinctness(state: SourceState, rows: DataFrame, metrics: DataFrame, columns: Sequence[str], kept: str, lg_k: int, version: int) -> DataFrame:
    """Distinctness of the source after the batch, whose values or sketches are stored."""
    if kept == SKETCH:
        before, now = state.source_sketches(version - 1), value_sketches(rows, columns, lg_k)
        state.write_version(now if before is None else merged_sketches(before, now), "source_distinct_sketches", version)
        counts = sketch_counts(state.source_sketches(version), lg_k)
        return counts.select(F.col("attribute").alias("Attribute"), "Count", "TotalRows", ratio(F.col("Count"), F.col("TotalRows")).alias("DistinctnessValue"))
    added = state.values.unseen(distinct_values(rows, columns), version)
    state.write_values(added, version)
    fresh = local(state.added_values(version).groupBy("attribute").agg(F.count(F.lit(1)).alias("Count")))
    return distinctness_totals(metrics.select(F.col(ROWS).alias("rows")), columns, fresh, state.source_distinctness(version - 1))


def profile_files(spark: SparkSession, paths: Sequence[str], spec: ProfileSpec, as_of: dt.datetime | str) -> bool:
    """Profile the batch that a list of files makes up."""
    if not paths:
        raise ValueError("no input files")
    digest, state = batch_digest(paths), SourceState(spark, spec.result_folder)
    version, analysed, name = state.place_of(batch_name(paths), digest)
    if analysed:
        return False
    metadata = state.metadata(version)
    batch = parse_batch(spark, paths, staging_folder(spark, state.path("staging")), spec.file_format, spec.layout,
                        metadata.columns if metadata else spec.columns, spec.options)
    if batch.n_malformed:
        state.write_malformed(batch.malformed, name)
        log.warning("batch %s: %d lines are no JSON objects, kept in malformed_lines", name, batch.n_malformed)
    return profile_batch(spark, batch.rows, name, spec, as_of, digest)
