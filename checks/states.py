"""State of sources over several batches: distinct values in buckets, sketches of them, and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import ProfileSpec, profile_batch
from plumbline.operators.distinctness import distinct_values
from plumbline.operators.sketches import (distinctness_estimate, key_sketches, population_estimate, relative_error,
                                          sketch_counts, value_sketches)
from plumbline.sources.state import SourceState
from plumbline.spec import SKETCH

from .registry import query, r6, rounded, table, union, work_folder

CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
VALUES = ["event_type", "user", "props"]
SOURCE = "(SELECT event_type, CAST(user_id AS VARCHAR) AS \"user\", props FROM events)"


def _batches(spark, sf_dir):
    """The events in three parts of January, one after the other."""
    events = table(spark, sf_dir, "events")
    first, second = (F.lit(c).cast("timestamp_ntz") for c in CUTS)
    rows = events.select("event_type", F.col("user_id").cast("string").alias("user"), "props", "ts")
    return [rows.filter(c).drop("ts") for c in (F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second)]


def _state(spark, sf_dir) -> SourceState:
    """The three parts, with few buckets that are merged often."""
    state_folder = work_folder(spark)
    for version, batch in enumerate(_batches(spark, sf_dir), 1):
        state = SourceState(spark, state_folder, buckets=16, merge_after=1, checkpoint_every=2)
        state.write_values(state.values.unseen(distinct_values(batch, VALUES), version), version)
        state.record(f"part_{version}", True, CUTS[0], version)
    return SourceState(spark, state_folder)


@query("distinct_state_buckets", union([f"SELECT DISTINCT '{c}' AS attribute, \"{c}\" AS value FROM {SOURCE}" for c in VALUES]))
def values_in_buckets(spark, sf_dir):
    state = _state(spark, sf_dir)
    return state.distinct_values(state.version())


@query("ledger_checkpoint", """
SELECT 'part_' || i AS "fileName", CAST(i AS BIGINT) AS version, CAST(1 AS BIGINT) AS "correctAnalysis", count(*) > 0 AS filled FROM events, (SELECT unnest([1, 2, 3]) AS i) GROUP BY i""")
def ledger_of_three(spark, sf_dir):
    state = _state(spark, sf_dir)
    checkpoint, later = state.log.sources()
    assert checkpoint and len(later) == 1, (checkpoint, later)
    filled = [not state.distinct_values(v).isEmpty() for v in (1, 2, 3)]
    return rounded(state.ledger().select("fileName", "version", "correctAnalysis", F.element_at(F.array(*map(F.lit, filled)), F.col("version")).alias("filled")))


# Estimates are compared with the exact counts; the rows tell whether these lie within the stated bounds

@query("distinct_sketch_state", union([f"""
SELECT '{c}' AS attribute, count(DISTINCT "{c}") AS exact, count(*) AS "TotalRows", true AS within FROM {SOURCE}""" for c in VALUES]))
def sketches_of_three_batches(spark, sf_dir):
    spec = ProfileSpec(work_folder(spark), distinct_state=SKETCH)
    batches = _batches(spark, sf_dir)
    for i, batch in enumerate(batches):
        profile_batch(spark, batch, f"part_{i}", spec, CUTS[1])
    state = SourceState(spark, spec.result_folder)
    counts = sketch_counts(state.source_sketches(state.version()))
    rows = batches[0].unionByName(batches[1]).unionByName(batches[2])
    exact = distinct_values(rows, VALUES).groupBy("attribute").agg(F.count(F.lit(1)).alias("exact"))
    return counts.join(exact, "attribute").select("attribute", "exact", "TotalRows", F.col("exact").between(F.col("LowCount"), F.col("HighCount")).alias("within"))


KEYS = [["l_orderkey"], ["l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus"], ["l_shipdate"]]


@query("distinctness_estimate", union([f"""
SELECT '{"_".join(k)}' AS key_set, count(*) AS exact, true AS within, true AS share_within FROM (SELECT DISTINCT {", ".join(k)} FROM lineitem)""" for k in KEYS]))
def estimated_distinctness(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    found = distinctness_estimate(key_sketches(rows, KEYS, ["l_orderkey"]), 1.0)
    exact = union_of([rows.select(*k).distinct().agg(F.count(F.lit(1)).alias("exact")).select(F.lit("_".join(k)).alias("key_set"), "exact") for k in KEYS])
    share = F.col("exact") / F.lit(rows.count())
    return found.join(exact, "key_set").select("key_set", "exact", F.col("exact").between(F.col("DistinctLow"), F.col("DistinctHigh")).alias("within"),
                                               (F.abs(F.col("Distinctness") - share) <= share * relative_error()).alias("share_within"))


@query("population_estimate", union([f"""
SELECT '{c}' AS key_set, {r6(f'''count(DISTINCT CASE WHEN ts >= TIMESTAMP '{CUTS[1]}' THEN {c} END) / CAST(count(DISTINCT {c}) AS DOUBLE)''')} AS exact, true AS within
FROM events""" for c in ("event_type", "user_id", "props")]))
def estimated_population(spark, sf_dir):
    columns = ["event_type", "user_id", "props"]
    events = table(spark, sf_dir, "events")
    late = events.filter(F.col("ts") >= F.lit(CUTS[1]).cast("timestamp_ntz"))
    found = population_estimate(value_sketches(late, columns), value_sketches(events, columns), 1.0)
    counted = [f.agg(*[F.count_distinct(c).alias(c) for c in columns]).head() for f in (late, events)]
    exact = spark.createDataFrame([(c, counted[0][c] / counted[1][c]) for c in columns], "key_set string, exact double")
    # Either count may be off by its bound.
    error = 2 * relative_error() / (1 - relative_error())
    return rounded(found.join(exact, "key_set").select("key_set", "exact", (F.abs(F.col("CompletenessPopulationValue") - F.col("exact")) <= F.col("exact") * error).alias("within")))


def union_of(frames):
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged
