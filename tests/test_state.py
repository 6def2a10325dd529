"""The state of a source under several writers and many versions: ledger, buckets of distinct values, sketches."""

import threading

import pytest
from pyspark.sql import functions as F

from plumbline import ProfileSpec, SourceState, profile_batch
from plumbline.operators.sketches import (distinctness_estimate, key_sketches, merged_sketches, population_estimate, relative_error,
                                          sketch_counts, value_sketches)
from plumbline.sources.log import CommitLog, NumberTaken
from plumbline.sources.state import ConcurrentWriter

VALUES = "attribute string, value string"
AS_OF = "2024-01-01 00:00:00"


def pairs(df):
    return sorted((r["attribute"], r["value"]) for r in df.collect())


def test_one_of_many_racing_writers_takes_a_number(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "who int")
    won, told = [], []

    def write(who):
        try:
            log.append(1, {"who": who})
            won.append(who)
        except NumberTaken:
            told.append(who)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(told) == 11 and log.head() == 1 and log.read(1) == {"who": won[0]}
    assert log.files.names(log.folder + "/entries") == ["000000000001.json"]


def test_a_reader_opens_a_checkpoint_and_few_entries(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "who int", checkpoint_every=4)
    for i in range(1, 12):
        log.append(i, {"who": i})
        checkpoint, later = log.sources()
        assert len(later) < 4 and (checkpoint is None) == (i < 4)
        assert sorted(r["who"] for r in log.entries().collect()) == list(range(1, i + 1))
    # A checkpoint that was not finished is not taken.
    (tmp_path / "log" / "checkpoints" / "000000000008" / "_SUCCESS").unlink()
    assert log.sources()[0].endswith("04") and log.head() == 11 and log.entries().count() == 11


def test_second_of_two_writers_is_told_and_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "s")
    batch = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    assert profile_batch(spark, batch, "one", ProfileSpec(folder), AS_OF)
    slow = SourceState(spark, folder)
    assert slow.progress("two") == (1, False)
    # What the slow writer writes for version 2, before and after the fast one is recorded.
    slow.write_version(spark.createDataFrame([("x",)], "source string"), "source_quality", 2)
    slow.write_values(spark.createDataFrame([("k", "slow")], VALUES), 2)
    assert profile_batch(spark, batch, "fast", ProfileSpec(folder), AS_OF)
    slow.write_extended(batch.select("k", "v", F.lit(0.5).alias("COMPLETENESS_MISSING")), "fast")
    with pytest.raises(ConcurrentWriter, match="version 2 meanwhile"):
        slow.record("two", True, AS_OF, 2)
    state = SourceState(spark, folder)
    assert state.version() == 2 and sorted(r["batch"] for r in state.correct_batches().collect()) == ["fast", "one"]
    assert state.source_quality(2).head()["UpdatesCount"] == 2
    assert ("k", "slow") not in pairs(state.distinct_values(2))
    assert state.extended(state.metadata()).count() == 4 and state.extended(state.metadata()).agg(F.min("COMPLETENESS_MISSING")).head()[0] == 1.0
    # A failure that another writer records in between is no new version.
    again = SourceState(spark, folder)
    SourceState(spark, folder).record("broken", False, AS_OF, None)
    again.record("three", True, AS_OF, 3)
    assert SourceState(spark, folder).version() == 3 and state.ledger().count() == 4


def test_a_version_rewrites_and_lists_only_what_it_needs(spark, tmp_path):
    def state():
        return SourceState(spark, str(tmp_path), buckets=8, merge_after=2)

    expected, folders = [], []
    for version in range(1, 8):
        own = state()
        rows = [("a", str(i)) for i in range(version * 10)] + [("b", f"only {version}")]
        added = own.values.unseen(spark.createDataFrame(rows, VALUES), version)
        own.write_values(added, version)
        before = own.values.manifest(version - 1)
        own.record(f"batch {version}", True, AS_OF, version)
        expected = sorted(set(expected) | set(rows))
        reader = state()
        assert pairs(reader.distinct_values(version)) == expected
        now = reader.values.manifest(version)
        touched = {b for b in now if any(f"version={version}-" in f for f in now[b])}
        assert all(now[b] == before[b] for b in now if b not in touched)
        assert all(len(f) <= 2 for f in now.values())
        # The plan opens the directories of the list and no others.
        opened = {p.rsplit("/", 1)[0].removeprefix(f"file://{tmp_path}/") for p in reader.distinct_values(version).inputFiles()}
        assert opened == {f for fs in now.values() for f in fs}
        folders.append(sum(map(len, now.values())))
    assert max(folders) <= 16
    for version in range(1, 8):         # older versions stay readable
        assert ("b", f"only {version}") in pairs(state().distinct_values(version)) and ("b", f"only {version + 1}") not in pairs(state().distinct_values(version))


def test_a_batch_meets_only_its_buckets(spark, tmp_path):
    own = SourceState(spark, str(tmp_path), buckets=32)
    own.write_values(spark.createDataFrame([("a", str(i)) for i in range(500)], VALUES), 1)
    own.record("one", True, AS_OF, 1)
    later = SourceState(spark, str(tmp_path), buckets=4)        # the source's own number of buckets holds
    few = later.values.unseen(spark.createDataFrame([("a", "7"), ("a", "new"), (None, "x")], VALUES), 2)
    opened = {p for p in few.inputFiles() if "source_distinct_values" in p}
    assert 1 <= len(opened) <= 3 and later.values.buckets == 32
    assert [r["value"] for r in few.collect() if r["attribute"]] == ["new"]


def test_values_of_many_batches_through_the_job(spark, tmp_path):
    spec = ProfileSpec(str(tmp_path / "s"))
    for i in range(3):
        profile_batch(spark, spark.createDataFrame([(f"k{j}", float(j % 3)) for j in range(i * 2, i * 2 + 4)], "k string, v double"), f"b{i}", spec, AS_OF)
    state = SourceState(spark, spec.result_folder)
    assert pairs(state.distinct_values(3)) == sorted([("k", f"k{j}") for j in range(8)] + [("v", f"{j}.0") for j in range(3)])
    quality = state.source_quality(3).head()
    assert quality["Distinct_Number_k"] == 8 and quality["Distinctness_k"] == pytest.approx(8 / 12)


# Sketches

def test_estimates_lie_within_their_bounds(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_011).cast("string").alias("many"), (F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none"))
    counts = {r["attribute"]: r for r in sketch_counts(value_sketches(rows, ["many", "few", "none"])).collect()}
    assert counts["few"]["Count"] == 7 and counts["none"]["Count"] == 1 and counts["many"]["TotalRows"] == 60_000
    assert counts["many"]["LowCount"] <= 20_011 <= counts["many"]["HighCount"]
    assert counts["many"]["HighCount"] - counts["many"]["LowCount"] <= 2.01 * relative_error() * counts["many"]["Count"] + 2
    fine = sketch_counts(value_sketches(rows, ["many"], 16), 16).head()
    assert fine["LowCount"] <= 20_011 <= fine["HighCount"] and relative_error(16) < relative_error() / 3


def test_merged_sketches_are_those_of_all_rows(spark):
    rows = spark.range(30_000).select((F.col("id") * 7 % 10_007).cast("string").alias("k"))
    parts = [value_sketches(rows.filter(F.col("k") % 3 == i), ["k"]) for i in range(3)]
    merged = sketch_counts(merged_sketches(*parts)).head()
    assert merged["TotalRows"] == 30_000 and merged["LowCount"] <= 10_007 <= merged["HighCount"]
    again = sketch_counts(merged_sketches(*parts, parts[0])).head()
    assert again["Count"] == merged["Count"]


def test_estimates_of_keys_and_population(spark):
    rows = spark.createDataFrame([("a", "b,c", 1), ("a,b", "c", 1), (None, "c", 2), ("null", "c", None)], "x string, y string, n int")
    found = {r["key_set"]: r.asDict() for r in distinctness_estimate(key_sketches(rows, [["x", "y"], ["x"], ["n"]]), 0.5).collect()}
    assert found["x_y"]["DistinctCount"] == 3 and found["x"]["DistinctCount"] == 3 and found["x_y"]["Confidence"] == 0.5
    assert found["n"]["DistinctCount"] == 3 and found["x"]["Distinctness"] == 0.75
    assert distinctness_estimate(key_sketches(rows, [["x"]], ["n"]), 1.0).head()["DistinctCount"] == 3
    share = population_estimate(value_sketches(rows.filter("n = 1"), ["x"]), value_sketches(rows, ["x"]), 1.0).head()
    assert share["CompletenessPopulationValue"] == pytest.approx(2 / 3)
    assert distinctness_estimate(key_sketches(rows.limit(0), [["x"]]), 1.0).head()["Distinctness"] is None


def test_source_that_keeps_sketches(spark, tmp_path):
    spec = ProfileSpec(str(tmp_path / "s"), distinct_state="sketch")
    for i in range(3):
        batch = spark.range(i * 1000, i * 1000 + 3000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5).alias("v"))
        # Later batches follow the first one's choice.
        assert profile_batch(spark, batch, f"b{i}", spec if i == 0 else ProfileSpec(spec.result_folder), AS_OF)
    state = SourceState(spark, spec.result_folder)
    quality = state.source_quality(3).head()
    assert abs(quality["Distinct_Number_k"] - 5000) <= 5000 * relative_error() and quality["Distinct_Number_v"] == 5
    assert not (tmp_path / "s" / "source_distinct_values").exists()
    with pytest.raises(ValueError, match="exact"):
        ProfileSpec("x", distinct_state="none")
