"""State, profiling, assessment and streaming end to end."""

import datetime as dt
import json
import subprocess
import sys

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from plumbline import (AssessmentSpec, ColumnTypes, ProfileSpec, Range, Reference, Rule, SourceState, TextLayout, assess,
                       assess_frame, profile_batch, profile_files)
from plumbline.functions.times import instant
from plumbline.operators.inference import infer_types
from plumbline.operators.selection import select_rows
from plumbline.plans.merge import merge_quality
from plumbline.plans.profile import batch_metrics
from plumbline.plans.staging import stage, staging_folder
from plumbline.sources.readers import batch_digest, malformed_lines, parse_batch, read_batch, read_json
from plumbline.sources.state import read_bindings, write_table
from plumbline.spec import granularities
from plumbline.streaming.batches import profile_stream

# Seven trips, and the row scores they must get at AS_OF with a validity of 17500 hours.
AS_OF = "2018-04-03 14:42:17.844840"
TRIP_FORMAT = "%d/%m/%y %H:%M:%S,%f"
TRIPS = [
    ("542", "BAIRRO NOVO B", "GA130", "0002357837", "02/05/17 17:26:30,000000", 0.539356383415),
    ("000", "OPER S/LINHA", "09053", "0002357837", "02/05/17 17:58:40,000000", 0.539387018336),
    ("000", "OPER S/LINHA", "09053", "0002357837", "02/05/17 17:58:35,000000", 0.539386938971),
    ("213", "SÃO JOÃO", "BC913", "0002619557", "02/05/17 12:38:33,000000", 0.53908214532),
    ("000", "OPER S/LINHA", "03055", "0002619557", "02/05/17 20:55:25,000000", 0.539555351669),
    ("021", "INTERB II ANTI H", "08046", "0001937533", "02/05/17 20:16:13,000000", 0.539518018336),
    ("021", "INTERB II ANTI H", "04002", "0001937533", "02/05/17 13:08:08,000000", 0.539110319923),
]
FIELDS = ["CODLINHA", "NOMELINHA", "CODVEICULO", "NUMEROCARTAO", "DATAUTILIZACAO"]


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(path)


@pytest.fixture
def trips(spark, tmp_path):
    """A source with the trips profiled as one batch."""
    batch = write_lines(tmp_path / "in" / "doc1-2017050215.txt", [dict(zip(FIELDS, t)) for t in TRIPS])
    lines = write_lines(tmp_path / "association" / "part", [dict(zip(FIELDS[:2], t)) for t in TRIPS])
    spec = ProfileSpec(str(tmp_path / "result"), 17500.0, (TRIP_FORMAT,), (lines,))
    assert profile_files(spark, [batch], spec, AS_OF)
    return spec, batch


def test_known_row_scores(spark, trips):
    spec, _ = trips
    state = SourceState(spark, spec.result_folder)
    metadata = state.metadata()
    assert metadata.types.kinds == {"CODLINHA": "float", "CODVEICULO": "string", "DATAUTILIZACAO": "datetime",
                                    "NOMELINHA": "string", "NUMEROCARTAO": "float"}
    rows = state.extended(metadata).collect()
    assert rows[0].asDict().keys() == {*FIELDS, "COMPLETENESS_MISSING", "TIMELINESS_DATAUTILIZACAO",
                                       "ASSOCIATION_CONSISTENCY", "batch"}
    got = sorted((r["CODLINHA"], r["NOMELINHA"], r["CODVEICULO"], r["NUMEROCARTAO"], r["DATAUTILIZACAO"]) for r in rows)
    assert got == sorted(t[:5] for t in TRIPS)
    expected = {(t[2], t[4]): t[5] for t in TRIPS}
    for r in rows:
        assert r["TIMELINESS_DATAUTILIZACAO"] == pytest.approx(expected[r["CODVEICULO"], r["DATAUTILIZACAO"]], abs=1e-9)
        assert r["COMPLETENESS_MISSING"] == 1.0 and r["ASSOCIATION_CONSISTENCY"] == 1.0
        assert r["batch"] == "doc1-2017050215"


def test_first_batch_is_stored_as_it_is(spark, trips):
    spec, _ = trips
    state = SourceState(spark, spec.result_folder)
    quality = state.source_quality(state.version()).head().asDict()
    assert quality["UpdatesCount"] == 1 and quality["Volume_TotalRows"] == 7
    assert quality["Min_Value_NUMEROCARTAO"] == 1937533.0 and quality["Distinct_Number_CODVEICULO"] == 6
    assert quality["Distinctness_CODLINHA"] == pytest.approx(4 / 7)
    assert quality["Minimum_Timestamp_DATAUTILIZACAO"] == dt.datetime(2017, 5, 2, 12, 38, 33)
    assert quality["Timeliness_Mean_DATAUTILIZACAO"] == pytest.approx(sum(t[5] for t in TRIPS) / 7, abs=1e-9)


def test_ledger_and_second_batch(spark, tmp_path, trips):
    spec, batch = trips
    assert not profile_files(spark, [batch], spec, "2019-01-01 00:00:00")
    state = SourceState(spark, spec.result_folder)
    assert state.version() == 1
    more = [dict(zip(FIELDS, t)) for t in TRIPS[:2]] + [{"CODLINHA": "999", "DATAUTILIZACAO": "not a time", "NEW": "x"}]
    second = write_lines(tmp_path / "in" / "doc2.txt", more)
    # A killed run of the same version left values behind; they are not seen, and overwritten.
    state.write_version(spark.createDataFrame([("CODLINHA", "left behind")], "attribute string, value string"),
                        "source_distinct_values", 2)
    assert state.distinct_values(1).filter("value = 'left behind'").isEmpty()
    state.write_extended(state.extended_batch(state.metadata(), "doc1-2017050215").drop("batch"), "doc2")
    assert state.extended(state.metadata()).count() == 7
    assert profile_files(spark, [second], spec, "2018-05-03 14:42:17.844840")
    state = SourceState(spark, spec.result_folder)
    quality = state.source_quality(state.version()).head().asDict()
    assert quality["UpdatesCount"] == 2 and quality["Volume_TotalRows"] == 10
    assert quality["Distinct_Number_CODLINHA"] == 5 and quality["Max_Value_CODLINHA"] == 999.0
    assert quality["Completeness_Missing"] == pytest.approx((7 * 1.0 + 3 * (12 / 15)) / 10)
    old = sum(t[5] for t in TRIPS) / 7 - 30 * 24 / 17500
    new = (TRIPS[0][5] + TRIPS[1][5] - 2 * 30 * 24 / 17500 + 0) / 3
    assert quality["Timeliness_Mean_DATAUTILIZACAO"] == pytest.approx((7 * old + 3 * new) / 10, abs=1e-9)
    assert quality["Timeliness_Min_DATAUTILIZACAO"] == 0.0
    metadata = state.metadata()
    assert state.extended(metadata).count() == 10
    assert state.extended(metadata, state.correct_batches(["doc2", "unknown"])).count() == 3
    assert sorted(r["batch"] for r in state.correct_batches().collect()) == ["doc1-2017050215", "doc2"]


def test_failed_batch_is_recorded_and_can_run_again(spark, tmp_path):
    spec = ProfileSpec(str(tmp_path / "result"), 10.0, ("%Q",))
    batch = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="%Q"):
        profile_batch(spark, batch, "b", spec, AS_OF)
    state = SourceState(spark, spec.result_folder)
    assert state.ledger().head()["correctAnalysis"] == 0 and state.version() == 0 and state.metadata() is None
    assert profile_batch(spark, batch, "b", ProfileSpec(spec.result_folder), AS_OF)
    assert state.is_analysed("b") and state.version() == 1


def test_profile_with_rates_and_rules(spark, tmp_path):
    folder = tmp_path / "result"
    write_lines(folder / "update_rate_global_t" / "part", [{"Hour": 5, "Frequency": 4 / 3600}])
    write_lines(folder / "association_rules" / "part", [{"Antecedent": "k", "Consequent": "v"},
                                                         {"Antecedent": "k", "Consequent": "gone"}])
    data = [("a", "x", dt.datetime(2024, 1, 1, 5)), ("a", "y", dt.datetime(2024, 1, 1, 5)), ("b", "x", None)]
    batch = spark.createDataFrame(data, "k string, v string, t timestamp")
    profile_batch(spark, batch, "b", ProfileSpec(str(folder)), "2024-01-02 00:00:00")
    quality = SourceState(spark, str(folder)).source_quality(1).head().asDict()
    assert quality["Completeness_Frequency_t"] == 0.5 and quality["Consistency_k_v"] == 0.75
    assert "Consistency_k_gone" not in quality


def test_text_batches(spark, tmp_path):
    path = tmp_path / "in" / "lines.txt"
    path.parent.mkdir()
    path.write_text('id,price\n[1]["2,5"]\n[2][3,5]\n')
    layout = TextLayout("[", "]", header=("id", "price"))
    spec = ProfileSpec(str(tmp_path / "result"), layout=layout, file_format="text")
    headless = tmp_path / "in" / "headless.txt"
    headless.write_text('[1]["2,5"]\n\n[2][3,5]\n')
    assert profile_files(spark, [str(headless)], spec, AS_OF)
    quality = SourceState(spark, spec.result_folder).source_quality(1).head()
    assert quality["Max_Value_price"] == 3.5 and quality["Volume_TotalRows"] == 2
    with pytest.raises(ValueError, match="layout"):
        read_batch(spark, str(path), "text")


def test_parquet_batches_and_several_files(spark, tmp_path):
    for i in (1, 2):
        spark.createDataFrame([(i, float(i))], "a int, b double").write.parquet(str(tmp_path / f"f{i}"))
    spec = ProfileSpec(str(tmp_path / "result"), file_format="parquet")
    profile_files(spark, [str(tmp_path / "f1"), str(tmp_path / "f2")], spec, AS_OF)
    state = SourceState(spark, spec.result_folder)
    assert state.is_analysed("f1_f2") and state.source_quality(1).head()["Number_Mean_b"] == 1.5


def test_merging_halves_gives_the_whole(spark):
    """Counts, completeness, extremes and pooled moments of two halves are those of all rows."""
    rows = [(f"k{i % 5}" if i % 7 else None, float(i * i % 23) - 4, dt.datetime(2024, 1, 1 + i % 28, i % 24)) for i in range(200)]
    types = ColumnTypes({"k": "string", "x": "float", "t": "datetime"})
    schema = "k string, x double, t timestamp"
    now = instant("2024-02-01 00:00:00")

    def metrics(data):
        return batch_metrics(spark.createDataFrame(data, schema), types, 5000.0, now)

    first, rules = metrics(rows[:70])
    merged = merge_quality(merge_quality(None, first, rules, now), metrics(rows[70:])[0], rules, now).head().asDict()
    whole = merge_quality(None, *metrics(rows), now).head().asDict()
    assert merged.pop("UpdatesCount") == 2 and whole.pop("UpdatesCount") == 1
    weighted = {"Precision_x", "Precision_Deviation_x"}         # merged by rows, which is not exact
    for name in whole.keys() - weighted:
        assert merged[name] == (pytest.approx(whole[name]) if isinstance(whole[name], float) else whole[name]), name


def test_merge_keeps_metrics_one_side_lacks(spark):
    now = instant("2024-01-02 00:00:00")
    old, rules = batch_metrics(spark.createDataFrame([("a", 1.0)], "k string, x double"),
                               ColumnTypes({"k": "string", "x": "float"}), 10, now, rules=[Rule(("k",), ("x",))])
    stored = merge_quality(None, old, rules, now)
    new, rules = batch_metrics(spark.createDataFrame([("a", None), ("b", None)], "k string, x double"),
                               ColumnTypes({"k": "string", "x": "float"}), 10, now)
    row = merge_quality(stored, new, rules, now).head()
    assert row["Consistency_k_x"] == 1.0 and row["Precision_x"] == 1.0 and row["Min_Value_x"] == 1.0
    assert row["Pooled_Deviation_x"] == 0.0 and row["Number_Count_x"] == 1


# Assessment

def assessment(spec, **changes):
    settings = dict(
        columns=("CODLINHA", "CODVEICULO", "NUMEROCARTAO", "DATAUTILIZACAO", "NOMELINHA"),
        key_sets=[("CODLINHA", "CODVEICULO"), ("CODVEICULO",), ("NUMEROCARTAO",), ("DATAUTILIZACAO",)],
        dimensions={"Volume": ["global", "value"], "Precision": ["global", "attribute", "value"],
                    "Accuracy": ["global", "attribute", "value"],
                    "Completeness_Missing": ["global", "attribute", "value", "tuple"],
                    "Distinctness": ["global", "attribute"], "Timeliness": ["global", "attribute", "value", "tuple"],
                    "Completeness_Frequency": ["global", "attribute", "value"],
                    "Completeness_Population": ["attribute"], "Consistency": ["attribute", "value", "tuple"]},
        source_folder=spec.result_folder, output_folder=spec.result_folder + "/assessment",
        expected={"NUMEROCARTAO": (2075900.0, 1000000.0)}, extra_rules=[Rule(("CODLINHA",), ("CODVEICULO",))],
        volatility_hours={"DATAUTILIZACAO": 17500.0})
    return AssessmentSpec(**settings | changes)


def test_assessment_writes_every_table(spark, tmp_path, trips):
    spec, _ = trips
    folder = tmp_path / "result"
    write_lines(folder / "update_rate_global_DATAUTILIZACAO" / "part", [{"Hour": h, "Frequency": 4 / 3600} for h in (17, 20)])
    write_lines(folder / "update_rate_values_DATAUTILIZACAO" / "part",
                [{"Key": "NUMEROCARTAO", "Value": "0002357837", "Hour": 17, "Frequency": 0.001}])
    result = assess(spark, assessment(spec), AS_OF)
    assert result.errors == {} and result.folder.endswith("assessment_20180403-144217_confidence_1.0")
    tables = {name: spark.read.parquet(path) for name, path in result.tables.items()}
    assert set(tables) == {
        "final_quality", "accuracy_values", "accuracy_attributes", "precision_values", "precision_attributes",
        "completeness_missing_values", "completeness_missing_attributes", "completeness_frequency_values",
        "completeness_frequency_attributes", "completeness_frequency_global_hour", "timeliness_values",
        "timeliness_attributes", "volume_values", "completeness_population_attributes", "distinctness_attributes",
        "consistency_values", "consistency_attributes_mean_per_rule", "extended_dataset"}
    final = tables["final_quality"].head().asDict()
    assert final["Volume"] == 1.0 and final["Volume_TotalRows"] == 7 and final["Confidence"] == 1.0
    assert final["Completeness_Missing"] == 1.0 and final["Distinctness"] == 1.0
    assert final["Completeness_Frequency_DATAUTILIZACAO"] == pytest.approx((3 / 4 + 2 / 4) / 2)
    assert final["Timeliness_Mean_DATAUTILIZACAO"] == pytest.approx(sum(t[5] for t in TRIPS) / 7, abs=1e-9)
    volume = as_dicts(tables["volume_values"], "key_set", "key_value")
    assert volume["CODLINHA_CODVEICULO", "000,09053"]["Count"] == 2
    assert {k for k, _ in volume} == {"CODLINHA_CODVEICULO", "CODVEICULO", "NUMEROCARTAO"}      # no time keys
    accuracy = as_dicts(tables["accuracy_values"], "key_set", "key_value")
    assert accuracy["CODVEICULO", "GA130"]["AccuracyDynamic"] == pytest.approx(1 - (2357837 - 2075900) / 500000)
    precision = as_dicts(tables["precision_attributes"], "key_set", "attribute")
    assert set(precision) == {("CODLINHA_CODVEICULO", "NUMEROCARTAO"), ("CODVEICULO", "NUMEROCARTAO"),
                              ("CODVEICULO", "CODLINHA"), ("NUMEROCARTAO", "CODLINHA")}
    missing = as_dicts(tables["completeness_missing_attributes"], "key_set")
    assert "DATAUTILIZACAO" in missing and missing["CODVEICULO"]["MissingValues"] == 0
    population = as_dicts(tables["completeness_population_attributes"], "key_set")
    assert population["CODVEICULO"]["CompletenessPopulationValue"] == 1.0
    frequency = tables["completeness_frequency_values"].collect()
    assert [(r["key_value"], r["RecordNumber"], r["CompletenessFrequencyValue"]) for r in frequency] == [
        ("0002357837", 3, 1.0)]
    consistency = as_dicts(tables["consistency_values"], "AntecedentValue")
    assert consistency["000"]["ConsistencyValue"] == pytest.approx(2 / 3)
    assert tables["extended_dataset"].count() == 7


def test_selection_and_scope(spark, tmp_path):
    """Rows with a NULL count for completeness only; the volume is relative to all rows of the source."""
    data = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 2.0), (None, 5.0), ("c", 9.0)]
    df = spark.createDataFrame(data, "k string, x double")
    types = ColumnTypes({"k": "string", "x": "float"})
    spec = AssessmentSpec(columns=("k", "x"), key_sets=[("k",)], ranges={},
                          dimensions={"Volume": ["global", "value"], "Completeness_Missing": ["global", "value"],
                                      "Precision": ["global", "value"]})
    tables = assess_frame(df, types, spec, AS_OF, str(tmp_path / "s1"))
    final = tables["final_quality"].head().asDict()
    assert final["Volume_TotalRows"] == 4 and final["Completeness_Missing"] == pytest.approx(10 / 12)
    assert final["Volume"] == pytest.approx(4 / 6)
    values = as_dicts(tables["completeness_missing_values"], "key_value")
    assert values["a"]["MissingValues"] == 1 and set(values) == {"a", "b", "c"}
    assert as_dicts(tables["volume_values"], "key_value")["a"]["Count"] == 2
    assert as_dicts(tables["precision_values"], "key_value")["a"]["Mean"] == 2.0
    without = AssessmentSpec(columns=("k", "x"), key_sets=[("k",)], dimensions={"Precision": ["global", "value"]},
                             ranges={"x": [Range("2", None)]}, values={"k": ["a", "b"]})
    tables = assess_frame(df, types, without, AS_OF, str(tmp_path / "s2"))
    assert as_dicts(tables["precision_values"], "key_value").keys() == {"a", "b"}
    assert set(tables) == {"precision_values", "final_quality"}


def test_failing_part_leaves_the_others(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "k string, x double")
    rates = {"x": spark.range(1)}               # x is taken for a time, which it is not
    types = ColumnTypes({"k": "string", "x": "datetime"})
    spec = AssessmentSpec(columns=("k", "x"), extra_rules=[Rule(("k",), ("x",))],
                          dimensions={"Completeness_Frequency": ["global"], "Consistency": ["attribute"], "Volume": []})
    errors = {}
    tables = assess_frame(df, types, spec, AS_OF, str(tmp_path / "a"), Reference(hourly_rates=rates), errors)
    assert set(errors) == {"frequency"} and tables["final_quality"].head()["Volume"] == 1.0
    assert tables["consistency_attributes_mean_per_rule"].head()["ConsistencyValue"] == 1.0
    with pytest.raises(ValueError, match="not a time"):
        assess_frame(df, types, spec, AS_OF, str(tmp_path / "b"), Reference(hourly_rates=rates))


def test_sampled_assessment(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("x"))
    types = ColumnTypes({"k": "string", "x": "float"})
    spec = AssessmentSpec(columns=("k", "x"), key_sets=[("k",)], sample=0.2, seed=11,
                          dimensions={"Volume": ["global", "value"], "Distinctness": ["global", "attribute"]})
    tables = assess_frame(df, types, spec, AS_OF, str(tmp_path / "s"))
    final = tables["final_quality"].head()
    assert final["Confidence"] == 0.2 and final["Distinctness"] == 1.0 and 800 < final["Volume_TotalRows"] < 1200
    assert tables["volume_values"].agg(F.sum("Count")).head()[0] == final["Volume_TotalRows"]
    assert tables["distinctness_attributes"].head()["Confidence"] == 0.2


def test_rescored_rows(spark, tmp_path, trips):
    spec, _ = trips
    later = "2018-05-03 14:42:17.844840"
    only_time = {"Timeliness": ["tuple"], "Consistency": ["tuple"]}
    same = SourceState(spark, spec.result_folder).metadata().binding_paths
    none_match = write_lines(tmp_path / "none" / "part", [{"CODVEICULO": "nowhere"}])
    unselected = write_lines(tmp_path / "other" / "part", [{"NOMELINHA": "nowhere"}])

    def scores(output, **changes):
        result = assess(spark, assessment(spec, dimensions=only_time, output_folder=str(tmp_path / output), **changes), later)
        assert result.errors == {}
        rows = spark.read.parquet(result.tables["extended_dataset"]).collect()
        assert len(rows) == 7
        return {r["ASSOCIATION_CONSISTENCY"] for r in rows}, sorted(r["TIMELINESS_DATAUTILIZACAO"] for r in rows)

    association, timeliness = scores("a", binding_paths=same)
    assert association == {1.0}
    assert timeliness == pytest.approx(sorted(t[5] - 30 * 24 / 17500 for t in TRIPS), abs=1e-9)
    assert scores("b", binding_paths=(none_match,))[0] == {0.0}
    selected = ("CODLINHA", "CODVEICULO", "DATAUTILIZACAO")
    keys = [("CODVEICULO",)]
    # A list on a column that is not selected does not count; with no list left the scores stay.
    assert scores("c", binding_paths=(unselected,), columns=selected, key_sets=keys, extra_rules=())[0] == {1.0}
    assert scores("d", binding_paths=(none_match, unselected), columns=selected, key_sets=keys, extra_rules=())[0] == {0.0}
    kept = scores("e", binding_paths=same, columns=("CODVEICULO", "NUMEROCARTAO"), key_sets=keys, extra_rules=(), expected={})
    assert kept[1] == pytest.approx(sorted(t[5] for t in TRIPS), abs=1e-9)      # the time column is not selected


def test_summary_only_and_errors(spark, tmp_path, trips):
    spec, _ = trips
    result = assess(spark, assessment(spec, source_summary=True, file_format="json"), AS_OF)
    assert list(result.tables) == ["source_quality"]
    assert spark.read.json(result.tables["source_quality"]).head()["Volume_TotalRows"] == 7
    with pytest.raises(ValueError, match="does not have"):
        assess(spark, assessment(spec, columns=("CODVEICULO", "nope"), key_sets=[], extra_rules=(), expected={}), AS_OF)
    with pytest.raises(ValueError, match="no correctly analysed batch"):
        assess(spark, assessment(spec, source_folder=str(tmp_path / "empty")), AS_OF)
    # The folder exists already: each table reports its error and the run goes on.
    again = assess(spark, assessment(spec, source_summary=True, file_format="json"), AS_OF)
    assert again.tables == {} and "source_quality" in again.errors


def test_configuration_lines(trips):
    spec, _ = trips
    types = ColumnTypes({"CODLINHA": "float", "CODVEICULO": "string", "DATAUTILIZACAO": "datetime",
                         "NOMELINHA": "string", "NUMEROCARTAO": "float"}, {"DATAUTILIZACAO": TRIP_FORMAT})
    lines = ["/source;doc1;doc2", "/out", "CODVEICULO;NUMEROCARTAO;DATAUTILIZACAO", "CODVEICULO,NUMEROCARTAO;CODVEICULO",
             "A:B,C:;;01/01/2017 00.00.00:", ";1,2;", "Volume;Accuracy;Timeliness;Consistency-R", "17500", "0002075900",
             "1000,5", "NUMEROCARTAO,CODVEICULO:DATAUTILIZACAO;", "global,value;;global,tuple;attribute", "0", "/a;/b"]
    got = AssessmentSpec.from_lines(lines, types, 0.5)
    assert got.batches == ("doc1", "doc2") and got.source_folder == "/source" and got.sample == 0.5
    assert got.key_sets == [("CODVEICULO", "NUMEROCARTAO"), ("CODVEICULO",)]
    assert got.ranges == {"CODVEICULO": [Range("A", "B"), Range("C", None)],
                          "DATAUTILIZACAO": [Range("01/01/2017 00.00.00", None)]}
    assert got.values == {"NUMEROCARTAO": ["1", "2"]} and got.expected == {"NUMEROCARTAO": (2075900.0, 1000.5)}
    assert got.volatility_hours == {"DATAUTILIZACAO": 17500.0} and got.refresh_association
    assert got.dimensions == {"Volume": ("global", "value"), "Accuracy": ("global",), "Timeliness": ("global", "tuple"),
                              "Consistency": ("attribute",)}
    assert got.extra_rules == [Rule(("NUMEROCARTAO", "CODVEICULO"), ("DATAUTILIZACAO",))] and got.binding_paths == ("/a", "/b")
    lines[0], lines[12] = "/source;*", "1"
    summary = AssessmentSpec.from_lines(lines, types)
    assert summary.source_summary and summary.batches is None
    with pytest.raises(ValueError, match="14"):
        AssessmentSpec.from_lines(lines[:3], types)


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    from plumbline.__main__ import main
    for day in (1, 2):
        write_lines(tmp_path / f"doc2024010{day}.txt", [{"k": "a", "t": f"0{day}/01/24"}, {"k": None, "t": "bad"}])
    result = str(tmp_path / "result")
    profile = ["--as-of", "2024-01-03 00:00:00", "profile", str(tmp_path / "doc%Y%m%d.txt"), result,
               "--volatility", "100", "--time-format", "%d/%m/%y", "--series",
               str(tmp_path / "doc20240101.txt"), str(tmp_path / "doc20240102.txt"), "1"]
    assert main(profile) == 0 and "profiled" in capsys.readouterr().out
    assert main(profile) == 0 and "analysed before" in capsys.readouterr().out
    configuration = tmp_path / "configuration.txt"
    configuration.write_text("\n".join([f"{result};*", f"{result}/out", "k;t", "k", ";", ";", "Volume;Completeness_Missing",
                                        "", "", "", "", "global;attribute", "0", ""]))
    assert main(["--as-of", "2024-01-03 00:00:00", "assess", str(configuration), "1.0"]) == 0
    assert "final_quality" in capsys.readouterr().out
    final = spark.read.parquet(f"{result}/out_20240103-000000_confidence_1.0/final_quality").head()
    assert final["Volume_TotalRows"] == 2 and final["Volume"] == 0.5
    with pytest.raises(ValueError, match="series"):
        main(profile[:-3] + ["x", "y", "1"])


def test_levels_are_checked():
    assert granularities("Volume", []) == ("global",) and granularities("Volume", ["", "value"]) == ("value",)
    for dimension, levels in (("Consistency", ["global"]), ("Consistency", []), ("Volume", ["tuple"]), ("Speed", [])):
        with pytest.raises(ValueError):
            granularities(dimension, levels)
    with pytest.raises(ValueError, match="not selected"):
        AssessmentSpec(columns=("a",), dimensions={}, key_sets=[("b",)])
    with pytest.raises(ValueError, match="fraction"):
        AssessmentSpec(columns=("a",), dimensions={}, sample=0)


def test_empty_selection(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "k string, x double")
    spec = AssessmentSpec(columns=("k", "x"), key_sets=[("k",)], values={"k": ["zzz"]},
                          dimensions={"Volume": ["global", "value"], "Completeness_Missing": ["global"],
                                      "Distinctness": ["global"]})
    tables = assess_frame(df, ColumnTypes({"k": "string", "x": "float"}), spec, AS_OF, str(tmp_path / "s"))
    final = tables["final_quality"].head()
    assert final["Volume"] == 0.0 and final["Volume_TotalRows"] == 0 and final["Distinctness"] is None
    assert tables["volume_values"].isEmpty()


def test_batches_prune_partitions(spark, trips):
    spec, _ = trips
    state = SourceState(spark, spec.result_folder)
    for batches, pruning in ((["doc1-2017050215"], "(batch#"), (["doc1-2017050215", "doc2"], "(batch#"),
                             (None, "dynamicpruning")):
        rows = state.extended(state.metadata(), state.correct_batches(batches)).select("CODLINHA")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert pruning in plan.split("PartitionFilters: [")[1].split("ReadSchema")[0]
        assert "ReadSchema: struct<CODLINHA:string>" in plan


def test_staging(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = staging_folder(spark, str(tmp_path))
    assert folder.startswith(configured.rstrip("/") if configured else str(tmp_path))
    frame = spark.createDataFrame([(1, None)], "a int, `odd (name)` string")
    assert stage(frame, str(tmp_path / "x"), "t").collect() == frame.collect()


def test_binding_paths_that_cannot_be_read(spark, tmp_path):
    """A list that is missing, empty or damaged is an error: leaving it out would change the scores."""
    good = write_lines(tmp_path / "good", [{"a": "1"}])
    (tmp_path / "bad").write_text('{"a": "1"}\nnot json\n')
    (tmp_path / "empty").write_text("")
    assert [b.columns for b in read_bindings(spark, [good])] == [["a"]]
    for path, why in (("absent", "no valid"), ("bad", "no JSON"), ("empty", "no valid")):
        with pytest.raises(ValueError, match=why):
            read_bindings(spark, [good, str(tmp_path / path)])


def test_damaged_binding_list_is_reported(spark, tmp_path, trips):
    spec, _ = trips
    (tmp_path / "bad").write_text("not json\n")
    result = assess(spark, AssessmentSpec(
        columns=("CODLINHA", "NOMELINHA"), dimensions={"Consistency": ["tuple"], "Volume": ["global"]}, source_folder=spec.result_folder,
        output_folder=str(tmp_path / "out"), binding_paths=(str(tmp_path / "bad"),)), AS_OF)
    assert list(result.errors) == ["extended_dataset"] and "no JSON" in result.errors["extended_dataset"]
    assert list(result.tables) == ["final_quality"]


def test_batches_of_equal_names_are_kept_apart(spark, tmp_path):
    paths = [write_lines(tmp_path / day / "part.txt", [{"a": str(i)}, {"a": "x"}]) for i, day in enumerate(("01", "02"))]
    spec = ProfileSpec(str(tmp_path / "result"))
    assert [profile_files(spark, [p], spec, AS_OF) for p in paths + paths] == [True, True, False, False]
    state = SourceState(spark, spec.result_folder)
    rows = state.extended(state.metadata())
    assert sorted(r["a"] for r in rows.collect()) == ["0", "1", "x", "x"]
    names = sorted(r["batch"] for r in state.correct_batches().collect())
    assert names == ["part", f"part-{batch_digest([paths[1]])}"]
    assert state.correct_batches(["part"]).count() == 2 and state.correct_batches([names[1]]).count() == 1
    assert batch_digest(paths) == batch_digest(paths[::-1]) != batch_digest(paths[:1])


@pytest.mark.parametrize("columns", [None, ("a", "b")])
def test_malformed_lines_are_reported_and_left_out(spark, tmp_path, columns):
    path = tmp_path / "in.txt"
    path.write_text('{"a": "1", "b": "x"}\nnot json\n{"a": "2", "b": "y"}\n{"a": "3"\n')
    spec = ProfileSpec(str(tmp_path / "result"), columns=columns)
    assert profile_files(spark, [str(path)], spec, AS_OF)
    state = SourceState(spark, spec.result_folder)
    quality = state.source_quality(1).head()
    assert quality["Volume_TotalRows"] == 2 and quality["Completeness_Missing"] == 1.0
    assert state.metadata().columns == ["a", "b"]
    assert sorted(tuple(r) for r in state.malformed().collect()) == [("not json", "in"), ('{"a": "3"', "in")]
    (tmp_path / "none.txt").write_text("not json\n")
    with pytest.raises(ValueError, match="no JSON objects"):
        read_batch(spark, [str(tmp_path / "none.txt")])


def test_reader_options_and_layout_formats(spark, tmp_path):
    (tmp_path / "in.csv").write_text("day;x\n02/05/17;1\n03/05/17;2\n")
    spec = ProfileSpec(str(tmp_path / "csv"), time_formats=("%d/%m/%y",), file_format="csv", options={"header": "true", "sep": ";"})
    assert profile_files(spark, [str(tmp_path / "in.csv")], spec, AS_OF)
    assert SourceState(spark, spec.result_folder).metadata().types.kinds == {"day": "datetime", "x": "float"}
    (tmp_path / "in.txt").write_text(";02/05/17;;1;\n;03/05/17;;2;\n")
    layout = TextLayout(";", ";", ("day", "x"), ("%d/%m/%y",))
    spec = ProfileSpec(str(tmp_path / "text"), file_format="text", layout=layout)
    assert profile_files(spark, [str(tmp_path / "in.txt")], spec, AS_OF)
    types = SourceState(spark, spec.result_folder).metadata().types
    assert types.kinds == {"day": "datetime", "x": "float"} and types.formats == {"day": "%d/%m/%y"}


def test_one_bad_parameter_leaves_the_other_dimensions(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k string, x double")
    spec = AssessmentSpec(columns=("k", "x"), key_sets=[("k",)], expected={"x": (5.0, 0.0)}, dimensions={
        "Volume": ["global"], "Completeness_Missing": ["global"], "Precision": ["global", "value"], "Accuracy": ["global", "value"]})
    errors = {}
    tables = assess_frame(frame, ColumnTypes({"k": "string", "x": "float"}), spec, AS_OF, str(tmp_path), errors=errors)
    row = tables["final_quality"].head().asDict()
    assert list(errors) == ["Accuracy"] and "accuracy_values" not in tables and tables["precision_values"].count() > 0
    assert {"Volume", "Volume_TotalRows", "Completeness_Missing", "Precision_x", "Precision_Deviation_x", "Confidence"} <= set(row)
    with pytest.raises(Exception):
        assess_frame(frame, ColumnTypes({"k": "string", "x": "float"}), spec, AS_OF, str(tmp_path / "2"))


def test_time_range_of_a_text_source_reaches_the_scan(spark, tmp_path, trips):
    spec, _ = trips
    state = SourceState(spark, spec.result_folder)
    metadata = state.metadata()
    assert set(metadata.typed) == {"CODLINHA", "NUMEROCARTAO", "DATAUTILIZACAO"}
    rows = state.extended(metadata, typed=True)
    limits = {"DATAUTILIZACAO": [Range("02/05/2017 17.00.00", None)], "NUMEROCARTAO": [Range("2000000", None)]}
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        chosen = select_rows(rows, FIELDS, limits, {}, metadata.types)
        pushed = chosen._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1]
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    assert "GreaterThanOrEqual(__typed_DATAUTILIZACAO" in pushed and "GreaterThanOrEqual(__typed_NUMEROCARTAO" in pushed
    plain = select_rows(state.extended(metadata), FIELDS, limits, {}, metadata.types)
    assert sorted(map(str, chosen.collect())) == sorted(map(str, plain.collect())) and chosen.count() == 4


def test_a_line_is_data_or_malformed(spark, tmp_path):
    lines = ['{"a":1}', '[{"a":2},{"a":3}]', "", "  ", '[{"a":4},5]', "[]", "7", '"text"', "{", '{"a":null,"b":{"c":[1, 2]}}', "{}", '  {"a":" x "}', "null"]
    path = tmp_path / "lines"
    path.write_text("\n".join(lines) + "\n")
    for columns in (None, ("a", "b")):
        batch = parse_batch(spark, [str(path)], str(tmp_path / f"staged-{columns}"), columns=columns)
        got = sorted(((r["a"], r["b"]) for r in batch.rows.collect()), key=repr)
        assert got == sorted([("1", None), ("2", None), ("3", None), (None, '{"c":[1,2]}'), (None, None), (" x ", None)], key=repr)
        bad = ['[{"a":4},5]', "7", '"text"', "{", "null"]
        assert sorted(r["line"] for r in batch.malformed.collect()) == sorted(bad) and (batch.n_rows, batch.n_malformed) == (6, 5)
        assert sorted(((r["a"], r["b"]) for r in read_json(spark, str(path), columns).collect()), key=repr) == got
    assert sorted(r["line"] for r in malformed_lines(spark, str(path)).collect()) == sorted(bad)
    with pytest.raises(ValueError, match="no JSON objects"):
        path.write_text("7\n")
        parse_batch(spark, [str(path)], str(tmp_path / "none"))


def test_raw_files_are_scanned_once(tmp_path):
    """In a session of its own, whose event log tells the scans of a batch of 200 columns from first to last."""
    lines = [{f"c{i}": f"{i}.5" if i % 2 else "02/05/17 17:26:30" for i in range(200)} for _ in range(3)]
    path = write_lines(tmp_path / "in" / "wide.txt", lines)
    write_lines(tmp_path / "in" / "few.txt", [{"k": "a", "v": "1"}, {"k": "b"}])
    (tmp_path / "in" / "cells.txt").write_text("[a][1,5]\n[b][2]\n")
    code = f"""
import sys
sys.path[:0] = {[str(p) for p in sys.path]!r}
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", "file://{tmp_path}/events").config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
from plumbline import ProfileSpec, TextLayout, profile_files
from plumbline.operators.inference import infer_types
from plumbline.sources.readers import parse_batch
kinds = infer_types(parse_batch(spark, [{path!r}], "{tmp_path}/staged").rows, ("%d/%m/%y %H:%M:%S",)).kinds
assert len(kinds) == 200 and kinds["c1"] == "float" and kinds["c2"] == "datetime"
for name, options in (("few.txt", dict()), ("cells.txt", dict(file_format="text", layout=TextLayout("[", "]", ("x", "y"))))):
    spec = ProfileSpec("{tmp_path}/" + name + "-result", **options)
    assert profile_files(spark, ["{tmp_path}/in/" + name], spec, "2024-01-01 00:00:00")
spark.stop()
"""
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    [log] = [p for p in (tmp_path / "events").iterdir() if not p.name.startswith(".")]
    plans = [e for e in map(json.loads, log.read_text().splitlines()) if e["Event"].endswith("SparkListenerSQLExecutionStart")]
    for raw in ("wide.txt", "few.txt", "cells.txt"):
        assert sum(e["physicalPlanDescription"].count("Scan text") and raw in e["physicalPlanDescription"] for e in plans) == 1, raw


def test_types_of_many_columns(spark):
    frame = spark.range(50).select(*[(F.col("id") + i).cast("string").alias(f"c{i}") if i % 2 else F.concat(F.lit("x"), F.col("id")).alias(f"c{i}")
                                     for i in range(500)])
    types = infer_types(frame, ("%d/%m/%y",))
    assert [types.kinds[f"c{i}"] for i in range(500)] == ["string", "float"] * 250


def test_stored_rules_are_bounded(spark, monkeypatch):
    from plumbline.operators import consistency
    monkeypatch.setattr(consistency, "MAX_RULES", 2)
    stored = spark.createDataFrame([("a", c) for c in "bcd"], "Antecedent string, Consequent string")
    with pytest.raises(ValueError, match="more than 2"):
        consistency.rule_set(stored, (), ["a", "b"])
    assert len(consistency.rule_set(stored.limit(2), (), ["a", "b", "c", "d"])) == 2


def test_tables_are_not_overwritten_by_default(spark, tmp_path):
    frame = spark.createDataFrame([(1,)], "a int")
    path = write_table(frame, str(tmp_path), "t", "json")
    with pytest.raises(Exception, match="(?i)exist"):
        write_table(frame, str(tmp_path), "t", "json")
    write_table(frame, str(tmp_path), "t", "json", "append")
    assert spark.read.json(path).count() == 2


def test_stream_of_batches(spark, tmp_path):
    write_lines(tmp_path / "in" / "one", [{"a": "1"}, {"a": "2"}])
    write_lines(tmp_path / "in" / "two", [{"a": "3"}])
    stream = (spark.readStream.schema("a string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")))
    spec = ProfileSpec(str(tmp_path / "result"))
    query = profile_stream(stream, spec, str(tmp_path / "checkpoint"), "s", available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None
    state = SourceState(spark, spec.result_folder)
    quality = state.source_quality(state.version()).head()
    assert quality["UpdatesCount"] == 2 and quality["Volume_TotalRows"] == 3 and quality["Distinct_Number_a"] == 3
    # A new checkpoint counts from 0 again; its batches are new ones.
    write_lines(tmp_path / "more" / "one", [{"a": "4"}])
    again = spark.readStream.schema("a string").json(str(tmp_path / "more"))
    query = profile_stream(again, spec, str(tmp_path / "checkpoint2"), "s", available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None and state.source_quality(state.version()).head()["Volume_TotalRows"] == 4
    assert Reference().volatility_hours == 17520.0


def test_text_files_grow_in_number_not_in_size(spark, monkeypatch):
    import checks.files

    monkeypatch.setattr(checks.files, "FILE_ROWS", 500, raising=False)
    path = checks.files._text_files(spark, "/root/testdata/sf0.001", True)
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    per_file = [r["n"] for r in lines.groupBy("file").agg(F.count("value").alias("n")).collect()]
    assert sum(per_file) == 6000 + len(per_file) and len(per_file) == 12 and max(per_file) < 1000
    assert lines.filter("value = 'flag,price,day'").select("file").distinct().count() == 12
