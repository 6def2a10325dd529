import datetime as dt

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from plumbline.functions.cells import as_text
from plumbline.operators.consistency import (Rule, consistency_attribute, consistency_value, parse_rule, rule_set,
                                             with_association)
from plumbline.operators.inference import ColumnTypes, dimension_columns, infer_types
from plumbline.operators.selection import Range, drop_incomplete, sample_rows, select_rows
from plumbline.plans.lookup import Lookup, flag_known, hot_keys, text_bytes
from plumbline.sources.readers import TextLayout, batch_name, clean_line, read_text, split_cells

GRID = ColumnTypes({"a": "float", "b": "float"})


def grid(rows):
    return rows([(a, b) for a in (1, 2, 3) for b in (1, 2, 3)], "a int, b int")


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_ranges_of_two_columns_must_both_hold(rows):
    got = select_rows(grid(rows), ["a", "b"], {"a": [Range("1", "2")], "b": [Range("1", "2")]}, {}, GRID)
    assert pairs(got) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_overlapping_ranges_give_a_row_once(rows):
    got = select_rows(grid(rows), ["a"], {"a": [Range("1", "2"), Range("2", None)]}, {}, GRID)
    assert got.count() == 9


def test_range_without_a_match_is_empty(rows):
    assert select_rows(grid(rows), ["a"], {"a": [Range("7", "9")]}, {}, GRID).count() == 0


def test_numbers_compare_as_numbers_and_texts_as_texts(rows):
    df = rows([("5",), ("05",), ("12",), ("3,5",), ("x",), (None,)], "v string")
    limits = {"v": [Range("4", "20")]}
    assert pairs(select_rows(df, ["v"], limits, {}, ColumnTypes({"v": "float"}))) == [("05",), ("12",), ("5",)]
    texts = {"v": [Range("1", "4")]}
    assert pairs(select_rows(df, ["v"], texts, {}, ColumnTypes({"v": "string"}))) == [("12",), ("3,5",)]


def test_time_ranges(rows):
    texts = rows([("02/05/17 17:26:30",), ("03/05/17 00:00:00",), ("bad",), (None,)], "t string")
    types = ColumnTypes({"t": "datetime"}, {"t": "%d/%m/%y %H:%M:%S"})
    limits = {"t": [Range.parse("02/05/2017 17.26.30:02/05/2017 23.00.00")]}
    assert pairs(select_rows(texts, ["t"], limits, {}, types)) == [("02/05/17 17:26:30",)]
    for kind in ("timestamp", "timestamp_ntz"):
        typed = rows([(dt.datetime(2017, 5, 2, 17, 26, 30),), (dt.datetime(2017, 5, 2, 17, 26, 29),)], f"t {kind}")
        assert select_rows(typed, ["t"], limits, {}, ColumnTypes({"t": "datetime"})).count() == 1
    dates = rows([(dt.date(2017, 5, 2),), (dt.date(2017, 5, 3),)], "t date")
    assert select_rows(dates, ["t"], {"t": [Range("02/05/2017 10.00.00")]}, {}, ColumnTypes({"t": "datetime"})).count() == 1


def test_value_lists(rows):
    df = rows([("x", 1), ("y", 2), (None, 1), ("x", 2)], "k string, n int")
    types = ColumnTypes({"k": "string", "n": "float"})
    assert pairs(select_rows(df, ["k", "n"], {}, {"k": ["x", "z"], "n": ["1"]}, types)) == [("x", 1)]
    with pytest.raises(ValueError, match="not selected"):
        select_rows(df, ["k"], {}, {"n": ["1"]}, types)


def test_range_texts():
    assert Range.parse("1:") == Range("1", None) and Range.parse(":2") == Range(None, "2")
    for wrong in ("", ":", "5"):
        with pytest.raises(ValueError):
            Range.parse(wrong)


def test_filters_reach_the_scan(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    rows([(1, dt.datetime(2024, 1, 1), "k", 2.0)], "a int, t timestamp_ntz, k string, unused double").write.parquet(path)
    types = ColumnTypes({"a": "float", "t": "datetime", "k": "string"})
    selected = select_rows(spark.read.parquet(path), ["a", "k"], {"a": [Range("1", "3")]}, {"k": ["k"]}, types)
    plan = selected._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,1" in plan and "LessThanOrEqual(a,3" in plan and "EqualTo(k,k)" in plan
    assert "unused" not in plan
    timed = select_rows(spark.read.parquet(path), ["a", "t"], {"t": [Range("01/01/2024 00.00.00")]}, {}, types)
    assert "GreaterThanOrEqual(t," in timed._jdf.queryExecution().executedPlan().toString()


def test_incomplete_rows_and_samples(rows):
    df = rows([(1, None), (2, "x"), (None, "y")], "a int, `b.c` string")
    assert drop_incomplete(df, ["a", "b.c"]).count() == 1 and drop_incomplete(df, ["a"]).count() == 2
    big = df.sparkSession.range(10000).toDF("id")
    sample = sample_rows(big, 0.1, seed=1)
    assert 800 < sample.count() < 1200 and sample.distinct().count() == sample.count()
    assert sample.collect() == sample_rows(big, 0.1, seed=1).collect()
    assert sample_rows(big, 1.0) is big
    for wrong in (0, 1.5, -1):
        with pytest.raises(ValueError):
            sample_rows(big, wrong)


# Consistency

def test_consistency(rows):
    data = [("a", "x", 1), ("a", "x", 2), ("a", "y", 1), ("b", "y", 1), (None, "x", 1)]
    df = rows(data, "k string, v string, n int")
    rules = [Rule(("k",), ("v",)), Rule(("v",), ("k",)), Rule(("k", "v"), ("n",))]
    values = consistency_value(df, rules)
    got = as_dicts(values, "Rule", "AntecedentValue")
    assert got["k -> v", "a"]["ConsistencyValue"] == pytest.approx(2 / 3) and got["k -> v", "null"]["ConsistencyValue"] == 1.0
    assert got["v -> k", "x"]["ConsistencyValue"] == pytest.approx(2 / 3) and got["v -> k", "y"]["ConsistencyValue"] == 0.5
    assert got["k,v -> n", "a,x"]["ConsistencyValue"] == 0.5
    assert len(got) == 3 + 2 + 4
    means = as_dicts(consistency_attribute(values, 0.3), "RuleAntecedent")
    assert means["k"]["ConsistencyValue"] == pytest.approx((2 / 3 + 1 + 1) / 3) and means["k"]["Confidence"] == 0.3


def test_rules(rows):
    assert parse_rule("x1,x2:y1") == Rule(("x1", "x2"), ("y1",)) and parse_rule("") is None
    with pytest.raises(ValueError):
        parse_rule("x1")
    stored = rows([("a,b", "c"), ("a", "gone")], "Antecedent string, Consequent string")
    extra = [Rule(("a", "b"), ("c",)), Rule(("b",), ("a",))]
    assert rule_set(stored, extra, ["a", "b", "c"]) == [Rule(("a", "b"), ("c",)), Rule(("b",), ("a",))]
    assert rule_set(None, [], ["a"]) == []


def test_association(rows):
    df = rows([("1", "x", 7), ("1", "y", 7), ("2", "x", 8), (None, "x", 7)], "a string, b string, n int")
    listed = rows([("1", "x"), ("1", "x"), ("2", "y"), (None, "x")], "a string, b string")
    numbers = rows([(7,)], "n int")
    other = rows([("q",)], "elsewhere string")
    scores = [r["ASSOCIATION_CONSISTENCY"] for r in with_association(df, [listed, numbers, other]).orderBy("a", "b").collect()]
    assert scores == [0.5, 1.0, 0.5, 0.0]           # (null,x) (1,x) (1,y) (2,x)
    assert with_association(df, [other]).columns == df.columns
    empty = with_association(df, [listed.limit(0)])
    assert {r["ASSOCIATION_CONSISTENCY"] for r in empty.collect()} == {0.0}
    replaced = with_association(with_association(df, [listed]), [numbers])
    assert replaced.columns.count("ASSOCIATION_CONSISTENCY") == 1 and replaced.count() == 4


def test_long_list_answers_like_a_short_one(spark):
    """One key holds a third of the rows; another hot key is not listed."""
    rows = spark.range(6000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "absent")
        .otherwise(F.col("id").cast("string")).alias("k"))
    known = (spark.range(0, 6000, 5).select(F.col("id").cast("string").alias("k"))
             .unionByName(spark.createDataFrame([("hot",), ("hot",)], "k string")))
    lookup = Lookup({"k": as_text("k")}, known, "known")
    short = flag_known(rows, [lookup])
    found = hot_keys(rows.select("k", F.col("id").cast("string").alias("id")), [["k"], ["id"], ["k", "k"]], 0.5).collect()
    assert sorted(map(tuple, found)) == [(0, '["absent"]'), (0, '["hot"]'), (2, '["absent","absent"]'), (2, '["hot","hot"]')]
    long = flag_known(rows, [lookup], broadcast_bytes=0)
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.collect()))
    assert long.count() == 6000 and long.filter("known AND k = 'hot'").count() == 2000
    assert text_bytes(spark.createDataFrame([("abc",), (None,)], "k string")) == 131


def test_scans_do_not_grow_with_the_lists(spark, tmp_path):
    """The rows are read once, however many long lists there are, and once for the sample."""
    path = str(tmp_path / "rows")
    spark.range(3000).select(*[F.col("id").cast("string").alias(c) for c in "abc"]).write.parquet(path)
    rows = spark.read.parquet(path)
    lists = [spark.range(0, 3000, step).select(F.col("id").cast("string").alias(c)) for c, step in zip("abc", (2, 3, 5))]
    for n in (1, 2, 3):
        flagged = flag_known(rows, [Lookup({c: F.col(c)}, known, f"known_{c}") for c, known in zip("abc"[:n], lists)], broadcast_bytes=0)
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        assert [flagged.filter(f"known_{c}").count() for c in "abc"[:n]] == [1500, 1000, 600][:n]


# Types

def test_inference(rows):
    data = [("1,5", "02/05/17", "2017-05-02", "x", None, "1", 3, "nan"),
            ("2e3", "03/05/17", "2017-05-03", "5", "", "02/05/17", 4, "7"), ("null", None, "", "", "nan", "", None, None)]
    df = rows(data, "num string, day string, iso string, mixed string, empty string, both string, n int, gap string")
    formats = ["%d/%m/%y", "%Y-%m-%d"]
    for probe in (1, 1000):
        types = infer_types(df, formats, probe)
        assert dict(types.kinds) == {"num": "float", "day": "datetime", "iso": "datetime", "mixed": "string",
                                     "empty": "string", "both": "string", "n": "float", "gap": "float"}
        assert dict(types.formats) == {"day": "%d/%m/%y", "iso": "%Y-%m-%d"}
    assert infer_types(df.limit(0), formats).kinds["num"] == "string"
    typed = rows([(dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), True)], "t timestamp, d date, b boolean")
    assert list(infer_types(typed).kinds.values()) == ["datetime", "datetime", "string"]


def test_first_matching_format_wins(rows):
    df = rows([("01/02/17",)], "t string")
    assert infer_types(df, ["%m/%d/%y", "%d/%m/%y"]).formats == {"t": "%m/%d/%y"}


def test_dimension_columns_take_the_types_present():
    columns = dimension_columns(ColumnTypes({"s": "string", "t": "datetime"}))
    assert columns["Distinctness"] == ["s"] and columns["Precision"] == [] and columns["Timeliness"] == ["t"]
    assert columns["Completeness_Missing"] == ["s", "t"]


# Text sources

def test_layout_cells(rows):
    lines = rows([('["1"][a\\b][2,5]',), ("",), ('""',), ("[3][c]",)], "value string")
    got = split_cells(lines, ["x", "y", "z"], TextLayout("[", "]")).collect()
    assert [tuple(r) for r in got] == [("1", "ab", "2.5"), ("3", "c", None)]
    assert TextLayout('[["', "]").cell_pattern == r"[\[](.*?)[\]]"


def test_first_line_as_header(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("x,y\n;1;;a;\nx,y\n;2;;b;\n\n")
    df = read_text(spark, str(path), TextLayout(";", ";"))
    assert df.columns == ["x", "y"] and pairs(df) == [("1", "a"), ("2", "b")]


def test_line_cleaning(rows):
    df = rows([('a"b\\c 1,5 x,y 10,20,30',)], "v string")
    assert df.select(clean_line(F.col("v"))).head()[0] == "abc 1.5 x,y 10.20,30"


def test_batch_names():
    assert batch_name(["hdfs://x/in/doc1.txt"]) == "doc1"
    assert batch_name(["/in/a.txt", "/in/b.txt", "/in/c.txt"]) == "a_c"
    with pytest.raises(ValueError):
        batch_name([])


@pytest.mark.parametrize("stored", [False, True])
def test_listed_numbers_find_texts_of_equal_numbers(rows, stored):
    df = rows([("5", 5.0), ("5,0", 5.0), ("05", 5.0), (" 5 ", 5.0), ("50", 50.0), (None, None), ("1e1", 10.0)], "x string, " + "__typed_x double")
    df = df if stored else df.select("x")
    types = ColumnTypes({"x": "float"})
    found = lambda listed: sorted(r["x"] for r in select_rows(df, ["x"], {}, {"x": listed}, types).collect())      # noqa: E731
    assert found(["5"]) == sorted(["5", "5,0", "05", " 5 "]) == sorted(r["x"] for r in select_rows(df, ["x"], {"x": [Range("5", "5")]}, {}, types).collect())
    assert found(["10", "abc"]) == ["1e1"] and found(["abc"]) == []
    assert [r["x"] for r in select_rows(df, ["x"], {}, {"x": ["5"]}, ColumnTypes({"x": "string"})).collect()] == ["5"]
