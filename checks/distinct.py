"""Distinct rows, keys and values; consistency of rules and valid combinations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.functions.cells import as_text, key_set_name
from plumbline.operators.consistency import (Rule, consistency_attribute, consistency_value, rule_set,
                                             with_association)
from plumbline.operators.distinctness import (DISTINCTNESS_SCHEMA, VALUES_SCHEMA, distinct_values,
                                              distinctness_attribute, distinctness_global, distinctness_in_two_steps,
                                              distinctness_update, new_values, population_attribute)
from plumbline.plans.lookup import Lookup, flag_known
from plumbline.plans.summary import summarise

from .registry import query, r6, rounded, sql_key, table, union, work_folder

SPLIT = "2024-01-16 00:00:00"
VALUE_COLUMNS = ["event_type", "user_id", "props"]


def _distinct_sql(columns, source):
    columns = ", ".join(columns)
    return f"""
WITH g AS (SELECT count(*) AS n FROM {source} GROUP BY {columns})
SELECT {r6("greatest(0.0, 1 - coalesce(sum(CASE WHEN n > 2 THEN n / 2.0 END), 0.0) / sum(n))")} AS "Distinctness",
       {r6("count(*) / CAST(sum(n) AS DOUBLE)")} AS "DistinctRatio" FROM g"""


@query("distinctness_global", _distinct_sql(["l_orderkey", "l_linenumber"], "lineitem"))
def repeated_lines(spark, sf_dir):
    return rounded(distinctness_global(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("distinctness_global_digest", _distinct_sql(["lang", "text"], "documents"))
def repeated_documents(spark, sf_dir):
    return rounded(distinctness_global(table(spark, sf_dir, "documents"), ["lang", "text"], digest=True))


# Hashes first, then only rows whose hash repeats: by a broadcast, and by digests where the repeated hashes are taken for too many
@query("distinctness_two_steps", _distinct_sql(["l_orderkey", "l_linenumber"], "lineitem"))
def repeated_lines_by_hash(spark, sf_dir):
    return rounded(distinctness_in_two_steps(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], work_folder(spark)))


@query("distinctness_two_steps_texts", _distinct_sql(["lang", "text"], "documents"))
def repeated_documents_by_hash(spark, sf_dir):
    return rounded(distinctness_in_two_steps(table(spark, sf_dir, "documents"), ["lang", "text"], work_folder(spark), broadcast_hashes=0))


# Zeros of both signs are one value, by digest as by row
@query("distinctness_digest_zeros", _distinct_sql(["z", "l_returnflag"], """(SELECT l_returnflag,
    CASE WHEN l_linenumber % 2 = 0 THEN 0.0 ELSE l_discount END AS z FROM lineitem)"""))
def zeros_of_both_signs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.when(F.col("l_linenumber") % 4 == 0, F.lit(-0.0))
                                                    .when(F.col("l_linenumber") % 2 == 0, F.lit(0.0)).otherwise(F.col("l_discount")).alias("z"))
    return rounded(distinctness_global(lines, ["z", "l_returnflag"], digest=True))


# The same inside arrays and structs
@query("distinctness_digest_nested", _distinct_sql(["z", "l_returnflag"], """(SELECT l_returnflag,
    CASE WHEN l_linenumber % 2 = 0 THEN 0.0 ELSE l_discount END AS z FROM lineitem)"""))
def nested_zeros_of_both_signs(spark, sf_dir):
    zero = F.when(F.col("l_linenumber") % 4 == 0, F.lit(-0.0)).when(F.col("l_linenumber") % 2 == 0, F.lit(0.0)).otherwise(F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.array(zero, F.lit(None)).alias("list"), F.struct(zero.alias("x"), F.array(zero).alias("y")).alias("pair"))
    return rounded(distinctness_global(lines, ["list", "pair", "l_returnflag"], digest=True))


DISTINCT_KEYS = [["l_orderkey"], ["l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus"]]


@query("distinctness_attribute", union([f"""
SELECT '{key_set_name(k)}' AS key_set, count(*) AS "DistinctCount",
       {r6("count(*) / CAST(sum(n) AS DOUBLE)")} AS "Distinctness", CAST(1.0 AS DOUBLE) AS "Confidence"
FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(k)})""" for k in DISTINCT_KEYS]))
def distinct_keys(spark, sf_dir):
    summary = summarise(table(spark, sf_dir, "lineitem"), [], DISTINCT_KEYS)
    return rounded(distinctness_attribute(summary, DISTINCT_KEYS, 1.0))


def _halves(spark, sf_dir):
    events, split = table(spark, sf_dir, "events"), F.lit(SPLIT).cast("timestamp_ntz")
    return events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)


def _source_distinctness(spark, sf_dir):
    """The state after two batches: the events before the split, then those after it."""
    first, second = _halves(spark, sf_dir)
    rows = [half.agg(F.count(F.lit(1)).alias("rows")) for half in (first, second)]
    stored = new_values(first, VALUE_COLUMNS, spark.createDataFrame([], VALUES_SCHEMA))
    before = distinctness_update(rows[0], VALUE_COLUMNS, stored, spark.createDataFrame([], DISTINCTNESS_SCHEMA))
    return distinctness_update(rows[1], VALUE_COLUMNS, new_values(second, VALUE_COLUMNS, stored), before)


@query("distinctness_incremental", union([f"""
SELECT '{c}' AS "Attribute", count(DISTINCT {c}) AS "Count", count(*) AS "TotalRows",
       {r6(f"count(DISTINCT {c}) / CAST(count(*) AS DOUBLE)")} AS "DistinctnessValue" FROM events""" for c in VALUE_COLUMNS]))
def distinctness_incremental(spark, sf_dir):
    return rounded(_source_distinctness(spark, sf_dir))


@query("distinct_values_new", union([f"""
SELECT DISTINCT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value FROM events
WHERE ts >= TIMESTAMP '{SPLIT}' AND {c} NOT IN (SELECT {c} FROM events WHERE ts < TIMESTAMP '{SPLIT}')"""
                                     for c in VALUE_COLUMNS + ["value"]]))
def values_new_in_second_half(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    columns = VALUE_COLUMNS + ["value"]
    return new_values(second, columns, distinct_values(first, columns))


@query("population_attribute", union([f"""
SELECT '{c}' AS key_set, count(DISTINCT CASE WHEN ts >= TIMESTAMP '{SPLIT}' THEN {c} END) AS "DistinctCount",
       {r6(f"least(1.0, count(DISTINCT CASE WHEN ts >= TIMESTAMP '{SPLIT}' THEN {c} END) / CAST(count(DISTINCT {c}) AS DOUBLE))")}
       AS "CompletenessPopulationValue", CAST(1.0 AS DOUBLE) AS "Confidence" FROM events""" for c in VALUE_COLUMNS]))
def population(spark, sf_dir):
    keys = [[c] for c in VALUE_COLUMNS]
    _, second = _halves(spark, sf_dir)
    return rounded(population_attribute(summarise(second, [], keys), keys, _source_distinctness(spark, sf_dir), 1.0))


# Rules

RULES = [Rule(("l_returnflag",), ("l_linestatus",)), Rule(("l_linestatus",), ("l_returnflag",)),
         Rule(("l_partkey",), ("l_suppkey",)), Rule(("l_returnflag", "l_linenumber"), ("l_linestatus", "l_quantity"))]


def _rule_sql(rule):
    left, right = ", ".join(rule.antecedent), ", ".join(rule.consequent)
    return f"""
SELECT '{rule.left}' AS a, '{rule.right}' AS c, {sql_key(rule.antecedent)} AS v, max(n) / CAST(sum(n) AS DOUBLE) AS score
FROM (SELECT {left}, count(*) AS n FROM lineitem GROUP BY {left}, {right}) GROUP BY {left}"""


RULE_VALUES = "WITH v AS (" + union(map(_rule_sql, RULES)) + ")"


@query("consistency_value", f"""{RULE_VALUES}
SELECT a AS "RuleAntecedent", c AS "RuleConsequent", v AS "AntecedentValue", {r6("score")} AS "ConsistencyValue",
       a || ' -> ' || c AS "Rule" FROM v""")
def rules_by_value(spark, sf_dir):
    return rounded(consistency_value(table(spark, sf_dir, "lineitem"), RULES))


@query("consistency_attribute", f"""{RULE_VALUES}
SELECT a AS "RuleAntecedent", c AS "RuleConsequent", {r6("avg(score)")} AS "ConsistencyValue",
       CAST(1.0 AS DOUBLE) AS "Confidence" FROM v GROUP BY a, c""")
def rules_mean(spark, sf_dir):
    return rounded(consistency_attribute(consistency_value(table(spark, sf_dir, "lineitem"), RULES)))


# Stored rules and one extra rule; a rule on a column that is not selected is left out by itself
@query("consistency_rule_set", f"""{RULE_VALUES}
SELECT a AS "RuleAntecedent", c AS "RuleConsequent", {r6("avg(score)")} AS "ConsistencyValue",
       CAST(1.0 AS DOUBLE) AS "Confidence" FROM v WHERE a IN ('l_returnflag', 'l_partkey') GROUP BY a, c""")
def rules_of_selection(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_partkey", "l_suppkey")
    stored = spark.createDataFrame([(RULES[0].left, RULES[0].right), ("l_returnflag", "l_shipmode")],
                                   "Antecedent string, Consequent string")
    return rounded(consistency_attribute(consistency_value(rows, rule_set(stored, [RULES[2]], rows.columns))))


# 287 rules between seven columns: every one or two columns towards each other one, and every three too. 35 sets of four columns count them all.
MANY = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_suppkey"]
MANY_RULES = [Rule(left, (right,)) for n in (1, 2, 3) for left in combinations(MANY, n) for right in MANY if right not in left]


def _many_sql():
    narrow = {frozenset(r.columns): ", ".join(c for c in MANY if c in r.columns) for r in MANY_RULES}
    name = {columns: f"s{i}" for i, columns in enumerate(narrow)}
    counts = [f"{name[c]} AS MATERIALIZED (SELECT {by}, count(*) AS n FROM lineitem GROUP BY {by})" for c, by in narrow.items()]
    means = [f"""SELECT '{r.left}' AS "RuleAntecedent", '{r.right}' AS "RuleConsequent", {r6("avg(score)")} AS "ConsistencyValue", CAST(1.0 AS DOUBLE) AS "Confidence"
FROM (SELECT max(n) / CAST(sum(n) AS DOUBLE) AS score FROM {name[frozenset(r.columns)]} GROUP BY {", ".join(r.antecedent)})""" for r in MANY_RULES]
    return "WITH " + ",\n".join(counts) + "\n" + union(means)


@query("consistency_many_rules", _many_sql())
def many_rules(spark, sf_dir):
    return rounded(consistency_attribute(consistency_value(table(spark, sf_dir, "lineitem"), MANY_RULES)))


# Valid combinations: nations with the region they belong to, where the region's key is below 4, and segments
# that start with the letters up to F

HOMES = "SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, n.n_regionkey FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"


@query("association_tuple", f"""
WITH homes AS ({HOMES})
SELECT c_custkey, {r6('''(CASE WHEN EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = homes.c_nationkey
                                           AND n.n_regionkey = homes.n_regionkey AND n.n_regionkey < 4) THEN 1 ELSE 0 END
  + CASE WHEN c_mktsegment < 'G' THEN 1 ELSE 0 END) / 2.0''')} AS "ASSOCIATION_CONSISTENCY" FROM homes""")
def valid_combinations(spark, sf_dir):
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    homes = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
             .select("c_custkey", "c_nationkey", "c_mktsegment", "n_regionkey"))
    regions = nation.filter("n_regionkey < 4").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    segments = customer.select("c_mktsegment").filter("c_mktsegment < 'G'")
    return rounded(with_association(homes, [regions, segments]).select("c_custkey", "ASSOCIATION_CONSISTENCY"))


# Three lists that are taken for too long to broadcast
@query("association_many_lists", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {r6("""(
    CASE WHEN EXISTS (SELECT 1 FROM lineitem e WHERE e.l_returnflag = l.l_returnflag AND e.l_quantity = l.l_quantity AND e.l_shipdate < TIMESTAMP '1992-03-01 00:00:00') THEN 1 ELSE 0 END
  + CASE WHEN l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) THEN 1 ELSE 0 END
  + CASE WHEN l_returnflag || l_linestatus IN (SELECT l_returnflag || l_linestatus FROM lineitem WHERE l_shipdate < TIMESTAMP '1992-03-01 00:00:00') THEN 1 ELSE 0 END) / 3.0""")}
  AS "ASSOCIATION_CONSISTENCY" FROM lineitem l""")
def many_lists(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    early = lineitem.filter(F.col("l_shipdate") < F.lit("1992-03-01 00:00:00").cast("timestamp_ntz"))
    lists = [early.select("l_returnflag", "l_quantity"), lineitem.filter("l_quantity > 45").select("l_partkey"), early.select("l_returnflag", "l_linestatus")]
    return rounded(with_association(lineitem, lists, broadcast_bytes=0).select("l_orderkey", "l_linenumber", "ASSOCIATION_CONSISTENCY"))


# A list that is taken for too long to broadcast: flags with quantities of lines shipped before March 1992; few flags hold all rows
@query("association_long_list", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, EXISTS (
    SELECT 1 FROM lineitem e WHERE e.l_returnflag = l.l_returnflag AND e.l_quantity = l.l_quantity
    AND e.l_shipdate < TIMESTAMP '1992-03-01 00:00:00') AS known FROM lineitem l""")
def long_list(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    keys = ["l_returnflag", "l_quantity"]
    known = (lineitem.filter(F.col("l_shipdate") < F.lit("1992-03-01 00:00:00").cast("timestamp_ntz"))
             .select(*[as_text(k).alias(k) for k in keys]))
    flagged = flag_known(lineitem, [Lookup({k: as_text(k) for k in keys}, known, "known")], broadcast_bytes=0)
    return flagged.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "known")
