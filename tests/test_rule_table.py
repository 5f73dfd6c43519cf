from __future__ import annotations

import random

from pyspark.sql import functions as F

from quayside.functions.rule_table import match_rule_table, policy_rules
from quayside.functions.rules import CASE_RULES, Rule, first_match, match_rules, parse
from quayside.plans import catalog, sample

FIELDS = ["institution", "event_type", "event_version"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_rules(rng, count):
    values = [["A", "b", "C", "d%", "-", "="], ["x", "Y", "z"], ["1", "2"]]
    out = []
    for number in range(1, count + 1):
        parts = tuple("*" if rng.random() < 0.3 else rng.choice(v) for v in values)
        out.append(Rule(number * 3, parts, rng.choice(["MASK", "REMOVE"])))
    return out


def test_a_table_equals_the_chain(spark):
    rng = random.Random(1)
    pool = [["a", "B", "c", "D%", "-", "=", "*", "", None, "q"], ["X", "y", None, "*"], ["1", "3", None]]
    rows = [(i, *(rng.choice(v) for v in pool)) for i in range(600)]
    df = spark.createDataFrame(rows, f"id int, {', '.join(f'{f} string' for f in FIELDS)}")
    for count in (1, 5, 25):
        rules = random_rules(rng, count)
        table = spark.createDataFrame([(r.number, *r.patterns, r.outcome) for r in rules], f"rule_no int, {', '.join(f'{f} string' for f in FIELDS)}, outcome string")
        got = match_rule_table(df, table, FIELDS).select("id", "matched.*")
        want = df.select("id", first_match(rules, [F.col(f) for f in FIELDS]).alias("m")).select("id", "m.*")
        assert sorted(got.collect()) == sorted(want.collect(), key=lambda r: r[0]) or sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_own_lists(spark):
    """A row follows the list of exactly its own tenant; a row without tenant follows none."""
    rules = spark.createDataFrame(
        [("t1", 1, "*", "MASK"), ("t1", 2, "X", "NONE"), ("t2", 1, "x", "REMOVE"), ("t2", 2, None, "MASK")], "tenant string, rule_no int, kind string, outcome string")
    df = spark.createDataFrame([("t1", "x"), ("t2", "X"), ("t2", "y"), ("T1", "x"), (None, "x"), ("t1", None), ("t2", None)], "tenant string, kind string")
    got = match_rule_table(df, rules, ["kind"], scope=F.col("tenant"), rule_scope="tenant")
    assert got.columns == ["tenant", "kind", "matched"]
    assert {(r[0], r[1]): r[2] and tuple(r[2]) for r in got.collect()} == {
        ("t1", "x"): (1, "MASK"), ("t2", "X"): (1, "REMOVE"), ("t2", "y"): None, ("T1", "x"): None, (None, "x"): None, ("t1", None): (1, "MASK"), ("t2", None): None}


def test_no_rules_and_no_rows(spark):
    rules = spark.createDataFrame([], "rule_no int, kind string, outcome string")
    df = spark.createDataFrame([("x",), (None,)], "kind string")
    assert [r["matched"] for r in match_rule_table(df, rules, ["kind"]).collect()] == [None, None]
    assert match_rule_table(df.limit(0), rules, ["kind"]).count() == 0


def test_rows_never_meet_rules_pairwise(spark):
    rules = spark.range(20_000).selectExpr("cast(id AS int) AS rule_no", "concat('T', id % 5000) AS a", "CASE id % 3 WHEN 0 THEN '*' ELSE 'v' END AS b", "'MASK' AS outcome")
    df = spark.range(1_000).selectExpr("concat('t', id) AS a", "'V' AS b")
    done = match_rule_table(df, rules, ["a", "b"])
    assert "NestedLoop" not in plan(done) and "Cartesian" not in plan(done)
    assert done.where("matched IS NULL").count() == 0


def test_rules_of_the_policies(spark):
    listed = {(r["bank"], r["rule_no"], r["event_type"], r["event_version"], r["outcome"]) for r in policy_rules(sample.policy(spark), "lenient").collect()}
    assert ("BIRCH", 2, "reversal", "*", "ENCRYPT") in listed and ("MAPLE", 3, "*", "*", "SKIP") in listed and len(listed) == 6


def test_many_rules_run_as_joins(spark, sf_dir):
    """The registered query has more rules than a CASE chain holds, in every shape, and runs one join for each shape."""
    rules = parse(catalog.MANY_RULES)
    shapes = {tuple(p == "*" for p in r.patterns) for r in rules}
    assert len(rules) >= 67 > CASE_RULES and len(shapes) == 8
    done = match_rules(sample.messages(spark, sf_dir), rules, FIELDS)
    assert plan(done).count("BroadcastHashJoin") >= 7 and "NestedLoop" not in plan(done)
