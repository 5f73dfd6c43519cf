from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quayside.functions import rules as R

CASES = [
    ("CHARGE:*:ENCRYPT,REVERSAL:v1:SKIP,*:*:ENCRYPT", "REVERSAL", "v1", False, False),
    ("CHARGE:*:ENCRYPT,REVERSAL:v1:SKIP,*:*:ENCRYPT", "REVERSAL", "v2", True, True),
    ("", "CHARGE", "v1", True, True),
    (None, "CHARGE", "v1", True, True),
    ("CHARGE:v1:ENCRYPT", "CHARGE", "v2", True, False),  # nothing matches
    ("charge:v1:SKIP", "Charge", "v1", False, False),
    ("*:*:SKIP", None, "v1", True, False),  # a record without type is sealed whatever the rules say
    ("*:*:ENCRYPT", None, None, True, True),
    ("CHARGE:*:SKIP,CHARGE:*:ENCRYPT", "CHARGE", "v1", False, False),
    ("INVALID_RULE", "CHARGE", "v1", True, False),
    ("CHARGE : v1 : SKIP , REVERSAL : * : ENCRYPT", "CHARGE", "v1", False, False),
    ("CHARGE:v1:SKIP:extra,*:*:ENCRYPT", "CHARGE", "v1", True, False),  # four parts: ignored / accepted
    ("CHARGE:v1:MAYBE,*:*:ENCRYPT", "CHARGE", "v1", True, False),  # unknown action: ignored / means no
    ("CHARGE:v1:SKIP:,*:*:ENCRYPT", "CHARGE", "v1", False, False),  # an empty last part does not count
]


@pytest.mark.parametrize("level, mode, column", [("record", "lenient", 3), ("file", "file", 4)])
def test_decisions(spark, level, mode, column):
    df = spark.createDataFrame([(i, c[0], c[1], c[2]) for i, c in enumerate(CASES)], "i int, r string, t string, v string")
    df = df.withColumn("parsed", R.rule_array(F.col("r"), mode))
    decided = R.encrypt_decision(F.lit(True), F.col("r"), F.col("parsed"), F.col("t"), F.col("v"), level)
    got = {r["i"]: r["d"] for r in df.select("i", decided.alias("d")).collect()}
    assert got == {i: c[column] for i, c in enumerate(CASES)}
    off = R.encrypt_decision(F.lit(False), F.col("r"), F.col("parsed"), F.col("t"), F.col("v"), level)
    assert {r[0] for r in df.select(off).collect()} == {False}


def test_both_parsers_agree(spark):
    texts = [c[0] for c in CASES if c[0]] + ["A:B:C:MASK,:x:y:remove", "a:b:c:d:mask", "::: , x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for mode in ("lenient", "file"):
        for row in df.select("t", R.rule_array(F.col("t"), mode).alias("rules")).collect():
            here = [(tuple(r["patterns"]), r["outcome"]) for r in row["rules"] if r["valid"]]
            assert here == [(r.patterns, r.outcome) for r in R.parse(row["t"], mode)]
    accepted = R.parse(":x:y:remove")
    assert accepted[0].patterns == ("", "x", "y")


def test_lookup_joins_equal_the_case_chain(spark):
    """The same random rules through both ways, and against a loop."""
    rng = random.Random(7)
    words = ["A", "b", "C", "*"]
    listed = [
        R.Rule(n + 1, tuple(rng.choice(words) for _ in range(3)), rng.choice(["MASK", "REMOVE", "NONE"])) for n in range(90)
    ]
    listed = [r for r in listed if r.patterns != ("*", "*", "*")]
    rows = [tuple(rng.choice(["a", "B", "c", "D", None]) for _ in range(3)) + (i,) for i in range(300)]
    df = spark.createDataFrame(rows, "x string, y string, z string, i int")

    def expected(row):
        for rule in listed:
            if all(p == "*" or (v is not None and p.lower() == v.lower()) for p, v in zip(rule.patterns, row)):
                return rule.number
        return None

    joined = R.match_rules(df, listed, ["x", "y", "z"])
    assert joined.count() == len(rows)
    chain = df.withColumn("matched", R.first_match(listed, [F.col(c) for c in "xyz"]))
    for frame in (joined, chain):
        got = {r["i"]: r["n"] for r in frame.select("i", F.col("matched.rule_no").alias("n")).collect()}
        assert got == {r[3]: expected(r) for r in rows}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
