from __future__ import annotations

import random

from quayside.operators.audit import offset_faults, offset_islands
from pyspark.sql import functions as F


def test_islands_over_chunks(spark):
    rng = random.Random(3)
    offsets = sorted(rng.sample(range(1_000), 700))
    rows = [("t", 0, o) for o in offsets] + [("t", 0, o) for o in offsets[:50:7]] + [("t", 1, 5), (None, 1, 5), ("t", 0, None)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint").repartition(5)
    got = sorted((r["first"], r["last"], r["records"]) for r in offset_islands(df, chunk=16).where("topic = 't' AND partition = 0").collect())
    want, twice = [], set(offsets[:50:7])
    for o in offsets:
        n = 1 + (o in twice)
        if want and want[-1][1] == o - 1:
            want[-1] = (want[-1][0], o, want[-1][2] + n)
        else:
            want.append((o, o, n))
    assert got == want
    faults = offset_faults(offset_islands(df, chunk=16)).where("topic = 't' AND partition = 0").collect()
    missing = {x for r in faults if r["kind"] == "missing" for x in range(r["first"], r["last"] + 1)}
    assert missing == set(range(offsets[0], offsets[-1] + 1)) - set(offsets)
    assert sum(r["records"] for r in faults if r["kind"] == "repeated") == len(twice)


def test_overlapping_batches(spark):
    rows = [("t", 0, o, b) for b, span in enumerate([(0, 50), (40, 60), (45, 48), (70, 80)]) for o in range(*span)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, batch int")
    faults = {(r["kind"], r["first"], r["last"]) for r in offset_faults(offset_islands(df, F.col("batch"), chunk=7)).collect()}
    assert faults == {("overlap", 40, 49), ("overlap", 45, 47), ("missing", 60, 69)}
    assert offset_faults(offset_islands(df.limit(0), F.col("batch"))).count() == 0
