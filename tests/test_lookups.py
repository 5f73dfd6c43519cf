from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quayside.functions.hashing import kafka_partition, murmur2
from quayside.plans import sample
from quayside.sources.lookups import attach_key, partition_map, partner_keys, read_partition_map, tenant_partitions
from quayside.sources.messages import topic_options
from quayside.sources.policy import policy_from_text, read_policy, unmapped


def test_published_hash_values(spark):
    vectors = {
        "21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536,
        "a-little-bit-longer-string": -1486304829, "abc": 479470107,
    }
    df = spark.createDataFrame([(k,) for k in vectors], "k string")
    got = {r[0]: r[1] - (1 << 32) if r[1] >= 1 << 31 else r[1] for r in df.select("k", murmur2(F.col("k"))).collect()}
    assert got == vectors
    banks = spark.createDataFrame([("LARCH",), ("MAPLE",), ("ROWAN",), ("FIR",), ("",)], "b string")
    places = {r[0]: r[1] for r in banks.select("b", kafka_partition(F.col("b"), 20)).collect()}
    assert (places["LARCH"], places["MAPLE"], places["ROWAN"], places["FIR"]) == (15, 11, 13, 11)


def test_policy_falls_back_as_a_whole(spark):
    policy = policy_from_text(spark, """{"banks": {"A": {"name": "only a name"}, "a": {"pan_strategy": "none"}},
        "default": {"pan_strategy": "MASK", "pgp_encryption": {"enabled": true, "rules": "*:*:SKIP"}, "s3_config": {"bucket": "b"}}}""")
    df = spark.createDataFrame([("A",), ("a",), ("Z",), (None,)], "t string")
    rows = [r["policy"] for r in policy.attach(df, F.col("t")).collect()]
    assert [r["bank"] for r in rows] == ["A", "a", "DEFAULT", "DEFAULT"]
    # A listed tenant inherits nothing, and the lookup is case-sensitive.
    assert (rows[0]["strategy"], rows[0]["enc_enabled"], rows[0]["bucket"]) == ("REMOVE", False, None)
    assert rows[1]["strategy"] == "NONE" and rows[2]["enc_enabled"] is True and rows[2]["armor"] is False
    assert policy.strategies() == {"REMOVE", "NONE", "MASK"}


def test_missing_policy_file_means_the_built_in_default(spark, tmp_path):
    policy = read_policy(spark, str(tmp_path / "absent.json"))
    assert policy.rows == 0 and policy.fallback["strategy"] == "REMOVE" and policy.fallback["enc_enabled"] is False
    (tmp_path / "p.json").write_text(sample.POLICY_TEXT)
    assert read_policy(spark, str(tmp_path / "p.json")).rows == 6
    (tmp_path / "bad.json").write_text("[1, 2]")
    with pytest.raises(ValueError):
        read_policy(spark, str(tmp_path / "bad.json"))


def test_large_policies_are_not_broadcast(spark):
    from dataclasses import replace

    policy = replace(sample.policy(spark), rows=10**6)
    df = spark.createDataFrame([("LARCH",)], "t string")
    assert "strategy=broadcast" not in policy.attach(df, F.col("t"))._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in sample.policy(spark).attach(df, F.col("t"))._jdf.queryExecution().logical().toString()


def test_partner_keys_in_both_forms(spark):
    nested = partner_keys(spark, sample.PARTNER_TEXT)
    flat = partner_keys(spark, '{"A": "/keys/a.pem", "B": "/keys/b.pem"}')
    assert nested.count() == 4 and {r["id"]: r["public_key"] for r in flat.collect()} == {"A": "/keys/a.pem", "B": "/keys/b.pem"}
    df = spark.createDataFrame([("ALDER",), ("BIRCH",), ("LARCH",), ("X",), ("",), (None,)], "t string")
    rows = attach_key(df, F.col("t"), nested, "k", F.lit("2024-01-15").cast("timestamp")).collect()
    assert {r["t"]: (r["k"], r["error"] and r["error"]["stage"]) for r in rows} == {
        "ALDER": ("keys/partner-1", None), "BIRCH": (None, "key"), "LARCH": ("keys/partner-1", None), "X": (None, "key"),
        "": (None, "key"), None: (None, "key"),
    }


def test_partition_map(spark, tmp_path):
    (tmp_path / "map.csv").write_text(sample.PARTITION_MAP)
    table = read_partition_map(spark, str(tmp_path / "map.csv"))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, partition_map(spark, sample.PARTITION_MAP).collect()))
    df = spark.createDataFrame([("DOGWOOD",), ("LARCH",), ("LARCH",), (None,)], "t string")
    rows = {r["tenant"]: (r["partition"], r["listed"], r["records"]) for r in tenant_partitions(df, F.col("t"), table, 20).collect()}
    assert rows == {"DOGWOOD": (3, True, 1), "LARCH": (15, False, 2)}


def test_unmapped(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "t string")
    known = spark.createDataFrame([("A",)], "bank string")
    assert {tuple(r) for r in unmapped(df, F.col("t"), known, "bank").collect()} == {("B", 2), (None, 1)}


def test_topic_options():
    assert topic_options("h:1", "card-events", "latest", 500, 40, {"failOnDataLoss": "false"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "card-events", "startingOffsets": "latest", "includeHeaders": "true",
        "maxOffsetsPerTrigger": "500", "minPartitions": "40", "failOnDataLoss": "false",
    }
