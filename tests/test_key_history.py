from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.session import small_side
from quayside.sources import lookups
from quayside.sources.lookups import attach_key_as_of, key_periods, partner_key_history

KEYS = "id string, public_key string, key_id string, enabled boolean, valid_from timestamp, valid_to timestamp"
START = datetime(2026, 1, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def holder(keys, tenant, moment):
    """Of the keys valid at the moment the one that began last, of equal ones that with the larger name."""
    fit = [(since if since is not None else -10**9, name) for id_, name, enabled, since, until in keys
           if id_ == tenant and enabled and name is not None and (since is None or since <= moment) and (until is None or moment < until)]
    return max(fit)[1] if fit else None


def frame(spark, keys):
    return spark.createDataFrame([(i, n, None, e, at(a), at(b)) for i, n, e, a, b in keys], KEYS)


@pytest.mark.parametrize("seed, bucket", [(1, 86_400), (2, 3_600), (3, 10_000_000)])
def test_keys_equal_a_loop(spark, monkeypatch, seed, bucket):
    """Periods that overlap, begin together, end early, are empty or open; a hot tenant over many buckets."""
    rng = random.Random(seed)
    keys = []
    for n in range(120):
        since = rng.choice([None, *range(0, 400, 7)]) if n % 9 == 0 else rng.randrange(0, 400)
        until = None if rng.random() < 0.05 else (since or 0) + rng.choice([-3, 0, 1, 5, 30, 200])
        keys.append((rng.choice(["hot", "cold", "gone"]), f"k{rng.randrange(60)}", rng.random() < 0.9, since, until))
    records = [(i, rng.choice(["hot", "hot", "hot", "cold", "none", None]), rng.choice([None, *(x / 2 for x in range(-20, 900))])) for i in range(500)]
    df = spark.createDataFrame([(i, t, at(h), "own") for i, t, h in records], "n int, tenant string, moment timestamp, since string").repartition(4)
    if seed == 2:
        monkeypatch.setattr(lookups, "small_side", lambda side, rows: small_side(side, rows, 0))  # the shuffled side
    got = attach_key_as_of(df, F.col("tenant"), frame(spark, keys), "key", F.col("moment"), bucket_seconds=bucket)
    assert got.columns == ["n", "tenant", "moment", "since", "key", "error"]
    found = {r["n"]: (r["key"], r["error"] and r["error"]["stage"]) for r in got.collect()}
    assert len(found) == len(records)
    for n, tenant, hours in records:
        key = holder(keys, tenant, hours) if hours is not None else None
        assert found[n] == (key, None if key else "key"), (tenant, hours)


def test_periods_do_not_overlap(spark):
    keys = [("a", "old", True, None, None), ("a", "new", True, 10, 20), ("a", "newer", True, 10, 12), ("a", "off", False, 11, 30), ("b", "x", True, 5, 5)]
    hour = 3_600_000_000
    base = int(START.timestamp()) * 1_000_000
    rows = sorted((r["since"], r["until"], r["public_key"]) for r in key_periods(frame(spark, keys)).collect())
    shown = [((s - base) // hour if abs(s) < 1 << 60 else None, (u - base) // hour if abs(u) < 1 << 60 else None, k) for s, u, k in rows]
    assert shown == [(None, 10, "old"), (10, 12, "newer"), (12, 20, "new"), (20, None, "old")]


def test_needed_rows_and_empty_histories(spark):
    df = spark.createDataFrame([("a", at(1)), ("b", at(1))], "tenant string, moment timestamp")
    none = attach_key_as_of(df, F.col("tenant"), frame(spark, []), "key", F.col("moment"), needed=F.col("tenant") == "a")
    assert {r["tenant"]: r["error"] is not None for r in none.collect()} == {"a": True, "b": False}
    assert attach_key_as_of(df.limit(0), F.col("tenant"), frame(spark, []), "key", F.col("moment")).count() == 0


def test_history_documents(spark):
    text = """{"keys": {"A": [{"publicKeyPath": "k1", "validTo": "2026-01-02T00:00:00Z"}, {"publicKeyPath": "k2", "validFrom": "2026-01-02T00:00:00Z", "enabled": true}],
        "B": [{"publicKeyPath": "k3", "enabled": false}]}}"""
    keys = partner_key_history(spark, text)
    df = spark.createDataFrame([("A", at(23)), ("A", at(24)), ("B", at(1))], "tenant string, moment timestamp")
    got = attach_key_as_of(df, F.col("tenant"), keys, "key", F.col("moment"))
    assert [r["key"] for r in got.orderBy("tenant", "moment").collect()] == ["k1", "k2", None]
