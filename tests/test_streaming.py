from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from quayside.operators.land import land_lines
from quayside.operators.layout import route
from quayside.operators.reports import message_rate, observed
from quayside.options import FileOptions
from quayside.plans import catalog, sample
from quayside.session import shared_dir
from quayside.sources.messages import decode_dynamic, read_record_files
from quayside.streaming.landing import land_batch, latest_rates, stream_files, stream_lines, stream_rates


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """Records in several files, so that a stream takes several micro-batches."""
    folder = shared_dir(spark, "records")
    sample.records(spark, sf_dir).repartitionByRange(4, "offset").write.parquet(folder)
    return folder


def prepare(df):
    return catalog.sealing_chain()(decode_dynamic(df))


def contents(root):
    return {
        os.path.relpath(os.path.join(folder, n), root) for folder, _, names in os.walk(root) for n in names
        if n.endswith((".json", ".pgp"))
    }


def test_files_from_stream(spark, ring, stored):
    files = FileOptions(flush_size=10_000)
    policy = sample.policy(spark)
    root, checkpoint = shared_dir(spark, "s"), shared_dir(spark, "c")
    source = read_record_files(spark, stored, files_per_trigger=1)
    run = stream_files(source, prepare, root, checkpoint, files, policy, ring, stage=True)
    run.awaitTermination()
    manifests = spark.read.option("basePath", f"{root}/_manifest").parquet(f"{root}/_manifest")
    assert manifests.select("batch").distinct().count() == 4
    total = manifests.agg(F.sum("records")).first()[0]
    assert total == read_record_files(spark, stored, stream=False).count()
    before = contents(root)
    assert len(before) == manifests.count()
    # A replay of everything under a new checkpoint gives the same names: nothing is duplicated.
    again = stream_files(
        read_record_files(spark, stored, files_per_trigger=1), prepare, root, shared_dir(spark, "c"), files, policy, ring
    )
    again.awaitTermination()
    assert contents(root) == before
    # A restart with the same checkpoint has nothing left to do.
    stream_files(
        read_record_files(spark, stored, files_per_trigger=1), prepare, root, checkpoint, files, policy, ring
    ).awaitTermination()
    assert spark.read.parquet(f"{root}/_manifest").count() == len(before)


def test_batch_equals_one_big_stream_batch(spark, ring, stored):
    files, policy = FileOptions(flush_size=10), sample.policy(spark)
    roots = [shared_dir(spark, "a"), shared_dir(spark, "b")]
    land_batch(
        prepare(read_record_files(spark, stored, stream=False)), roots[0], f"{roots[0]}/_manifest", files, policy, ring
    )
    stream_files(
        read_record_files(spark, stored), prepare, roots[1], shared_dir(spark, "c"), files, policy, ring
    ).awaitTermination()
    assert contents(roots[0]) == contents(roots[1])


def test_lines_from_stream_equal_batch(spark, stored):
    roots = [shared_dir(spark, "lines"), shared_dir(spark, "streamed")]
    land_lines(route(prepare(read_record_files(spark, stored, stream=False))), roots[0], catalog._lanes())
    stream_lines(
        read_record_files(spark, stored, files_per_trigger=2), prepare, roots[1], shared_dir(spark, "c"), catalog._lanes()
    ).awaitTermination()
    one = spark.read.text(roots[0]).select("lane", "part", "value")
    two = spark.read.text(roots[1]).select("lane", "part", "value")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_rates_over_batches(spark, stored):
    root = shared_dir(spark, "rates")
    stream_rates(
        read_record_files(spark, stored, files_per_trigger=1), "timestamp", root, shared_dir(spark, "c"), "1 day",
    ).awaitTermination()
    live = {tuple(r) for r in latest_rates(spark.read.parquet(root)).collect()}
    batch = {tuple(r) for r in message_rate(read_record_files(spark, stored, stream=False), "timestamp", "1 day").collect()}
    assert live == batch and len(batch) > 1


def test_counters(spark, stored):
    from pyspark.sql import Observation

    seen = Observation("landing")
    df = prepare(read_record_files(spark, stored, stream=False))
    observed(df, seen).write.format("noop").mode("overwrite").save()
    assert seen.get["records"] == df.count()
    assert seen.get["errors"] == df.where("error IS NOT NULL").count()
    assert seen.get["mask"] == df.where("strategy = 'MASK'").count()


def test_timed_trigger_lands_and_stops(spark, ring, stored):
    root = shared_dir(spark, "timed")
    run = stream_files(
        read_record_files(spark, stored), prepare, root, shared_dir(spark, "c"), FileOptions(flush_size=10_000),
        sample.policy(spark), ring, every_ms=200,
    )
    try:
        run.processAllAvailable()
        total = spark.read.parquet(f"{root}/_manifest").agg(F.sum("records")).first()[0]
        assert total == read_record_files(spark, stored, stream=False).count()
    finally:
        run.stop()
