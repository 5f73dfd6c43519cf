from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from quayside.operators.layout import add_path, add_tenant_layout, route, template_folder
from quayside.options import LayoutOptions
from quayside.plans import sample
from quayside.plans.chain import Connector
from quayside.session import shared_dir
from quayside.sources import record_log
from quayside.sources.messages import decode_dynamic
from quayside.sources.policy import policy_from_text
from quayside.sources.record_log import append_records, read_index, read_records


def test_bounded_positions():
    start, end = {"t": {"0": 0, "1": 50}}, {"t": {"0": 900, "1": 60, "2": 5}}
    near = record_log.bounded(start, end, 100)
    assert 0 < near["t"]["0"] <= 100 and 50 < near["t"]["1"] <= 60 and near["t"]["2"] == 1
    assert record_log.bounded(start, end, None) == end == record_log.bounded(start, end, 10_000)
    # Progress everywhere, and the end in the end.
    at, steps = start, 0
    while at != end:
        at, steps = record_log.bounded(at, end, 100), steps + 1
    assert steps < 20
    # An index that lost files never leads back.
    assert record_log.bounded({"t": {"0": 7}}, {"t": {"0": 3}}, 5) == {"t": {"0": 7}}


def test_log_as_a_batch(spark, sf_dir):
    log = shared_dir(spark, "log")
    records = sample.records(spark, sf_dir)
    append_records(records.where("offset < 600"), log, 100)
    append_records(records.where("offset >= 600"), log, 100)
    files = read_index(record_log.shared_root(spark, log))
    spans = sorted((r["partition"], r["first"], r["last"]) for r in files)
    assert len(files) >= 10 and all(a[0] < b[0] or a[2] < b[1] for a, b in zip(spans, spans[1:], strict=False))
    back = read_records(spark, log, stream=False)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in spark.read.schema(record_log.KAFKA_SCHEMA).parquet(f"{log}/data").drop("append").schema]
    assert back.exceptAll(records).isEmpty() and records.exceptAll(back).isEmpty()
    given = read_records(spark, log, json.dumps({"card-events": {"0": 500, "1": -1}}), stream=False)
    assert given.where("partition = 1 OR offset < 500").isEmpty() and given.count() == records.where("partition = 0 AND offset >= 500").count()
    assert read_records(spark, log, "latest", stream=False).isEmpty()
    with pytest.raises(Exception, match="resume|checkpoint"):
        spark.readStream.format(record_log.FORMAT).option("path", log).option("maxOffsetsPerTrigger", "5").load().writeStream.format("noop").start().awaitTermination()


def test_small_files_share_tasks(spark, sf_dir):
    """A task writes and reads many small files; a piece beyond a task's share is a task of its own, and none is lost."""
    log = shared_dir(spark, "log")
    records = sample.records(spark, sf_dir)
    append_records(records, log, 20)
    root = record_log.shared_root(spark, log)
    files = read_index(root)
    assert len({r["file"] for r in files}) >= 50 and len({r["file"].split("-")[1] for r in files}) == 1
    back = read_records(spark, log, stream=False)
    assert back.rdd.getNumPartitions() == 1
    assert back.exceptAll(records).isEmpty() and records.exceptAll(back).isEmpty()
    found = [record_log._Piece(f"f{n}", "t", n % 2, n, n + size) for n, size in enumerate((30, 30, 500, 30, 30, 30, 100))]
    dealt = record_log.shares(found, 100)
    assert sorted((p for s in dealt for p in s.pieces), key=lambda p: p.start) == found
    assert all(len(s.pieces) == 1 or sum(p.end - p.start for p in s.pieces) <= 100 for s in dealt) and len(dealt) < len(found)
    assert record_log.shares([]) == []


def test_bounded_reading_goes_on_after_a_restart(spark, sf_dir):
    """Every record once, in micro-batches of at most the bound, over several runs of one query."""
    log, checkpoint, root = shared_dir(spark, "log"), shared_dir(spark, "checkpoint"), shared_dir(spark, "out")
    records = sample.records(spark, sf_dir)
    append_records(records.where("offset < 700"), log, 200)

    def run():
        def write(batch, batch_id):
            batch.select("partition", "offset").write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

        source = read_records(spark, log, max_per_trigger=120, checkpoint=checkpoint)
        query = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()

    run()
    assert spark.read.parquet(root).count() == 700
    append_records(records.where("offset >= 700"), log, 200)
    run()
    run()
    got = spark.read.parquet(root)
    assert got.count() == records.count() == got.select("partition", "offset").distinct().count()
    assert got.groupBy("batch").count().agg(F.max("count")).first()[0] <= 122


def test_streams_find_the_package_from_any_folder(tmp_path):
    """The processes that plan a stream's source beside the driver import the package, wherever the job was started."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    job = f"""if True:
        import sys
        sys.path.insert(0, {home!r})
        from quayside.session import local_session
        from quayside.sources.messages import KAFKA_SCHEMA
        from quayside.sources.record_log import append_records, read_records
        spark = local_session("elsewhere", 2, spark__sql__shuffle__partitions="2")
        rows = [(b"k", b"v", "t", 0, n, None, 0, []) for n in range(7)]
        append_records(spark.createDataFrame(rows, KAFKA_SCHEMA), "log")
        query = read_records(spark, "log").writeStream.format("memory").queryName("got").trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
        print("offsets", sorted(r["offset"] for r in spark.table("got").collect()))
        """
    kept = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "PYSPARK_", "SPARK_"))}
    done = subprocess.run([sys.executable, "-c", job], cwd=tmp_path, env=kept, capture_output=True, text=True, timeout=300)
    assert f"offsets {list(range(7))}" in done.stdout, done.stderr[-3000:]


def test_templates(messages):
    df = decode_dynamic(messages(({"X": "y"}, '{"a": {"b": "p/q"}}'), ({}, '{"a": {}}')))
    made = df.select(
        template_folder(df, "x/{{yyyy}}-{{MM}}/{{topic}}/p{{partition}}/{{a.b}}/{{topic}}.json").alias("one"), template_folder(df, "/plain/").alias("two"),
        template_folder(df, "{{yyyyMMdd}}/f").alias("three"), template_folder(df, "name.json").alias("four"))
    assert [tuple(r) for r in made.collect()] == [
        ("x/2026-02/card-events/p0/p%2Fq", "plain", "20260202", ""), (None, "plain", "20260202", "")]


def test_layouts_of_tenants(spark, messages):
    policy = policy_from_text(spark, """{"banks": {"A": {"s3_config": {"bucket": "b1", "object_key_template": "{{kind}}/{{HH}}/"}}, "B": {"s3_config": {"path_prefix": "only"}},
        "C": {}}, "default": {"s3_config": {"bucket": "b2", "object_key_template": "rest/{{yyyy}}/"}}}""")
    df = decode_dynamic(messages(({}, '{"t": "A", "kind": "x"}'), ({}, '{"t": "A"}'), ({}, '{"t": "B"}'), ({}, '{"t": "C"}'), ({}, '{"t": "Z"}'), ({}, None), ({}, "{")))
    tenant = F.try_variant_get(F.try_element_at("record", F.lit("t")), "$", "string")
    placed = add_tenant_layout(df, policy, tenant, LayoutOptions((), path_format="'d'dd"))
    rows = [(r["path"], r["error"] and r["error"]["stage"]) for r in placed.orderBy("offset").collect()]
    assert rows == [("b1/x/14", None), (None, "partition"), ("only/d02", None), ("d02", None), ("b2/rest/2026", None), (None, "partition"), (None, "decode")]
    assert policy.templates() == ["rest/{{yyyy}}/", "{{kind}}/{{HH}}/"]


def test_roots_reach_the_stream(spark, sf_dir):
    config = {
        "topics": "card-events", "partition.field.name": "headers.X-Institution-Id", "partition.field.format.path": "false", "path.format": "'all'",
        "errors.tolerance": "all", "transforms": "extract", "transforms.extract.type": "fold", "transforms.extract.wrap.payload": "true",
        "transforms.extract.optional.headers": "X-Institution-Id",
    }
    base = shared_dir(spark, "roots")
    for keep_open in (False, True):
        root = f"{base}/{keep_open}"
        source = sample.ordered_deliveries(spark, sf_dir, 2)
        connector = Connector.from_config(config | {"flush.size": "20"})
        connector.run(source, root, f"{root}-checkpoint", roots={"CEDAR": f"{root}-cedar"}, keep_open=keep_open).awaitTermination()
        cedar = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(f"{root}-cedar")
        assert cedar.count() >= 100 and cedar.where("value LIKE '%CEDAR%'").count() == cedar.count()
        other = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root)
        assert other.where("value LIKE '%\"CEDAR\"%' AND value LIKE '%payload%'").isEmpty()


def test_plain_strings(messages):
    df = decode_dynamic(messages(({}, '"a b"'), ({}, '""'), ({}, '{"a": 1}'), ({}, "17"), ({}, None), ({}, '["x"]')), plain_strings=True)
    lines = route(add_path(df, LayoutOptions((), path_format="'d'dd"))).orderBy("offset").collect()
    assert [r["line"] for r in lines[:3]] == ["a b", "", '{"a":1}'] and [r["path"] for r in lines[:3]] == ["d02"] * 3
    assert [r["error"]["stage"] for r in lines[3:]] == ["decode", "partition", "decode"]
    named = add_path(df, LayoutOptions(("a",), path_format="'d'dd"))
    assert [r["error"] and r["error"]["stage"] for r in named.orderBy("offset").collect()][:3] == ["partition", "partition", None]
