from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from quayside.operators.commits import commits, committed_files, landed_lines
from quayside.operators.layout import assign_files, manifest, route
from quayside.options import FileOptions
from quayside.plans import catalog, sample
from quayside.session import shared_dir
from quayside.sources.messages import KAFKA_SCHEMA, decode_dynamic, read_record_files
from quayside.streaming import open_files
from quayside.streaming.open_files import land_open_files, still_open, stream_open_files


def prepare(df):
    return catalog.open_chain()(decode_dynamic(df))


def state_of(spark, root):
    files = {(r["path"], r["name"]): r["records"] for r in committed_files(spark, root).collect()}
    return files, sorted(tuple(r) for r in landed_lines(spark, root).collect())


def expected(spark, sf_dir, options):
    lines = route(prepare(sample.records(spark, sf_dir)))
    files = manifest(assign_files(lines, options), options)
    return {(r["path"], f"{r['name']}.json"): r["records"] for r in files.collect()}


@pytest.fixture(scope="module")
def delivered(spark, sf_dir):
    """A folder with records in five files in offset order."""
    folder = shared_dir(spark, "delivered")
    flat = sample.messages(spark, sf_dir)
    size = flat.count()
    for part in range(5):
        sample.as_records(flat.where(F.floor(F.col("record_offset") * 5 / size) == part)).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_files_are_those_of_one_batch_even_after_a_kill(spark, sf_dir, delivered, monkeypatch):
    """Rolling by count and by record time, five micro-batches; the third dies after its files are written, before its commit."""
    options = FileOptions(flush_size=40, rotate_ms=3 * 86_400_000, rotate_exact=True, chunk_offsets=256, frame_bytes=512)
    root, checkpoint = shared_dir(spark, "open"), shared_dir(spark, "checkpoint")
    whole = open_files.land_committed
    seen = []

    def dying(frames, place, batch, roots=None):
        seen.append(batch)
        if seen.count(2) == 1 and batch == 2:
            open_files.land_committed = whole
            from quayside.operators.land import write_files

            write_files(frames, place).collect()
            raise RuntimeError("killed")
        whole(frames, place, batch, roots)

    monkeypatch.setattr(open_files, "land_committed", dying)
    source = read_record_files(spark, delivered, files_per_trigger=1)
    with pytest.raises(Exception, match="killed"):
        stream_open_files(source, prepare, root, checkpoint, options).awaitTermination()
    assert commits(spark, root).count() == 2
    monkeypatch.setattr(open_files, "land_committed", whole)
    source = read_record_files(spark, delivered, files_per_trigger=1)
    stream_open_files(source, prepare, root, checkpoint, options).awaitTermination()
    want = expected(spark, sf_dir, options)
    closed, _ = state_of(spark, root)
    assert set(closed.items()) <= set(want.items()) and 0 < len(closed) < len(want)
    left = {(r["path"], r["start_offset"], r["records"]) for r in still_open(spark, checkpoint).collect()}
    assert len(left) == len(want) - len(closed)
    land_open_files(spark, root, checkpoint, options)
    files, lines = state_of(spark, root)
    assert files == want and len(lines) == sample.records(spark, sf_dir).count()


def records(spark, offsets, folder):
    rows = [(b"k", b'{"a": 1}', "t", 0, o, None, 0, [("X-Institution-Id", b"A")]) for o in offsets]
    moment = "timestamp '2026-01-01' + make_interval(0, 0, 0, 0, 0, 0, offset)"
    df = spark.createDataFrame(rows, KAFKA_SCHEMA).withColumn("timestamp", F.expr(moment))
    df.coalesce(1).write.mode("append").parquet(folder)


def test_open_files_go_on_in_the_next_run(spark):
    """Landed as it is, an open file is replaced by the longer one of the same name when it closes."""
    folder, root, checkpoint = shared_dir(spark, "in"), shared_dir(spark, "open"), shared_dir(spark, "checkpoint")
    options = FileOptions(flush_size=10)
    sizes = []
    for offsets in (range(0, 4), range(4, 7), range(7, 25)):
        records(spark, offsets, folder)
        stream_open_files(read_record_files(spark, folder), prepare, root, checkpoint, options).awaitTermination()
        land_open_files(spark, root, checkpoint, options)
        files, lines = state_of(spark, root)
        sizes.append(sorted(files.values()))
        assert len(lines) == offsets[-1] + 1
    assert sizes == [[4], [7], [5, 10, 10]]


def test_files_close_by_the_clock(spark):
    folder, root, checkpoint = shared_dir(spark, "in"), shared_dir(spark, "open"), shared_dir(spark, "checkpoint")
    records(spark, range(3), folder)
    run = stream_open_files(read_record_files(spark, folder), prepare, root, checkpoint, FileOptions(), every_ms=500, schedule_ms=2_000)
    try:
        for _ in range(120):
            if commits(spark, root).agg(F.sum("files")).first()[0]:
                break
            time.sleep(0.5)
    finally:
        run.stop()
    files, lines = state_of(spark, root)
    assert list(files.values()) == [3] and len(lines) == 3
