from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.fold import fold_headers
from quayside.functions.paths import safe_segment
from quayside.operators.layout import add_path, assign_files, file_name, manifest, read_dead_letters, route
from quayside.operators.land import keep_tolerated, split_errors
from quayside.options import FileOptions, FoldOptions, LayoutOptions
from quayside.sources.messages import decode_dynamic, decode_typed, with_error


@pytest.mark.parametrize("flush, chunk", [(1, 10), (3, 7), (10, 1), (1000, 50), (50, 1 << 20)])
def test_file_numbers_equal_a_loop_under_skew(spark, flush, chunk):
    """One path holds most records and spans many chunks; offsets have holes."""
    rng = random.Random(3)
    offsets = sorted(rng.sample(range(3000), 900))
    rows = [("t", i % 2, "hot" if i % 10 else f"cold{i % 3}", o, i) for i, o in enumerate(offsets)]
    seen, expected = {}, {}
    for topic, partition, path, offset, _ in rows:
        n = seen.get((partition, path), 0)
        seen[(partition, path)] = n + 1
        expected[(partition, offset)] = (n // flush, n % flush)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "topic string, partition int, path string, offset bigint, x int").withColumn(
        "timestamp", F.lit("2026-01-01 00:00:00").cast("timestamp")
    )
    got = assign_files(df.repartition(5), FileOptions(flush_size=flush, chunk_offsets=chunk))
    assert {(r["partition"], r["offset"]): (r["file_no"], r["line_no"]) for r in got.collect()} == expected


def test_ranking_groups_are_bounded_by_chunk(spark):
    df = spark.range(10).selectExpr("'t' topic", "0 partition", "'p' path", "id AS offset", "timestamp '2026-01-01' AS timestamp")
    plan = assign_files(df, FileOptions())._jdf.queryExecution().executedPlan().toString()
    ranking = next(line for line in plan.splitlines() if "row_number()" in line and "Window" in line)
    assert "__chunk" in ranking.split("row_number()")[1].split("ASC")[0]


def test_records_without_path_are_kept(spark):
    df = spark.createDataFrame(
        [("t", 0, None, i) for i in range(5)], "topic string, partition int, path string, offset bigint"
    ).withColumn("timestamp", F.lit("2026-01-01").cast("timestamp"))
    assert assign_files(df, FileOptions(flush_size=2)).groupBy("path").agg(F.max("file_no")).collect() == [("", 2)]


def test_file_names(spark):
    df = spark.createDataFrame([("card-events", 0, 0), ("p", 12, 123456789012)], "t string, p int, o bigint")
    names = [r[0] for r in df.select(file_name(F.col("t"), F.col("p"), F.col("o"), FileOptions())).collect()]
    assert names == ["card-events+0+0000000000", "p+12+123456789012"]


def test_first_record_decides(spark):
    rows = [("t", 0, "p", o, "B" if o == 3 else None, "R" if o == 3 else "S", "l") for o in (9, 3, 5)]
    df = spark.createDataFrame(
        rows, "topic string, partition int, path string, offset bigint, institution string, event_type string, line string"
    ).withColumn("timestamp", F.lit("2026-01-01").cast("timestamp"))
    row = manifest(assign_files(df, FileOptions()), FileOptions()).first()
    assert (row["institution"], row["event_type"], row["start_offset"], row["end_offset"], row["records"]) == ("B", "R", 3, 9, 3)


FIELDS = ("headers.X-Institution-Id", "headers.X-Event-Type")
FULL = {"X-Institution-Id": "BNK/1", "X-Event-Type": "CHARGE"}


def paths(df, layout, wrap=True):
    folded = fold_headers(decode_dynamic(df), FoldOptions(optional=("X-Institution-Id", "X-Event-Type"), wrap=wrap))
    return [(r["path"], r["error"] and r["error"]["stage"]) for r in add_path(folded, layout).orderBy("offset").collect()]


def test_paths(messages):
    df = messages((FULL, "{}"), ({"X-Event-Type": "P"}, "{}"), (FULL, None), (FULL, "no json"))
    tail = "year=2026/month=02/day=02/hour=14"
    assert paths(df, LayoutOptions(FIELDS)) == [
        (f"headers.X-Institution-Id=BNK%2F1/headers.X-Event-Type=CHARGE/{tail}", None), (None, "partition"),
        (None, "partition"), (None, "decode"),
    ]
    assert paths(df, LayoutOptions(FIELDS, labelled=False).with_defaults())[:2] == [
        (f"BNK%2F1/CHARGE/{tail}", None), (f"UNKNOWN/P/{tail}", None),
    ]
    minute = LayoutOptions(FIELDS, labelled=False, path_format="YYYY/MM/dd/HH/mm", duration_ms=60_000)
    assert paths(df, minute, wrap=False)[0] == ("BNK%2F1/CHARGE/2026/02/02/14/35", None)
    assert paths(df, LayoutOptions((), path_format="'h'=HH"))[0] == ("h=14", None)


def test_path_from_payload_members(messages):
    df = messages(({}, '{"a": {"b": 7}, "c": "x"}'))
    assert paths(df, LayoutOptions(("payload.a.b", "payload.c"), path_format="dd"))[0][0] == "payload.a.b=7/payload.c=x/02"
    typed = decode_typed(df, "a struct<b: int>, c string")
    assert add_path(typed, LayoutOptions(("a.b",), labelled=False, path_format="dd")).first()["path"] == "7/02"


def test_paths_need_utc(spark, messages):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError):
            paths(messages((FULL, "{}")), LayoutOptions(FIELDS))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tolerance(spark, messages):
    decoded = decode_dynamic(messages((FULL, "{}"), (FULL, "bad")))
    assert keep_tolerated(decoded).count() == 1
    with pytest.raises(Exception, match="decode: value is not a JSON object"):
        keep_tolerated(decoded, "none").collect()
    good, bad = split_errors(decoded)
    assert good.count() == 1 and bad.first()["value"] == b"bad"


def test_error_filter_does_not_copy_the_parsing(messages):
    """A filter on the error column stays above the one place where values are parsed."""
    plan = keep_tolerated(decode_dynamic(messages((FULL, "{}"))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_no_timestamp_is_an_error(messages):
    layout = LayoutOptions(("a",))
    df = decode_dynamic(messages(({}, '{"a": "x"}'))).withColumn("timestamp", F.lit(None).cast("timestamp"))
    row = add_path(df, layout).first()
    assert row["path"] is None and row["error"]["stage"] == "partition"


@pytest.mark.parametrize("value, name", [
    ("../up", "%2E.%2Fup"), ("/abs", "%2Fabs"), ("_dead_letter", "%5Fdead_letter"), ("", "%"), ("100%", "100%25"), (".", "%2E"), ("a.b_c", "a.b_c"),
])
def test_values_stay_below_their_folder(spark, value, name):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(safe_segment(F.col("v"))).first()[0] == name


def test_dead_letters_come_back_whole(spark, messages):
    df = messages(([("k", b"\xff\x00".decode("latin-1")), ("k", None)], "broken"), ({}, None))
    df = df.withColumn("value", F.when(F.col("offset") == 0, F.unhex(F.lit("FF007B"))))
    failed = with_error(df.withColumn("path", F.lit("p")).withColumn("record", F.struct(F.lit(1).alias("r"))), "decode", F.lit(True), "bad")
    again = read_dead_letters(route(failed).select(F.col("line").alias("value")))
    names = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType", "headers"]
    assert sorted(map(str, again.select(names).collect())) == sorted(map(str, df.select(names).collect()))
    assert {(r["stage"], r["message"]) for r in again.collect()} == {("decode", "bad")}
