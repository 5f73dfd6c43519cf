from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quayside.functions.headers import header
from quayside.operators.fold import fold_headers
from quayside.options import FoldOptions, csv_names
from quayside.sources.messages import decode_dynamic, decode_typed

VALUE = '{"transactionId": "TXN-1", "amount": 5.0, "headers": "old"}'
MANDATORY = ("X-Institution-Id", "X-Event-Type")
ALL = {"X-Institution-Id": "ALDER", "X-Event-Type": "CHARGE", "X-User-Id": "u", "X-Other": "no"}


def folded(df, typed=None, **options):
    options = {"mandatory": MANDATORY, "optional": ("X-User-Id",), **options}
    decoded = decode_typed(df, typed) if typed else decode_dynamic(df)
    row = fold_headers(decoded, FoldOptions(**options)).select(F.to_json("record").alias("j"), "error").first()
    return json.loads(row["j"]) if row["j"] else None, row["error"]


def test_inline_overwrites_the_target(messages):
    got, error = folded(messages((ALL, VALUE)))
    assert error is None and got["transactionId"] == "TXN-1"
    assert got["headers"] == {"X-Institution-Id": "ALDER", "X-Event-Type": "CHARGE", "X-User-Id": "u"}


def test_optional_may_be_missing(messages):
    got, error = folded(messages(({k: ALL[k] for k in MANDATORY}, VALUE)), target_field="meta")
    assert error is None and "X-User-Id" not in got["meta"] and got["headers"] == "old"


@pytest.mark.parametrize("headers", [{"X-Institution-Id": "B"}, {"X-Institution-Id": "B", "X-Event-Type": None}])
def test_missing_mandatory(messages, headers):
    _, error = folded(messages((headers, VALUE)))
    assert error["stage"] == "headers" and "X-Event-Type" in error["message"]
    got, error = folded(messages((headers, VALUE)), fail_on_missing=False)
    assert error is None and got["headers"] == {"X-Institution-Id": "B"}


def test_missing_value_is_never_an_error(messages):
    assert folded(messages(({}, None))) == (None, None)
    assert folded(messages(({}, None)), wrap=True) == (None, None)


def test_wrap_has_exactly_two_members(messages):
    got, _ = folded(messages((ALL, VALUE)), wrap=True, target_field="h", payload_field="p")
    assert set(got) == {"h", "p"} and got["p"]["headers"] == "old"


def test_typed_records(messages):
    schema = "transactionId string, amount double"
    got, _ = folded(messages((ALL, VALUE)), typed=schema)
    assert got["headers"]["X-Institution-Id"] == "ALDER" and got["amount"] == 5.0
    got, _ = folded(messages((ALL, VALUE)), typed=schema, wrap=True)
    assert got["payload"] == {"transactionId": "TXN-1", "amount": 5.0}


REPEATED = [
    [("h", None), ("h", "1"), ("h", "2"), ("h", None)], [("h", "1"), ("h", "2")], [("H", "x")], [], [("h", None)],
]


@pytest.mark.parametrize("pick, expected", [
    ("first", [None, "1", None, None, None]),
    ("first_non_null", ["1", "1", None, None, None]),
    ("last_non_null", ["2", "2", None, None, None]),
])
def test_repeated_headers(messages, pick, expected):
    df = messages(*[(h, VALUE) for h in REPEATED]).orderBy("offset")
    assert [r[0] for r in df.select(header(F.col("headers"), "h", pick)).collect()] == expected


def test_invalid_utf8_is_replaced(spark):
    df = spark.sql("SELECT array(named_struct('key', 'h', 'value', X'41FF')) AS headers")
    assert df.select(header(F.col("headers"), "h")).first()[0] == "A�"


def test_name_lists():
    assert csv_names(" a, b ,,a ") == ("a", "b") and csv_names(None) == ()
