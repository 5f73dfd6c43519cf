"""Protection of single records: each strategy, each record shape, each way to choose."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quayside.functions import tokens
from quayside.functions.rules import parse
from quayside.operators.fold import fold_headers
from quayside.operators.protect import Crypto, protect
from quayside.options import FoldOptions, ProtectOptions
from quayside.plans import sample
from quayside.sources.lookups import partner_keys
from quayside.sources.messages import decode_dynamic, decode_typed
from quayside.sources.policy import policy_from_text

PAN = "9101015112830366"
SOURCE = "encryptedPrimaryAccountNumber"


def value(**members):
    return json.dumps({"transactionId": "TXN-1", "amount": 10.5, **members})


def result(df):
    rows = df.select(F.to_json("record", {"ignoreNullFields": "false"}).alias("j"), "error").collect()
    return [(json.loads(r["j"]) if r["j"] else None, r["error"]["stage"] if r["error"] else None) for r in rows]


def run(df, **options):
    return result(protect(decode_dynamic(df), ProtectOptions(**options)))


def test_remove_drops_only_the_field(messages):
    assert run(messages(({}, value(**{SOURCE: PAN})))) == [({"transactionId": "TXN-1", "amount": 10.5}, None)]


def test_absent_field_and_missing_value_pass_unchanged(messages):
    got = run(messages(({}, value()), ({}, None)), default_strategy="MASK")
    assert got == [({"transactionId": "TXN-1", "amount": 10.5}, None), (None, None)]


@pytest.mark.parametrize("pan, masked", [
    (PAN, "910101******0366"), ("930345455400126", "930345*****0126"), ("1234567890", "1234567890"), ("", ""),
    ("a.b.c.d.e", "****************"), ("a.b.c.d.e..", "****************"), ("a.b.c.d", "a.b.c.d"), (None, None),
    ("12345678901", "123456*8901"),
])
def test_mask(messages, pan, masked):
    got, error = run(messages(({}, value(pan=pan))), strategy="mask", source_field="pan", target_field="maskedPan")[0]
    assert error is None and got["maskedPan"] == masked and "pan" not in got


def test_mask_settings(messages):
    got = run(
        messages(({}, value(pan=PAN))), default_strategy="MASK", source_field="pan", target_field="pan",
        mask_character="#!", mask_prefix=4, mask_suffix=2,
    )
    assert got[0][0]["pan"] == "9101##########66"


def test_rules_first_match_then_default(messages):
    rows = [
        ({"X-Institution-Id": "alder", "X-Event-Type": "Charge", "X-Event-Version": "1.0"}, value(**{SOURCE: PAN})),
        ({"X-Institution-Id": "BIRCH"}, value(**{SOURCE: PAN})),
        ({"X-Institution-Id": "HAZEL"}, value(**{SOURCE: PAN})),
        ({}, value(**{SOURCE: PAN})),
    ]
    got = run(messages(*rows), rules="ALDER:CHARGE:*:MASK, BIRCH:*:*:REMOVE ,", default_strategy="NONE")
    assert got[0][0]["primaryAccountNumber"] == "910101******0366"
    assert SOURCE not in got[1][0] and "primaryAccountNumber" not in got[1][0]
    assert got[2][0][SOURCE] == PAN and got[3][0][SOURCE] == PAN


@pytest.mark.parametrize("text", ["ALDER:*:MASK", "a:b:c:d:e", "A:B:C:ENCODE", "A:B:C"])
def test_malformed_rules_are_refused(text):
    with pytest.raises(ValueError):
        parse(text)


def test_unknown_default_strategy_is_refused():
    with pytest.raises(ValueError):
        ProtectOptions(default_strategy="HIDE")


def test_number_in_place_of_text_is_an_error(messages):
    got = run(messages(({}, value(**{SOURCE: 42})), ({}, value(**{SOURCE: {"a": 1}}))), default_strategy="MASK")
    assert [e for _, e in got] == ["protect", "protect"]


def test_existing_target_is_overwritten(messages):
    got = run(messages(({}, value(**{SOURCE: PAN, "primaryAccountNumber": "old"}))), default_strategy="MASK")
    assert got[0][0]["primaryAccountNumber"] == "910101******0366"


@pytest.mark.parametrize("wrong", ["not json", "[1,2]", '"text"', '{"a":'])
def test_undecodable_values_are_errors(messages, wrong):
    assert run(messages(({}, wrong)))[0] == (None, "decode")
    typed = decode_typed(messages(({}, wrong)), "transactionId string")
    assert typed.select("error.stage").first()[0] == "decode"


SCHEMA = f"transactionId string, amount double, {SOURCE} string"


def typed(df, **options):
    return protect(decode_typed(df, SCHEMA), ProtectOptions(**options))


def test_typed_remove_for_all_rows_drops_the_column(messages):
    got = typed(messages(({}, value(**{SOURCE: PAN}))))
    assert got.schema["record"].dataType.fieldNames() == ["transactionId", "amount"]


def test_typed_mixed_strategies_leave_null(messages):
    rows = [({"X-Institution-Id": i}, value(**{SOURCE: PAN})) for i in ("A", "B", "C")] + [({}, None)]
    got = typed(messages(*rows), rules="A:*:*:MASK,B:*:*:NONE", default_strategy="REMOVE")
    records = [r[0] for r in got.select("record").collect()]
    assert [r and (r[SOURCE], r["primaryAccountNumber"]) for r in records] == [
        (None, "910101******0366"), (PAN, None), (None, None), None,
    ]


def test_typed_same_source_and_target(messages):
    rows = [({"X-Institution-Id": i}, value(**{SOURCE: PAN})) for i in ("A", "B", "C")]
    got = typed(messages(*rows), rules="A:*:*:MASK,B:*:*:REMOVE", default_strategy="NONE", target_field=SOURCE)
    assert [r[0][SOURCE] for r in got.select("record").collect()] == ["910101******0366", None, PAN]


def test_protect_inside_a_wrapped_record(messages):
    wrapped = fold_headers(
        decode_dynamic(messages(({"X-Event-Id": "1"}, value(**{SOURCE: PAN})))),
        FoldOptions(optional=("X-Event-Id",), wrap=True),
    )
    got = result(protect(wrapped, ProtectOptions(default_strategy="MASK", source_field=f"payload.{SOURCE}")))
    assert got[0][0]["headers"] == {"X-Event-Id": "1"}
    assert got[0][0]["payload"]["primaryAccountNumber"] == "910101******0366" and SOURCE not in got[0][0]["payload"]


def test_decrypt_without_keys_is_an_error(messages):
    assert run(messages(({}, value(**{SOURCE: "a.b.c.d.e"}))), default_strategy="DECRYPT")[0][1] == "protect"


def test_decrypting_plan_has_no_python_step_unless_needed(messages):
    plan = protect(decode_dynamic(messages(({}, value()))), ProtectOptions(default_strategy="MASK"))
    assert "ArrowEvalPython" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def token(spark, ring):
    one = spark.createDataFrame([(PAN,)], "pan string")
    return tokens.encrypt_text(one, F.col("pan"), F.lit("keys/private"), ring, "t").first()["t"]


def test_the_manual_scenarios(spark, ring, messages, token):
    """Remove, decrypt, re-encrypt, none, tokenize, unknown tenant, broken tokens."""
    policy = policy_from_text(spark, """{"banks": {
        "A": {"pan_strategy": "REMOVE"},
        "B": {"pan_strategy": "DECRYPT", "pan_config": {"private_key_path": "keys/private"}},
        "C": {"pan_strategy": "REKEY", "pan_config": {"private_key_path": "keys/private",
              "target_field": "encryptedPrimaryAccountNumber"}},
        "D": {"pan_strategy": "NONE"},
        "E": {"pan_strategy": "decrypt", "pan_config": {"private_key_path": "keys/private", "tokenize": true,
              "target_field": "tokenizedPAN"}},
        "F": {"pan_strategy": "REKEY", "pan_config": {"private_key_path": "keys/private"}},
        "G": {"pan_strategy": "SHRED"}},
        "default": {"pan_strategy": "MASK"}}""")
    crypto = Crypto(ring, partner_keys(spark, '{"C": "keys/partner-3", "A": "keys/partner-1"}'))
    broken = token[:-6] + ("A" if token[-6] != "A" else "B") + token[-5:]
    rows = [({"X-Institution-Id": i}, value(**{SOURCE: v})) for i, v in [
        ("A", token), ("B", token), ("C", token), ("D", PAN), ("E", token), ("UNKNOWN", PAN), ("B", PAN), ("B", broken),
        ("B", None), ("F", token), ("G", token),
    ]]
    done = protect(decode_dynamic(messages(*rows)), ProtectOptions(), policy, crypto).orderBy("offset")
    got = result(done)
    assert [e for _, e in got] == [None] * 6 + ["jwe", "jwe", "jwe", "key", "policy"]
    assert SOURCE not in got[0][0]
    assert got[1][0]["primaryAccountNumber"] == PAN and SOURCE not in got[1][0]
    assert got[3][0][SOURCE] == PAN
    assert got[4][0]["tokenizedPAN"] == "TOK-910101******0366"
    assert got[5][0]["primaryAccountNumber"] == "910101******0366"
    moved = spark.createDataFrame([(got[2][0][SOURCE],)], "t string")
    opened = tokens.decrypt_text(moved, F.col("t"), F.lit("keys/partner-3"), ring, "p").first()
    assert opened["p"] == PAN and opened["t"] != token
    messages_shown = [r[0] for r in done.select("error.message").collect() if r[0]]
    assert not any(PAN in m or token in m for m in messages_shown)
    assert sample.KEY_IDS[0] not in json.dumps(got[1][0])
