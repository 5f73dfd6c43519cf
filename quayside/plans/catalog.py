"""The registered queries: every operator run over whole tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import headers as H
from quayside.functions import masking, tokens
from quayside.functions.paths import field_segment, nested, time_segment
from quayside.functions.rule_table import match_rule_table
from quayside.functions.rules import encrypt_decision, match_rules, parse, rule_array
from quayside.operators import bulk, reports
from quayside.operators.audit import offset_faults, offset_islands
from quayside.operators.commits import (
    LOG, committed_files, land_committed, landed_lines, remove_uncommitted, uncommitted_files,
)
from quayside.operators.fold import fold_headers
from quayside.operators.land import keep_tolerated, land_lines, split_errors
from quayside.operators.layout import (
    add_path, add_tenant_layout, add_tenant_prefix, assign_files, json_line, manifest, read_dead_letters, route,
)
from quayside.operators.protect import Crypto, choose_by_rules, protect
from quayside.operators.seal import file_frames, seal_frames, seal_records, unseal
from quayside.options import FileOptions, FoldOptions, LayoutOptions, ProtectOptions
from quayside.plans import sample
from quayside.plans.chain import Chain, Connector, fold_step, path_step, protect_step
from quayside.session import shared_dir
from quayside.sources.lookups import attach_key, attach_key_as_of, partition_map, partner_keys, tenant_partitions
from quayside.sources.messages import decode_dynamic, decode_typed
from quayside.sources.policy import policy_from_text, unmapped
from quayside.sources.record_log import append_records, read_records
from quayside.streaming.landing import (
    land_batch, latest_counts, latest_rates, stream_counts, stream_files, stream_lines, stream_rates,
)
from quayside.streaming.open_files import land_open_files, stream_open_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return function

    return register


# ---------------------------------------------------------------- shared SQL

MESSAGES = f"""messages AS ({sample.BASE_SQL.strip().replace('{events}', 'events')}),
msg AS (SELECT *,
  CASE WHEN institution IS NULL OR header_case = 'stale' THEN NULL ELSE institution END AS inst_first,
  CASE WHEN institution IS NOT NULL AND header_case = 'stale' THEN 'STALE' ELSE institution END AS inst_some,
  (pan IS NOT NULL AND instr(pan, '.') > 0
     AND len(string_split(regexp_replace(pan, '[.]+$', ''), '.')) = 5) AS is_token
  FROM messages)"""

MASKED = """CASE WHEN is_token THEN '****************' WHEN length(pan) <= 10 THEN pan
  ELSE substr(pan, 1, 6) || repeat('*', length(pan) - 10) || right(pan, 4) END"""

RULES = "ALDER:*:*:MASK,MAPLE:CHARGE:*:NONE, *:*:4.0:remove ,ROWAN:sweep:*:REMOVE"


def strategy_sql(institution: str) -> str:
    return f"""CASE WHEN {institution} = 'ALDER' THEN 'MASK' WHEN {institution} = 'MAPLE' AND event_type = 'CHARGE' THEN 'NONE'
  WHEN event_version = '4.0' THEN 'REMOVE' WHEN {institution} = 'ROWAN' AND event_type = 'SWEEP' THEN 'REMOVE'
  ELSE 'MASK' END"""


PROTECT = ProtectOptions(rules=RULES, default_strategy="MASK")
SHARP = FileOptions(flush_size=10, chunk_offsets=512, frame_bytes=256)


def member(record: Column, name: str) -> Column:
    return F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", "string")


# ---------------------------------------------------------------- protection

PROTECTED = f"""WITH {MESSAGES}, chosen AS (SELECT *, {strategy_sql('inst_first')} AS strategy FROM msg)
SELECT record_offset, strategy,
  CASE WHEN value_case = 'broken' THEN 'decode'
       WHEN value_case = 'number' AND strategy = 'MASK' THEN 'protect' END AS error_stage,
  CASE WHEN value_case = 'text' AND strategy = 'MASK' THEN {MASKED} END AS target,
  CASE WHEN value_case = 'number' AND strategy <> 'REMOVE' THEN '42'
       WHEN value_case = 'text' AND strategy = 'NONE' THEN pan END AS source
FROM chosen"""


@query("protect_mask", PROTECTED)
def protect_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = protect(decode_dynamic(sample.records(spark, sf_dir)), PROTECT)
    return done.select(
        F.col("offset").alias("record_offset"), "strategy", F.col("error.stage").alias("error_stage"),
        member(F.col("record"), "primaryAccountNumber").alias("target"),
        member(F.col("record"), "encryptedPrimaryAccountNumber").alias("source"),
    )


@query("protect_typed", f"""WITH {MESSAGES}, chosen AS (SELECT *, {strategy_sql('inst_first')} AS strategy FROM msg)
SELECT record_offset, strategy, CASE WHEN value_case = 'broken' THEN 'decode' END AS error_stage,
  CASE WHEN strategy = 'MASK' THEN CASE value_case WHEN 'text' THEN {MASKED} WHEN 'number' THEN '42' END END AS target,
  CASE WHEN strategy = 'NONE' THEN CASE value_case WHEN 'text' THEN pan WHEN 'number' THEN '42' END END AS source,
  CASE WHEN value_case NOT IN ('null', 'broken') THEN amount END AS amount
FROM chosen""")
def protect_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a schema a JSON number read into a string field is text, so it is masked like one."""
    done = protect(decode_typed(sample.records(spark, sf_dir), sample.PAYLOAD_SCHEMA), PROTECT)
    return done.select(
        F.col("offset").alias("record_offset"), "strategy", F.col("error.stage").alias("error_stage"),
        F.col("record.primaryAccountNumber").alias("target"),
        F.col("record.encryptedPrimaryAccountNumber").alias("source"), F.col("record.amount").alias("amount"),
    )


# More rules than a CASE chain should hold, in every wildcard shape; several match the same message.
MANY_RULES = """
ALDER:CHARGE:3.0:MASK,ALDER:CHARGE:3.1:REMOVE,ALDER:REVERSAL:3.0:REMOVE,ALDER:REVERSAL:3.1:NONE,ALDER:Sweep:3.0:NONE,
ALDER:Sweep:3.1:MASK,ALDER:CASHOUT:3.0:MASK,*:TOPUP:3.1:NONE,ALDER:CASHOUT:3.1:REMOVE,ALDER:TOPUP:3.0:REMOVE,
BIRCH:CHARGE:3.0:REMOVE,BIRCH:CHARGE:3.1:NONE,BIRCH:REVERSAL:3.0:NONE,BIRCH:REVERSAL:3.1:MASK,BIRCH:Sweep:3.0:MASK,
BIRCH:Sweep:3.1:REMOVE,BIRCH:CASHOUT:3.0:REMOVE,cedar:CHARGE:3.0:NONE,cedar:CHARGE:3.1:MASK,cedar:REVERSAL:3.0:MASK,
MAPLE:*:3.0:REMOVE,cedar:REVERSAL:3.1:REMOVE,cedar:Sweep:3.0:REMOVE,cedar:Sweep:3.1:NONE,LARCH:CHARGE:3.0:MASK,
LARCH:REVERSAL:3.0:REMOVE,LARCH:Sweep:3.1:MASK,LARCH:TOPUP:3.0:REMOVE,MAPLE:CHARGE:3.1:NONE,MAPLE:REVERSAL:3.1:MASK,
MAPLE:CASHOUT:3.1:REMOVE,ROWAN:CHARGE:3.0:NONE,ROWAN:CHARGE:3.1:MASK,ROWAN:REVERSAL:3.0:MASK,ROWAN:Sweep:3.0:REMOVE,
ROWAN:TOPUP:3.0:MASK,ROWAN:TOPUP:3.1:REMOVE,*:reversal:*:MASK,LARCH:*:*:NONE,*:*:3.1:REMOVE,ROWAN:CASHOUT:*:REMOVE,
*:CHARGE:4.0:NONE,
ALDER:*:4.0:NONE,BIRCH:TOPUP:*:MASK,cedar:*:4.0:REMOVE,MAPLE:TOPUP:*:NONE,*:cashout:4.0:REMOVE,BIRCH:Charge:4.0:MASK,
BIRCH:*:4.0:NONE,BIRCH:CASHOUT:3.1:MASK,BIRCH:TOPUP:3.0:REMOVE,cedar:CASHOUT:3.0:MASK,cedar:CASHOUT:3.1:NONE,
cedar:TOPUP:3.0:REMOVE,cedar:TOPUP:3.1:MASK,LARCH:CHARGE:3.1:REMOVE,LARCH:CASHOUT:3.0:NONE,MAPLE:CHARGE:4.0:MASK,
MAPLE:Sweep:4.0:REMOVE,MAPLE:*:*:MASK,ROWAN:CHARGE:4.0:REMOVE,ROWAN:Sweep:*:NONE,ROWAN:*:3.0:REMOVE,
ROWAN:TOPUP:4.0:MASK,cedar:*:*:NONE,*:TOPUP:*:REMOVE,*:sweep:4.0:MASK,ALDER:CASHOUT:*:NONE,*:*:4.0:MASK,
STALE:*:*:REMOVE,BIRCH:*:*:REMOVE,*:*:*:NONE"""
# The same list for DuckDB, written out: rule number, tenant, type, version, outcome.
MANY_RULES_SQL = """
(1, 'ALDER', 'CHARGE', '3.0', 'MASK'), (2, 'ALDER', 'CHARGE', '3.1', 'REMOVE'),
(3, 'ALDER', 'REVERSAL', '3.0', 'REMOVE'), (4, 'ALDER', 'REVERSAL', '3.1', 'NONE'),
(5, 'ALDER', 'Sweep', '3.0', 'NONE'), (6, 'ALDER', 'Sweep', '3.1', 'MASK'),
(7, 'ALDER', 'CASHOUT', '3.0', 'MASK'), (8, '*', 'TOPUP', '3.1', 'NONE'),
(9, 'ALDER', 'CASHOUT', '3.1', 'REMOVE'), (10, 'ALDER', 'TOPUP', '3.0', 'REMOVE'),
(11, 'BIRCH', 'CHARGE', '3.0', 'REMOVE'), (12, 'BIRCH', 'CHARGE', '3.1', 'NONE'),
(13, 'BIRCH', 'REVERSAL', '3.0', 'NONE'), (14, 'BIRCH', 'REVERSAL', '3.1', 'MASK'),
(15, 'BIRCH', 'Sweep', '3.0', 'MASK'), (16, 'BIRCH', 'Sweep', '3.1', 'REMOVE'),
(17, 'BIRCH', 'CASHOUT', '3.0', 'REMOVE'), (18, 'cedar', 'CHARGE', '3.0', 'NONE'),
(19, 'cedar', 'CHARGE', '3.1', 'MASK'), (20, 'cedar', 'REVERSAL', '3.0', 'MASK'), (21, 'MAPLE', '*', '3.0', 'REMOVE'),
(22, 'cedar', 'REVERSAL', '3.1', 'REMOVE'), (23, 'cedar', 'Sweep', '3.0', 'REMOVE'),
(24, 'cedar', 'Sweep', '3.1', 'NONE'), (25, 'LARCH', 'CHARGE', '3.0', 'MASK'),
(26, 'LARCH', 'REVERSAL', '3.0', 'REMOVE'), (27, 'LARCH', 'Sweep', '3.1', 'MASK'),
(28, 'LARCH', 'TOPUP', '3.0', 'REMOVE'), (29, 'MAPLE', 'CHARGE', '3.1', 'NONE'), (30, 'MAPLE', 'REVERSAL', '3.1', 'MASK'),
(31, 'MAPLE', 'CASHOUT', '3.1', 'REMOVE'), (32, 'ROWAN', 'CHARGE', '3.0', 'NONE'),
(33, 'ROWAN', 'CHARGE', '3.1', 'MASK'), (34, 'ROWAN', 'REVERSAL', '3.0', 'MASK'),
(35, 'ROWAN', 'Sweep', '3.0', 'REMOVE'), (36, 'ROWAN', 'TOPUP', '3.0', 'MASK'),
(37, 'ROWAN', 'TOPUP', '3.1', 'REMOVE'), (38, '*', 'reversal', '*', 'MASK'), (39, 'LARCH', '*', '*', 'NONE'),
(40, '*', '*', '3.1', 'REMOVE'), (41, 'ROWAN', 'CASHOUT', '*', 'REMOVE'), (42, '*', 'CHARGE', '4.0', 'NONE'),
(43, 'ALDER', '*', '4.0', 'NONE'), (44, 'BIRCH', 'TOPUP', '*', 'MASK'), (45, 'cedar', '*', '4.0', 'REMOVE'),
(46, 'MAPLE', 'TOPUP', '*', 'NONE'), (47, '*', 'cashout', '4.0', 'REMOVE'), (48, 'BIRCH', 'Charge', '4.0', 'MASK'),
(49, 'BIRCH', '*', '4.0', 'NONE'), (50, 'BIRCH', 'CASHOUT', '3.1', 'MASK'), (51, 'BIRCH', 'TOPUP', '3.0', 'REMOVE'),
(52, 'cedar', 'CASHOUT', '3.0', 'MASK'), (53, 'cedar', 'CASHOUT', '3.1', 'NONE'),
(54, 'cedar', 'TOPUP', '3.0', 'REMOVE'), (55, 'cedar', 'TOPUP', '3.1', 'MASK'),
(56, 'LARCH', 'CHARGE', '3.1', 'REMOVE'), (57, 'LARCH', 'CASHOUT', '3.0', 'NONE'),
(58, 'MAPLE', 'CHARGE', '4.0', 'MASK'), (59, 'MAPLE', 'Sweep', '4.0', 'REMOVE'), (60, 'MAPLE', '*', '*', 'MASK'),
(61, 'ROWAN', 'CHARGE', '4.0', 'REMOVE'), (62, 'ROWAN', 'Sweep', '*', 'NONE'), (63, 'ROWAN', '*', '3.0', 'REMOVE'),
(64, 'ROWAN', 'TOPUP', '4.0', 'MASK'), (65, 'cedar', '*', '*', 'NONE'), (66, '*', 'TOPUP', '*', 'REMOVE'),
(67, '*', 'sweep', '4.0', 'MASK'), (68, 'ALDER', 'CASHOUT', '*', 'NONE'), (69, '*', '*', '4.0', 'MASK'),
(70, 'STALE', '*', '*', 'REMOVE'), (71, 'BIRCH', '*', '*', 'REMOVE'), (72, '*', '*', '*', 'NONE')"""


@query("protect_by_rules", f"""WITH {MESSAGES},
rules(rule_no, i, t, v, outcome) AS (VALUES {MANY_RULES_SQL}),
hit AS (SELECT record_offset, min(rule_no) AS rule_no FROM msg JOIN rules
  ON (i = '*' OR lower(i) = lower(institution)) AND (t = '*' OR lower(t) = lower(event_type))
 AND (v = '*' OR lower(v) = lower(event_version)) GROUP BY record_offset),
chosen AS (SELECT msg.*, CAST(hit.rule_no AS INTEGER) AS rule_no, coalesce(rules.outcome, 'MASK') AS strategy
  FROM msg LEFT JOIN hit USING (record_offset) LEFT JOIN rules ON rules.rule_no = hit.rule_no)
SELECT record_offset, rule_no, strategy, CASE WHEN strategy = 'MASK' THEN {MASKED} END AS target,
  CASE WHEN strategy = 'NONE' THEN pan END AS source FROM chosen""")
def protect_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = choose_by_rules(
        sample.messages(spark, sf_dir), ProtectOptions(rules=MANY_RULES, default_strategy="MASK")
    )
    return chosen.select(
        "record_offset", "rule_no", "strategy",
        F.when(F.col("strategy") == "MASK", masking.mask(F.col("pan"))).alias("target"),
        F.when(F.col("strategy") == "NONE", F.col("pan")).alias("source"),
    )


def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose card numbers are real tokens where the tenant's policy decrypts them."""
    flat = sample.spread(sample.messages(spark, sf_dir))
    decrypting = F.col("institution").isin("BIRCH", "CEDAR", "MAPLE") & (F.col("header_case") != "stale")
    wanted = decrypting & F.col("value_case").isin("text", "null") & F.col("pan").isNotNull() & ~masking.is_token(
        F.col("pan")
    )
    ring = sample.key_ring(spark)
    flat = tokens.encrypt_text(flat, F.when(wanted, F.col("pan")), F.lit("keys/private"), ring, "token")
    return sample.as_records(flat.withColumn("pan", F.coalesce("token", "pan")))


def crypto(spark: SparkSession) -> Crypto:
    return Crypto(
        sample.key_ring(spark), partner_keys(spark, sample.PARTNER_TEXT), as_of=F.col("timestamp")
    )


BY_POLICY = f"""WITH {MESSAGES}, chosen AS (SELECT *, CASE inst_first WHEN 'ALDER' THEN 'REMOVE' WHEN 'BIRCH' THEN 'DECRYPT'
    WHEN 'CEDAR' THEN 'REKEY' WHEN 'LARCH' THEN 'MASK' WHEN 'MAPLE' THEN 'TOKENIZE' ELSE 'MASK' END AS strategy FROM msg),
failed AS (SELECT *, CASE WHEN value_case = 'broken' THEN 'decode'
  WHEN strategy <> 'REMOVE' AND value_case = 'number' THEN 'protect'
  WHEN strategy IN ('DECRYPT', 'REKEY', 'TOKENIZE') AND value_case = 'text' AND (pan IS NULL OR is_token) THEN 'jwe'
  END AS error_stage FROM chosen)
SELECT record_offset, strategy, error_stage,
  CASE WHEN value_case <> 'text' OR error_stage IS NOT NULL THEN NULL
    WHEN strategy = 'MASK' THEN {MASKED} WHEN strategy = 'TOKENIZE' THEN 'TOK-' || {MASKED}
    WHEN strategy IN ('DECRYPT', 'REKEY') THEN pan END AS result
FROM failed"""


@query("protect_by_policy", BY_POLICY)
def protect_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant policy chooses strategy, fields and keys; re-encrypted tokens are opened again to compare them."""
    done = protect(
        decode_dynamic(token_records(spark, sf_dir)), ProtectOptions(), sample.policy(spark), crypto(spark)
    )
    record, strategy = F.col("record"), F.col("strategy")
    rekeyed = F.when((strategy == "REKEY") & F.col("error").isNull(), member(record, "encryptedPrimaryAccountNumber"))
    done = tokens.decrypt_text(done, rekeyed, F.lit("keys/partner-3"), sample.key_ring(spark), "opened")
    shown = (
        F.when(strategy == "REKEY", F.col("opened"))
        .when(strategy == "TOKENIZE", member(record, "tokenizedPAN"))
        .when(F.col("institution") == "LARCH", member(record, "maskedNumber"))
        .otherwise(member(record, "primaryAccountNumber"))
    )
    return done.select(
        F.col("offset").alias("record_offset"), "strategy", F.col("error.stage").alias("error_stage"),
        shown.alias("result"),
    )


@query("tokenize", f"""WITH {MESSAGES} SELECT record_offset, 'TOK-' || {MASKED} AS token FROM msg WHERE pan IS NOT NULL""")
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = sample.messages(spark, sf_dir).where(F.col("pan").isNotNull())
    return flat.select("record_offset", masking.tokenize(F.col("pan")).alias("token"))


@query("mask_shapes", f"""WITH {MESSAGES} SELECT record_offset, is_token,
  CASE WHEN is_token THEN '******######****' WHEN length(pan) <= 6 THEN pan
    ELSE concat(substr(pan, 1, 4), repeat('#', length(pan) - 6), right(pan, 2)) END AS short_mask,
  CASE WHEN is_token THEN '****************' WHEN length(pan) <= 6 THEN pan
    ELSE concat(substr(pan, 1, 6), repeat('*', length(pan) - 6)) END AS head_only
FROM msg WHERE pan IS NOT NULL""")
def mask_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pan = F.col("pan")
    return sample.messages(spark, sf_dir).where(pan.isNotNull()).select(
        "record_offset", masking.is_token(pan).alias("is_token"), masking.mask(pan, 4, 2, "#").alias("short_mask"),
        masking.mask(pan, 6, 0).alias("head_only"),
    )


# ---------------------------------------------------------------- headers

def _pick(pick: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sample.records(spark, sf_dir).select(
            F.col("offset").alias("record_offset"),
            H.header(F.col("headers"), "X-Institution-Id", pick).alias("institution"),
            H.header(F.col("headers"), "X-User-Id", pick).alias("user_id"),
            H.header(F.col("headers"), "x-event-type", pick).alias("other_case"),
        )

    return run


def _picked(column: str) -> str:
    return f"""WITH {MESSAGES} SELECT record_offset, {column} AS institution,
  CASE WHEN user_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, CAST(NULL AS VARCHAR) AS other_case FROM msg"""


query("headers_first", _picked("inst_first"))(_pick("first"))
query("headers_first_non_null", _picked("inst_some"))(_pick("first_non_null"))
query("headers_last", _picked("institution"))(_pick("last_non_null"))

FOLD = FoldOptions(
    mandatory=("X-Institution-Id", "X-Event-Type", "X-Event-Version", "X-Event-Id"), optional=("X-User-Id", "X-Absent"),
)


@query("headers_extract", f"""WITH {MESSAGES} SELECT record_offset,
  CAST(2 + (institution IS NOT NULL)::INT + (event_type IS NOT NULL)::INT + (user_id % 4 <> 0)::INT AS BIGINT) AS names,
  concat_ws(',', CASE WHEN event_type IS NOT NULL THEN 'X-Event-Type' END,
    CASE WHEN institution IS NOT NULL THEN 'X-Institution-Id' END, CASE WHEN user_id % 4 <> 0 THEN 'X-User-Id' END) AS listed
FROM msg""")
def headers_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.array_sort(F.filter(F.map_keys("h"), lambda k: ~k.isin("X-Event-Version", "X-Event-Id")))
    return H.extract(sample.records(spark, sf_dir), FOLD.names, "h").select(
        F.col("offset").alias("record_offset"), F.size("h").cast("bigint").alias("names"),
        F.array_join(listed, ",").alias("listed"),
    )


@query("headers_missing", f"""WITH {MESSAGES} SELECT record_offset,
  CASE WHEN value_case = 'broken' THEN 'decode' WHEN value_case = 'null' THEN NULL
    WHEN institution IS NULL OR event_type IS NULL THEN 'headers' END AS error_stage,
  CASE WHEN value_case = 'broken' THEN 'value is not a JSON object' WHEN value_case = 'null' THEN NULL
    WHEN institution IS NULL AND event_type IS NULL THEN 'missing mandatory headers: X-Institution-Id,X-Event-Type'
    WHEN institution IS NULL THEN 'missing mandatory headers: X-Institution-Id'
    WHEN event_type IS NULL THEN 'missing mandatory headers: X-Event-Type' END AS message
FROM msg""")
def headers_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fold_headers(decode_dynamic(sample.records(spark, sf_dir)), FOLD)
    return done.select(
        F.col("offset").alias("record_offset"), F.col("error.stage").alias("error_stage"),
        F.col("error.message").alias("message"),
    )


FOLDED = f"""WITH {MESSAGES} SELECT record_offset,
  CASE WHEN value_case NOT IN ('null', 'broken') THEN institution END AS institution,
  CASE WHEN value_case NOT IN ('null', 'broken') AND user_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN value_case NOT IN ('null', 'broken') THEN transaction_id END AS transaction_id,
  CASE WHEN value_case NOT IN ('null', 'broken') THEN amount END AS amount FROM msg"""


@query("fold_wrap", FOLDED)
def fold_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = FoldOptions(FOLD.mandatory, FOLD.optional, "meta", fail_on_missing=False, wrap=True, payload_field="body")
    done = fold_headers(decode_dynamic(sample.records(spark, sf_dir)), options)
    found, body = F.col("record")["meta"], F.col("record")["body"]
    return done.select(
        F.col("offset").alias("record_offset"), F.try_element_at(found, F.lit("X-Institution-Id")).alias("institution"),
        F.try_element_at(found, F.lit("X-User-Id")).alias("user_id"),
        member(body, "transactionId").alias("transaction_id"),
        F.try_variant_get(F.try_element_at(body, F.lit("amount")), "$", "double").alias("amount"),
    )


@query("fold_inline", FOLDED.replace("FROM msg", ", CAST(NULL AS VARCHAR) AS overwritten FROM msg"))
def fold_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is an existing member of the payload, which the headers overwrite."""
    options = FoldOptions(FOLD.mandatory, FOLD.optional, "merchantName", fail_on_missing=False)
    done = fold_headers(decode_dynamic(sample.records(spark, sf_dir)), options)
    record = F.col("record")
    found = F.try_variant_get(F.try_element_at(record, F.lit("merchantName")), "$", "map<string,string>")
    return done.select(
        F.col("offset").alias("record_offset"), F.try_element_at(found, F.lit("X-Institution-Id")).alias("institution"),
        F.try_element_at(found, F.lit("X-User-Id")).alias("user_id"),
        member(record, "transactionId").alias("transaction_id"),
        F.try_variant_get(F.try_element_at(record, F.lit("amount")), "$", "double").alias("amount"),
        F.try_element_at(found, F.lit("Shop 1")).alias("overwritten"),
    )


@query("fold_typed", FOLDED)
def fold_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = FoldOptions(FOLD.mandatory, FOLD.optional, fail_on_missing=False)
    done = fold_headers(decode_typed(sample.records(spark, sf_dir), sample.PAYLOAD_SCHEMA), options)
    found = F.col("record.headers")
    return done.select(
        F.col("offset").alias("record_offset"), F.try_element_at(found, F.lit("X-Institution-Id")).alias("institution"),
        F.try_element_at(found, F.lit("X-User-Id")).alias("user_id"),
        F.col("record.transactionId").alias("transaction_id"), F.col("record.amount").alias("amount"),
    )


@query("remove_dynamic", f"""WITH {MESSAGES} SELECT record_offset, concat_ws(',', 'amount', 'currency', 'merchantName', 'transactionId') AS members
FROM msg WHERE value_case NOT IN ('null', 'broken')""")
def remove_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = protect(decode_dynamic(sample.records(spark, sf_dir)), ProtectOptions(strategy="remove"))
    return done.where(F.col("record").isNotNull()).select(
        F.col("offset").alias("record_offset"), F.array_join(F.array_sort(F.map_keys("record")), ",").alias("members")
    )


@query("decode_outcomes", f"""WITH {MESSAGES} SELECT value_case, count(*) AS records,
  count(*) FILTER (WHERE value_case = 'broken') AS errors, count(*) FILTER (WHERE value_case NOT IN ('null', 'broken')) AS decoded
FROM msg GROUP BY value_case""")
def decode_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_dynamic(sample.records(spark, sf_dir))
    stored = F.try_element_at("record", F.lit("encryptedPrimaryAccountNumber"))
    case = (
        F.when(F.col("error").isNotNull(), "broken").when(F.col("record").isNull(), "null")
        .when(~F.map_contains_key("record", F.lit("encryptedPrimaryAccountNumber")), "absent")
        .when(F.schema_of_variant(stored).isin("STRING", "VOID"), "text").otherwise("number")
    )
    return decoded.groupBy(case.alias("value_case")).agg(
        F.count("*").alias("records"), F.count("error").alias("errors"), F.count("record").alias("decoded")
    )


# ---------------------------------------------------------------- encryption decisions and rule parsing

@query("encrypt_decision_record", f"""WITH {MESSAGES} SELECT record_offset, institution,
  CASE WHEN institution IN ('BIRCH') THEN event_type IS NULL OR NOT (event_type = 'CHARGE' AND event_version = '3.0')
       WHEN institution = 'LARCH' THEN TRUE
       WHEN institution = 'MAPLE' THEN event_type IS NULL OR event_type = 'CHARGE' OR (event_type = 'SWEEP' AND event_version = '4.0')
       ELSE FALSE END AS encrypted
FROM msg""")
def encrypt_decision_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decision(spark, sf_dir, "lenient", "record")


@query("encrypt_decision_file", f"""WITH {MESSAGES} SELECT record_offset, institution,
  CASE WHEN institution IN ('BIRCH') THEN coalesce(event_type = 'REVERSAL', FALSE)
       WHEN institution = 'LARCH' THEN TRUE
       WHEN institution = 'MAPLE' THEN coalesce(event_type = 'CHARGE' OR (event_type = 'SWEEP' AND event_version = '4.0'), FALSE)
       ELSE FALSE END AS encrypted
FROM msg""")
def encrypt_decision_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decision(spark, sf_dir, "file", "file")


def _decision(spark: SparkSession, sf_dir: str, mode: str, level: str) -> DataFrame:
    joined = sample.policy(spark).with_rules(mode).attach(sample.messages(spark, sf_dir), F.col("institution"))
    decided = encrypt_decision(
        F.col("policy.enc_enabled"), F.col("policy.enc_rules"), F.col("policy.parsed_rules"), F.col("event_type"),
        F.col("event_version"), level,
    )
    return joined.select("record_offset", "institution", decided.alias("encrypted"))


RULE_TEXT = """concat_ws(',', concat(coalesce(event_type, ''), ':', event_version, ':', CASE WHEN record_offset % 4 = 0 THEN 'encrypt'
  WHEN record_offset % 4 = 1 THEN 'SKIP' WHEN record_offset % 4 = 2 THEN 'PERHAPS' ELSE ' Skip : extra' END),
  CASE WHEN record_offset % 3 = 0 THEN '  ' WHEN record_offset % 3 = 1 THEN ' * : * : ENCRYPT ' ELSE 'INVALID' END,
  concat(coalesce(institution, '*'), ':*:', event_version, ':', CASE WHEN record_offset % 5 = 0 THEN 'hide' ELSE 'mask' END))"""


def _parsed(mode: str) -> str:
    width = 4 if mode == "strict" else 3
    words = {
        "strict": "upper(parts[4]) IN ('REMOVE', 'MASK', 'DECRYPT', 'REKEY', 'NONE', 'TOKENIZE')",
        "lenient": "upper(parts[3]) IN ('ENCRYPT', 'SKIP') AND parts[1] <> '' AND parts[2] <> ''",
        "file": "TRUE",
    }[mode]
    size = "len(parts) >= 3" if mode == "file" else f"len(parts) = {width}"
    outcome = (
        "CASE WHEN upper(parts[3]) = 'ENCRYPT' THEN 'ENCRYPT' ELSE 'SKIP' END" if mode == "file" else f"upper(parts[{width}])"
    )
    return f"""WITH {MESSAGES}, texts AS (SELECT record_offset, {RULE_TEXT} AS t FROM msg),
raw AS (SELECT record_offset, unnest(string_split(t, ',')) AS r, generate_subscripts(string_split(t, ','), 1) AS p FROM texts),
kept AS (SELECT record_offset, trim(r) AS rule, row_number() OVER (PARTITION BY record_offset ORDER BY p) AS rule_no
  FROM raw WHERE trim(r) <> ''),
cut AS (SELECT *, list_transform(string_split(rule, ':'), lambda x: trim(x)) AS parts FROM kept),
judged AS (SELECT *, ({size}) AND ({words}) AS valid FROM cut)
SELECT record_offset, CAST(rule_no AS INTEGER) AS rule_no, rule, coalesce(valid, FALSE) AS valid,
  CASE WHEN valid THEN {outcome} END AS outcome FROM judged"""


def _parse_query(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = sample.messages(spark, sf_dir).select("record_offset", F.expr(RULE_TEXT).alias("t"))
        return texts.select(
            "record_offset", F.explode(rule_array(F.col("t"), mode)).alias("r")
        ).select("record_offset", "r.rule_no", "r.rule", "r.valid", "r.outcome")

    return run


for _mode in ("strict", "lenient", "file"):
    query(f"rules_parse_{_mode}", _parsed(_mode))(_parse_query(_mode))


@query("rules_first_match", f"""WITH {MESSAGES} SELECT record_offset,
  CAST(CASE WHEN institution = 'ALDER' THEN 1 WHEN institution = 'MAPLE' AND event_type = 'CHARGE' THEN 2
    WHEN event_version = '4.0' THEN 3 WHEN institution = 'ROWAN' AND event_type = 'SWEEP' THEN 4 END AS INTEGER) AS rule_no,
  {strategy_sql('institution')} AS strategy FROM msg""")
def rules_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = sample.messages(spark, sf_dir)
    matched = match_rules(flat, parse(RULES), ["institution", "event_type", "event_version"])
    return matched.select(
        "record_offset", "matched.rule_no", F.coalesce("matched.outcome", F.lit("MASK")).alias("strategy")
    )


# ---------------------------------------------------------------- paths

FIELDS = ("institution", "event_type", "event_version")


def _flat_path(layout: LayoutOptions) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        flat = sample.messages(spark, sf_dir)
        fields = field_segment({f: F.col(f) for f in layout.fields}, layout)
        moment = time_segment(F.col("record_ts").cast("timestamp"), layout)
        path = F.concat(fields, F.lit("/"), moment)
        return flat.groupBy(path.alias("path")).agg(F.count("*").alias("records"))

    return run


def _path_sql(fields: str, time: str) -> str:
    return f"""WITH {MESSAGES}, p AS (SELECT concat({fields}) AS f, {time} AS t, (institution IS NOT NULL AND event_type IS NOT NULL) AS whole FROM msg)
SELECT CASE WHEN whole THEN f || '/' || t END AS path, count(*) AS records FROM p GROUP BY 1"""


HOUR = "strftime(record_ts, 'year=%Y/month=%m/day=%d/hour=%H')"
query("path_labels", _path_sql(
    "'institution=', institution, '/event_type=', event_type, '/event_version=', event_version", HOUR
))(_flat_path(LayoutOptions(FIELDS)))
query("path_values", _path_sql("institution, '/', event_type, '/', event_version", HOUR))(
    _flat_path(LayoutOptions(FIELDS, labelled=False))
)
query("path_minute", _path_sql(
    "institution, '/', event_type, '/', event_version", "strftime(record_ts, '%Y/%m/%d/%H/%M')"
))(_flat_path(LayoutOptions(FIELDS, labelled=False, path_format="YYYY/MM/dd/HH/mm", duration_ms=60_000)))
query("path_zone", _path_sql(
    "institution, '/', event_type, '/', event_version",
    "strftime(time_bucket(INTERVAL 15 MINUTE, record_ts + INTERVAL 2 HOUR), 'day=%Y%m%d/%H%M')",
))(_flat_path(LayoutOptions(
    FIELDS, labelled=False, path_format="'day='YYYYMMdd/HHmm", duration_ms=900_000, zone="+02:00"
)))
query("path_defaults", f"""WITH {MESSAGES}, p AS (SELECT concat(coalesce(institution, 'UNKNOWN'), '/', coalesce(event_type, 'UNCLASSIFIED'), '/',
  event_version, '/', {HOUR}) AS path FROM msg) SELECT path, count(*) AS records FROM p GROUP BY path""")(
    _flat_path(LayoutOptions(FIELDS, labelled=False, defaults=(
        ("institution", "UNKNOWN"), ("event_type", "UNCLASSIFIED"), ("event_version", "v0"),
    )))
)

NESTED_LAYOUT = LayoutOptions(("headers.X-Institution-Id", "headers.X-Event-Type"), labelled=True)


@query("path_nested", f"""WITH {MESSAGES}, p AS (SELECT CASE WHEN value_case = 'broken' THEN 'decode'
    WHEN value_case = 'null' OR institution IS NULL OR event_type IS NULL THEN 'partition' END AS error_stage,
  concat('headers.X-Institution-Id=', institution, '/headers.X-Event-Type=', event_type, '/', {HOUR}) AS path FROM msg)
SELECT error_stage, CASE WHEN error_stage IS NULL THEN path END AS path, count(*) AS records FROM p GROUP BY 1, 2""")
def path_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = FoldOptions(FOLD.mandatory, FOLD.optional, fail_on_missing=False, wrap=True)
    done = add_path(fold_headers(decode_dynamic(sample.records(spark, sf_dir)), options), NESTED_LAYOUT)
    return done.groupBy(F.col("error.stage").alias("error_stage"), "path").agg(F.count("*").alias("records"))


# ---------------------------------------------------------------- files

FILES = """filed AS (SELECT *, (row_number() OVER (PARTITION BY part, path ORDER BY record_offset) - 1) // 10 AS file_no FROM routed)"""
COARSE = """routed AS (SELECT *, kafka_partition % 2 AS part,
  concat(coalesce(institution, 'UNKNOWN'), '/', strftime(record_ts, 'day=%d')) AS path FROM msg)"""


def coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = sample.messages(spark, sf_dir)
    return flat.select(
        F.lit("card-events").alias("topic"), (F.col("kafka_partition") % 2).alias("partition"),
        F.col("record_offset").alias("offset"), F.col("record_ts").cast("timestamp").alias("timestamp"),
        F.concat(F.coalesce("institution", F.lit("UNKNOWN")), F.date_format("record_ts", "'/day='dd")).alias("path"),
        F.col("transaction_id").alias("line"), "institution", "event_type", "event_version", "amount",
    )


NAME = "concat('card-events+', CAST(part AS VARCHAR), '+', lpad(CAST(min(record_offset) AS VARCHAR), 10, '0'))"


@query("file_manifest", f"""WITH {MESSAGES}, {COARSE}, {FILES}
SELECT path, {NAME} AS name, min(record_offset) AS start_offset, max(record_offset) AS end_offset, count(*) AS records,
  CAST(sum(length(transaction_id) + 1) AS BIGINT) AS bytes FROM filed GROUP BY path, part, file_no""")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = manifest(assign_files(coarse(spark, sf_dir), SHARP), SHARP)
    return files.select("path", "name", "start_offset", "end_offset", "records", "bytes")


@query("file_first_decides", f"""WITH {MESSAGES}, {COARSE}, {FILES}
SELECT path, {NAME} AS name, arg_min(coalesce(event_type, '-'), record_offset) AS event_type,
  arg_min(event_version, record_offset) AS event_version,
  CASE WHEN arg_min(institution, record_offset) IS NULL THEN FALSE ELSE coalesce(CASE arg_min(institution, record_offset)
    WHEN 'BIRCH' THEN arg_min(coalesce(event_type, '-'), record_offset) = 'REVERSAL' WHEN 'LARCH' THEN TRUE
    WHEN 'MAPLE' THEN arg_min(coalesce(event_type, '-'), record_offset) = 'CHARGE'
      OR (arg_min(coalesce(event_type, '-'), record_offset) = 'SWEEP' AND arg_min(event_version, record_offset) = '4.0')
    ELSE FALSE END, FALSE) END AS sealed
FROM filed GROUP BY path, part, file_no""")
def file_first_decides(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = manifest(assign_files(coarse(spark, sf_dir), SHARP), SHARP)
    joined = sample.policy(spark).with_rules("file").attach(files, F.col("institution"))
    sealed = F.col("institution").isNotNull() & encrypt_decision(
        F.col("policy.enc_enabled"), F.col("policy.enc_rules"), F.col("policy.parsed_rules"), F.col("event_type"),
        F.col("event_version"), "file",
    )
    return joined.select(
        "path", "name", F.coalesce("event_type", F.lit("-")).alias("event_type"), "event_version", sealed.alias("sealed")
    )


@query("file_line_numbers", f"""WITH {MESSAGES}, {COARSE}, numbered AS (SELECT record_offset,
  row_number() OVER (PARTITION BY part, path ORDER BY record_offset) - 1 AS n FROM routed)
SELECT record_offset, CAST(n // 7 AS BIGINT) AS file_no, CAST(n % 7 AS BIGINT) AS line_no FROM numbered""")
def file_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = assign_files(coarse(spark, sf_dir), FileOptions(flush_size=7, chunk_offsets=100))
    return assigned.select(F.col("offset").alias("record_offset"), "file_no", "line_no")


@query("file_rotation", f"""WITH {MESSAGES}, {COARSE}, turned AS (SELECT *, epoch_ms(record_ts) // 7200000 AS turn FROM routed),
filed AS (SELECT *, (row_number() OVER (PARTITION BY part, path, turn ORDER BY record_offset) - 1) // 3 AS file_no FROM turned)
SELECT path, {NAME} AS name, count(*) AS records FROM filed GROUP BY path, part, turn, file_no""")
def file_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = FileOptions(flush_size=3, rotate_ms=7_200_000, chunk_offsets=512)
    return manifest(assign_files(coarse(spark, sf_dir), options), options).select("path", "name", "records")


# ---------------------------------------------------------------- reports

@query("report_strategy_counts", f"""WITH {MESSAGES} SELECT institution, {strategy_sql('institution')} AS strategy, count(*) AS records
FROM msg GROUP BY 1, 2""")
def report_strategy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.strategy_counts(choose_by_rules(sample.messages(spark, sf_dir), PROTECT))


TYPES = ["CHARGE", "REVERSAL", "SWEEP", "CASHOUT", "TOPUP"]


@query("report_matrix", f"""WITH {MESSAGES} SELECT institution, {', '.join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS {t.lower()}" for t in TYPES)} FROM msg GROUP BY institution""")
def report_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = reports.coverage_matrix(sample.messages(spark, sf_dir), TYPES)
    return matrix.select("institution", *[F.col(t).alias(t.lower()) for t in TYPES])


@query("report_landing", f"""WITH {MESSAGES}, {COARSE}, {FILES}, sized AS (SELECT count(*) AS records,
  sum(length(transaction_id) + 1) AS bytes FROM filed GROUP BY path, part, file_no)
SELECT count(*) AS files, CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(sum(records) AS BIGINT) AS total_records,
  avg(bytes) AS mean_bytes, avg(records) AS mean_records FROM sized""")
def report_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.landing_statistics(manifest(assign_files(coarse(spark, sf_dir), SHARP), SHARP))


@query("report_files", f"""WITH {MESSAGES}, {COARSE}, {FILES}, sized AS (SELECT count(*) AS records, min(institution) AS institution,
  arg_min(coalesce(event_type, '-'), record_offset) AS t, arg_min(event_version, record_offset) AS v FROM filed GROUP BY path, part, file_no)
SELECT institution, count(*) AS files, count(*) FILTER (WHERE institution = 'LARCH' OR (institution = 'BIRCH' AND t = 'REVERSAL')
  OR (institution = 'MAPLE' AND (t = 'CHARGE' OR (t = 'SWEEP' AND v = '4.0')))) AS sealed_files,
  CAST(sum(records) AS BIGINT) AS records FROM sized GROUP BY institution""")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = manifest(assign_files(coarse(spark, sf_dir), SHARP), SHARP)
    joined = sample.policy(spark).with_rules("file").attach(files, F.col("institution"))
    sealed = F.col("institution").isNotNull() & encrypt_decision(
        F.col("policy.enc_enabled"), F.col("policy.enc_rules"), F.col("policy.parsed_rules"), F.col("event_type"),
        F.col("event_version"), "file",
    )
    return reports.files_per_institution(joined.withColumn("sealed", sealed))


RATE = """WITH counted AS (SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS second, count(*) AS records FROM events GROUP BY 1)
SELECT second, records FROM counted"""


@query("report_rate", RATE)
def report_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = sample.messages(spark, sf_dir).select(F.col("record_ts").cast("timestamp").alias("ts"))
    return reports.message_rate(flat, "ts").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("second"), "records"
    )


# ---------------------------------------------------------------- whole landing chain

LANDING = LayoutOptions(
    ("headers.X-Institution-Id", "headers.X-Event-Type", "headers.X-Event-Version"), labelled=False
)
WRAP = FoldOptions(FOLD.mandatory, FOLD.optional, fail_on_missing=False, wrap=True)


def landing_chain() -> Chain:
    return Chain([protect_step(PROTECT), fold_step(WRAP), path_step(LANDING)])


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_chain()(decode_dynamic(sample.records(spark, sf_dir)))


STAGED = f"""{MESSAGES}, chosen AS (SELECT *, {strategy_sql('inst_first')} AS strategy FROM msg),
staged AS (SELECT *, CASE WHEN value_case = 'broken' THEN 'decode' WHEN value_case = 'number' AND strategy = 'MASK' THEN 'protect'
  WHEN value_case = 'null' OR institution IS NULL OR event_type IS NULL THEN 'partition' END AS error_stage FROM chosen),
routed AS (SELECT *, kafka_partition % 2 AS part, CASE WHEN error_stage IS NOT NULL THEN concat('_dead_letter/', error_stage)
  ELSE concat(institution, '/', event_type, '/', event_version, '/', {HOUR}) END AS path FROM staged)"""


@query("landing_chain", f"""WITH {STAGED} SELECT record_offset, strategy, error_stage, path,
  CASE WHEN error_stage IS NULL THEN transaction_id END AS transaction_id, CASE WHEN error_stage IS NULL THEN amount END AS amount,
  CASE WHEN error_stage IS NULL AND value_case = 'text' AND strategy = 'MASK' THEN {MASKED} END AS masked FROM routed""")
def landing_chain_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = route(prepared(spark, sf_dir))
    return lines.select(
        F.col("offset").alias("record_offset"), "strategy", F.col("error.stage").alias("error_stage"), "path",
        F.get_json_object("line", "$.payload.transactionId").alias("transaction_id"),
        F.get_json_object("line", "$.payload.amount").cast("double").alias("amount"),
        F.get_json_object("line", "$.payload.primaryAccountNumber").alias("masked"),
    )


@query("dlq_split", f"""WITH {STAGED} SELECT record_offset, error_stage AS stage, kafka_partition % 2 AS part, transaction_id AS record_key
FROM routed WHERE error_stage IS NOT NULL""")
def dlq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_errors(prepared(spark, sf_dir))
    return bad.select(
        F.col("offset").alias("record_offset"), "stage", F.col("partition").alias("part"),
        F.col("key").cast("string").alias("record_key"),
    )


@query("tolerated", f"""WITH {STAGED} SELECT institution, event_type, count(*) AS records FROM routed WHERE error_stage IS NULL GROUP BY 1, 2""")
def tolerated(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = keep_tolerated(prepared(spark, sf_dir))
    return good.groupBy(
        nested(good, "headers.X-Institution-Id").alias("institution"), nested(good, "headers.X-Event-Type").alias("event_type")
    ).agg(F.count("*").alias("records"))


@query("report_errors", f"""WITH {STAGED} SELECT error_stage AS stage, count(*) AS records, count(*) / (SELECT count(*) FROM events) AS share
FROM routed GROUP BY error_stage""")
def report_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.error_rates(prepared(spark, sf_dir))


@query("json_lines", f"""WITH {MESSAGES} SELECT record_offset, CASE WHEN value_case IN ('null', 'broken') THEN 'null' ELSE concat(
  '{{"transactionId":"', transaction_id, '","currency":"EUR","encryptedPrimaryAccountNumber":',
  CASE WHEN value_case = 'absent' OR (value_case = 'text' AND pan IS NULL) THEN 'null' WHEN value_case = 'number' THEN '"42"'
    ELSE concat('"', pan, '"') END, ',"merchantName":"', merchant_name, '"}}') END AS line FROM msg""")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_typed(sample.records(spark, sf_dir), sample.PAYLOAD_SCHEMA)
    return decoded.select(
        F.col("offset").alias("record_offset"), json_line(F.col("record").dropFields("amount")).alias("line")
    )


CONNECTOR = {
    "topics": "card-events", "flush.size": "5", "partition.duration.ms": "3600000",
    "partition.field.name": "headers.X-Institution-Id,headers.X-Event-Type,headers.X-Event-Version",
    "partition.field.format.path": "false", "path.format": "'year'=YYYY/'month'=MM/'day'=dd/'hour'=HH",
    "timezone": "UTC", "errors.tolerance": "all", "transforms": "hide,extract",
    "transforms.hide.type": "protect", "transforms.hide.default.strategy": "MASK", "transforms.hide.rules": RULES,
    "transforms.extract.type": "fold", "transforms.extract.wrap.payload": "true",
    "transforms.extract.mandatory.headers": "X-Institution-Id,X-Event-Type,X-Event-Version,X-Event-Id",
    "transforms.extract.optional.headers": "X-User-Id", "transforms.extract.fail.on.missing.mandatory": "false",
}


@query("connector_config", f"""WITH {STAGED} SELECT path, count(*) AS records FROM routed WHERE error_stage IS NULL GROUP BY path""")
def connector_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    connector = Connector.from_config(CONNECTOR)
    landed = keep_tolerated(connector.prepare(sample.records(spark, sf_dir)), connector.tolerance)
    return landed.groupBy("path").agg(F.count("*").alias("records"))


LANDED_LINES = f"""WITH {STAGED} SELECT CASE WHEN error_stage IS NULL THEN 'landed' ELSE 'dead_letter' END AS lane,
  CASE WHEN error_stage IS NULL THEN institution ELSE error_stage END AS part, count(*) AS records,
  min(CASE WHEN error_stage IS NULL THEN transaction_id END) AS first_id, max(CASE WHEN error_stage IS NULL THEN transaction_id END) AS last_id
FROM routed GROUP BY 1, 2"""


def _lanes() -> dict[str, Column]:
    failed = F.col("error").isNotNull()
    return {
        "lane": F.when(failed, F.lit("dead_letter")).otherwise(F.lit("landed")),
        "part": F.when(failed, F.col("error.stage")).otherwise(F.split("path", "/")[0]),
    }


def _read_lines(spark: SparkSession, root: str) -> DataFrame:
    lines = spark.read.option("basePath", root).text(root)
    found = F.when(F.col("lane") == "landed", F.get_json_object("value", "$.payload.transactionId"))
    return lines.groupBy("lane", "part").agg(
        F.count("*").alias("records"), F.min(found).alias("first_id"), F.max(found).alias("last_id")
    )


@query("land_lines", LANDED_LINES)
def land_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "lines")
    land_lines(route(prepared(spark, sf_dir)), root, _lanes())
    return _read_lines(spark, root)


@query("stream_lines", LANDED_LINES)
def stream_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered in several micro-batches that arrive out of order."""
    root, checkpoint = shared_dir(spark, "stream"), shared_dir(spark, "checkpoint")
    for source in sample.deliveries(spark, sf_dir):
        stream_lines(source, lambda df: landing_chain()(decode_dynamic(df)), root, checkpoint, _lanes()).awaitTermination()
    return _read_lines(spark, root)


@query("dlq_replay", f"""WITH {STAGED} SELECT record_offset, error_stage AS stage, transaction_id AS record_key, TRUE AS intact
FROM routed WHERE error_stage IS NOT NULL""")
def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed dead letters read back as messages: every one has the key, value, headers and time it came with."""
    root = shared_dir(spark, "letters")
    land_lines(route(prepared(spark, sf_dir)), root, _lanes())
    again = read_dead_letters(spark.read.option("basePath", root).text(root).where("lane = 'dead_letter'"))
    came = sample.records(spark, sf_dir).select("topic", "partition", "offset", F.struct("key", "value", "timestamp", "timestampType", "headers").alias("came"))
    both = again.withColumn("now", F.struct("key", "value", "timestamp", "timestampType", "headers")).join(came, ["topic", "partition", "offset"], "left")
    return both.select(
        F.col("offset").alias("record_offset"), "stage", F.col("key").cast("string").alias("record_key"),
        F.col("now").eqNullSafe(F.col("came")).alias("intact"),
    )


@query("stream_counts", f"""WITH {STAGED} SELECT inst_some AS institution, strategy,
  count(*) AS records, CAST(count(error_stage) AS BIGINT) AS errors FROM routed GROUP BY 1, 2""")
def stream_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counters by institution and strategy, kept by a stream over several micro-batches."""
    root, checkpoint = shared_dir(spark, "counts"), shared_dir(spark, "checkpoint")
    for source in sample.deliveries(spark, sf_dir):
        stream_counts(source, lambda df: landing_chain()(decode_dynamic(df)), root, checkpoint).awaitTermination()
    return latest_counts(spark.read.parquet(root))


HOSTILE = """WITH odd AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '../up' WHEN 1 THEN '/abs/path' WHEN 2 THEN '_dead_letter' WHEN 3 THEN ''
  WHEN 4 THEN '100%' ELSE event_type END AS tenant FROM events)
SELECT concat('tenant=', CASE WHEN tenant = '' THEN '%' ELSE regexp_replace(regexp_replace(replace(replace(tenant, '%', '%25'), '/', '%2F'),
  '^[.]', '%2E'), '^_', '%5F') END) AS path, count(*) AS records FROM odd GROUP BY 1"""


@query("path_hostile", HOSTILE)
def path_hostile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants named to leave the landing root, to hide or to look like a folder of this package: all land below the root."""
    root = shared_dir(spark, "hostile")
    tenant = """CASE event_id % 6 WHEN 0 THEN '../up' WHEN 1 THEN '/abs/path' WHEN 2 THEN '_dead_letter' WHEN 3 THEN ''
      WHEN 4 THEN '100%' ELSE event_type END"""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "cast(cast(event_id AS string) AS binary) AS key", "cast('{}' AS binary) AS value", "'t' AS topic", "0 AS partition", "event_id AS offset",
        "cast(ts AS timestamp) AS timestamp", "cast(array() AS array<struct<key:string,value:binary>>) AS headers",
        f"named_struct('tenant', {tenant}) AS record",
    )
    layout = LayoutOptions(("tenant",), path_format="'all'", duration_ms=86_400_000)
    land_batch(add_path(events, layout), root, f"{root}/_manifest", FileOptions(), None, None)
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root)
    # The metadata path is URL-encoded once more than the folder's name.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return lines.groupBy(F.regexp_extract(path, "/(tenant=[^/]*)/all/[^/]+$", 1).alias("path")).agg(F.count("*").alias("records"))


# ---------------------------------------------------------------- tenants and keys

MURMUR = """h0 AS (SELECT tenant, records, encode(tenant) AS b, octet_length(encode(tenant)) AS n FROM seen),
bytes AS (SELECT tenant, records, n, list_transform(range(n), lambda i: CAST(('0x' || substr(hex(b), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT)) AS y FROM h0),
words AS (SELECT *, list_transform(range(n // 4), lambda i: y[4 * i + 1] + (y[4 * i + 2] << 8) + (y[4 * i + 3] << 16) + (y[4 * i + 4] << 24)) AS w,
  coalesce(y[(n // 4) * 4 + 1], 0) + (coalesce(y[(n // 4) * 4 + 2], 0) << 8) + (coalesce(y[(n // 4) * 4 + 3], 0) << 16) AS rest FROM bytes),
body AS (SELECT *, list_reduce(list_prepend(xor(2538058380, n), list_transform(list_transform(w, lambda k: (k * 1540483477) & 4294967295),
  lambda k: (xor(k, k >> 24) * 1540483477) & 4294967295)), lambda h, k: xor((h * 1540483477) & 4294967295, k)) AS h1 FROM words),
tail AS (SELECT *, CASE WHEN n % 4 > 0 THEN (xor(h1, rest) * 1540483477) & 4294967295 ELSE h1 END AS h2 FROM body),
mixed AS (SELECT *, (xor(h2, h2 >> 13) * 1540483477) & 4294967295 AS h3 FROM tail),
hashed AS (SELECT tenant, records, CAST((xor(h3, h3 >> 15) & 2147483647) % 20 AS INTEGER) AS p FROM mixed)"""


@query("bank_partition", f"""WITH {MESSAGES}, seen AS (SELECT institution AS tenant, count(*) AS records FROM msg WHERE institution IS NOT NULL GROUP BY 1),
{MURMUR} SELECT tenant, records, CAST(CASE tenant WHEN 'ALDER' THEN 0 WHEN 'BIRCH' THEN 1 WHEN 'CEDAR' THEN 2 ELSE p END AS INTEGER) AS partition,
  tenant IN ('ALDER', 'BIRCH', 'CEDAR') AS listed FROM hashed""")
def bank_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tenant_partitions(
        sample.messages(spark, sf_dir), F.col("institution"), partition_map(spark, sample.PARTITION_MAP), 20
    )


@query("merchant_partition", f"""WITH {MESSAGES}, seen AS (SELECT merchant_name AS tenant, count(*) AS records FROM msg GROUP BY 1),
{MURMUR} SELECT tenant, records, p AS partition, FALSE AS listed FROM hashed""")
def merchant_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of several lengths go through the hash; none of them is in the map."""
    return tenant_partitions(
        sample.messages(spark, sf_dir), F.col("merchant_name"), partition_map(spark, sample.PARTITION_MAP), 20
    )


@query("unmapped_tenants", f"""WITH {MESSAGES} SELECT institution AS tenant, count(*) AS records FROM msg
WHERE institution IS NULL OR institution NOT IN ('ALDER', 'BIRCH', 'CEDAR', 'LARCH', 'MAPLE', 'FIR') GROUP BY 1""")
def unmapped_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmapped(sample.messages(spark, sf_dir), F.col("institution"), sample.policy(spark).table, "bank")


@query("policy_lookup", f"""WITH {MESSAGES} SELECT record_offset, CASE WHEN institution IN ('ALDER', 'BIRCH', 'CEDAR', 'LARCH', 'MAPLE') THEN institution
    ELSE 'DEFAULT' END AS bank,
  CASE institution WHEN 'ALDER' THEN 'REMOVE' WHEN 'BIRCH' THEN 'DECRYPT' WHEN 'CEDAR' THEN 'REKEY' WHEN 'LARCH' THEN 'MASK'
    WHEN 'MAPLE' THEN 'TOKENIZE' ELSE 'MASK' END AS strategy,
  institution IN ('BIRCH', 'LARCH', 'MAPLE') AND institution IS NOT NULL AS enc_enabled,
  CASE institution WHEN 'ALDER' THEN '*:*:ENCRYPT' WHEN 'BIRCH' THEN 'CHARGE:3.0:SKIP,reversal:*:encrypt' WHEN 'CEDAR' THEN NULL
    WHEN 'LARCH' THEN NULL WHEN 'MAPLE' THEN 'CHARGE:*:ENCRYPT,SWEEP:4.0:ENCRYPT,*:*:SKIP' ELSE '*:*:SKIP' END AS enc_rules
FROM msg""")
def policy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = sample.policy(spark).attach(sample.messages(spark, sf_dir), F.col("institution"))
    return joined.select(
        "record_offset", "policy.bank", "policy.strategy", "policy.enc_enabled", "policy.enc_rules"
    )


PLACE = """concat(CASE institution WHEN 'CEDAR' THEN 'isolated' ELSE 'landing' END, '/', CASE WHEN institution IN
  ('ALDER', 'BIRCH', 'CEDAR', 'LARCH', 'MAPLE') THEN lower(institution) ELSE 'default' END, '/', strftime(record_ts, 'day=%d'))"""


@query("tenant_paths", f"WITH {MESSAGES} SELECT {PLACE} AS path, count(*) AS records FROM msg GROUP BY 1")
def tenant_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = sample.messages(spark, sf_dir).withColumn("path", F.date_format("record_ts", "'day='dd"))
    placed = add_tenant_prefix(flat, sample.policy(spark), F.col("institution"))
    return placed.groupBy("path").agg(F.count("*").alias("records"))


@query("tenant_routing", f"""WITH {MESSAGES} SELECT CASE institution WHEN 'CEDAR' THEN 'isolated' ELSE 'landing' END AS bucket,
  CASE WHEN institution IN ('ALDER', 'BIRCH', 'CEDAR', 'LARCH', 'MAPLE') THEN lower(institution) ELSE 'default' END AS path_prefix,
  count(*) AS records FROM msg GROUP BY 1, 2""")
def tenant_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = sample.policy(spark).attach(sample.messages(spark, sf_dir), F.col("institution"))
    return joined.groupBy(
        F.col("policy.bucket").alias("bucket"), F.col("policy.path_prefix").alias("path_prefix")
    ).agg(F.count("*").alias("records"))


@query("key_lookup", f"""WITH {MESSAGES}, k AS (SELECT *, CASE institution WHEN 'ALDER' THEN 'keys/partner-1' WHEN 'CEDAR' THEN 'keys/partner-3'
  WHEN 'LARCH' THEN CASE WHEN record_ts >= TIMESTAMP '2024-01-10' AND record_ts < TIMESTAMP '2024-01-20' THEN 'keys/partner-1' END END AS public_key FROM msg)
SELECT record_offset, public_key, CASE WHEN public_key IS NULL THEN 'key' END AS error_stage FROM k""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = partner_keys(spark, sample.PARTNER_TEXT)
    found = attach_key(
        sample.messages(spark, sf_dir), F.col("institution"), keys, "public_key", F.col("record_ts").cast("timestamp")
    )
    return found.select("record_offset", "public_key", F.col("error.stage").alias("error_stage"))


# ---------------------------------------------------------------- tokens and sealing

@query("jwe_roundtrip", f"""WITH {MESSAGES} SELECT record_offset, pan IS NOT NULL AS whole, pan AS opened FROM msg""")
def jwe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = sample.key_ring(spark)
    flat = sample.spread(sample.messages(spark, sf_dir).select("record_offset", "pan"))
    sealed = tokens.encrypt_text(flat, F.col("pan"), F.lit("keys/private"), ring, "token")
    opened = tokens.decrypt_text(sealed, F.col("token"), F.lit("keys/private"), ring, "opened")
    return opened.select(
        "record_offset", F.coalesce(masking.is_token(F.col("token")), F.lit(False)).alias("whole"), "opened"
    )


@query("jwe_wrong_key", f"""WITH {MESSAGES} SELECT count(*) AS records, count(pan) AS tokens, CAST(0 AS BIGINT) AS opened FROM msg""")
def jwe_wrong_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = sample.key_ring(spark)
    flat = sample.spread(sample.messages(spark, sf_dir).select("pan"))
    sealed = tokens.encrypt_text(flat, F.col("pan"), F.lit("keys/private"), ring, "token")
    opened = tokens.decrypt_text(sealed, F.col("token"), F.lit("keys/partner-1"), ring, "wrong")
    return opened.agg(
        F.count("*").alias("records"), F.count("token").alias("tokens"), F.count("wrong").alias("opened")
    )


@query("jwe_rekey", f"""WITH {MESSAGES} SELECT record_offset, pan AS opened, CAST(NULL AS VARCHAR) AS old_key FROM msg""")
def jwe_rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = sample.key_ring(spark)
    flat = sample.spread(sample.messages(spark, sf_dir).select("record_offset", "pan"))
    sealed = tokens.encrypt_text(flat, F.col("pan"), F.lit("keys/private"), ring, "token")
    moved = tokens.rekey_text(sealed, F.col("token"), F.lit("keys/private"), F.lit("keys/partner-3"), ring, "moved")
    opened = tokens.decrypt_text(moved, F.col("moved"), F.lit("keys/partner-3"), ring, "opened")
    opened = tokens.decrypt_text(opened, F.col("moved"), F.lit("keys/private"), ring, "old_key")
    return opened.select("record_offset", "opened", "old_key")


@query("record_seal", f"""WITH {MESSAGES}, d AS (SELECT *, CASE WHEN inst_some = 'BIRCH' THEN event_type IS NULL OR NOT (event_type = 'CHARGE' AND event_version = '3.0')
       WHEN inst_some = 'LARCH' THEN TRUE
       WHEN inst_some = 'MAPLE' THEN event_type IS NULL OR event_type = 'CHARGE' OR (event_type = 'SWEEP' AND event_version = '4.0')
       ELSE FALSE END AS wanted FROM msg)
SELECT record_offset, CASE WHEN value_case = 'broken' THEN 'decode' WHEN value_case <> 'null' AND institution IS NULL THEN 'policy' END AS error_stage,
  value_case NOT IN ('null', 'broken') AND institution IS NOT NULL AND wanted AS sealed,
  CASE WHEN value_case NOT IN ('null', 'broken') AND institution IS NOT NULL AND wanted THEN transaction_id END AS opened_id FROM d""")
def record_seal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = sample.key_ring(spark)
    source = decode_dynamic(sample.as_records(sample.spread(sample.messages(spark, sf_dir))))
    done = seal_records(source, sample.policy(spark), ring)
    tenant = H.header(F.col("headers"), "X-Institution-Id")
    armored = tenant != "LARCH"
    data = F.when(armored, F.encode("sealed_value", "US-ASCII")).otherwise(
        F.try_to_binary("sealed_value", F.lit("base64"))
    )
    key = F.when(armored, F.lit("keys/seal-a")).otherwise(F.lit("keys/seal-b"))
    opened = unseal(done, data, armored, key, ring, "plain")
    return opened.select(
        F.col("offset").alias("record_offset"), F.col("error.stage").alias("error_stage"), "sealed",
        F.get_json_object(F.col("plain").cast("string"), "$.transactionId").alias("opened_id"),
    )


SEALING = CONNECTOR | {"transforms": "hide,extract,lock", "transforms.lock.type": "seal"}


@query("seal_step_landing", f"""WITH {STAGED} SELECT transaction_id, institution, CASE
  WHEN inst_some = 'BIRCH' THEN NOT (event_type = 'CHARGE' AND event_version = '3.0') WHEN inst_some = 'LARCH' THEN TRUE
  WHEN inst_some = 'MAPLE' THEN event_type = 'CHARGE' OR (event_type = 'SWEEP' AND event_version = '4.0') ELSE FALSE END AS sealed
FROM routed WHERE error_stage IS NULL""")
def seal_step_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured protect, fold and seal landed as files, read back from them and opened."""
    root, ring = shared_dir(spark, "records"), sample.key_ring(spark)
    connector = Connector.from_config(SEALING, ring=ring, seal_policy=sample.policy(spark))
    connector.run(sample.records(spark, sf_dir), root)
    files = bulk.read_files(spark, root, "*.json").where(~F.contains("file", F.lit("/_dead_letter/")))
    lines = files.select(
        F.explode(F.split(F.regexp_replace(F.col("content").cast("string"), "\n$", ""), "\n")).alias("value"),
        F.regexp_extract("file", "/([^/]+)(/[^/]+){6}/[^/]+$", 1).alias("institution"),
    )
    sealed, armored = ~F.startswith("value", F.lit("{")), F.col("institution") != "LARCH"
    data = F.when(armored, F.encode("value", "US-ASCII")).otherwise(F.try_to_binary("value", F.lit("base64")))
    key = F.when(armored, F.lit("keys/seal-a")).otherwise(F.lit("keys/seal-b"))
    opened = unseal(lines.withColumn("sealed", sealed), F.when(sealed, data), armored, key, ring, "plain")
    text = F.when(F.col("sealed"), F.col("plain").cast("string")).otherwise(F.col("value"))
    return opened.select(F.get_json_object(text, "$.payload.transactionId").alias("transaction_id"), "institution", "sealed")


SEAL_LAYOUT = LayoutOptions(
    ("headers.X-Institution-Id",), labelled=False, path_format="'day'=dd", duration_ms=86_400_000
).with_defaults()

SEALED = f"""WITH {MESSAGES}, chosen AS (SELECT *, {strategy_sql('inst_first')} AS strategy FROM msg),
staged AS (SELECT *, CASE WHEN value_case = 'broken' THEN 'decode' WHEN value_case = 'number' AND strategy = 'MASK' THEN 'protect'
  WHEN value_case = 'null' THEN 'partition' END AS error_stage FROM chosen),
routed AS (SELECT *, kafka_partition % 2 AS part, CASE WHEN error_stage IS NOT NULL THEN concat('_dead_letter/', error_stage)
  ELSE concat(coalesce(institution, 'UNKNOWN'), '/', strftime(record_ts, 'day=%d')) END AS path FROM staged),
{FILES}, files AS (SELECT path, {NAME} AS name, count(*) AS records, min(CASE WHEN error_stage IS NULL THEN inst_some END) AS any_inst,
  arg_min(CASE WHEN error_stage IS NULL THEN coalesce(inst_some, '-') ELSE '-' END, record_offset) AS i,
  arg_min(coalesce(event_type, '-'), record_offset) AS t, arg_min(event_version, record_offset) AS v,
  md5(string_agg(transaction_id, chr(10) ORDER BY record_offset)) AS digest FROM filed GROUP BY path, part, file_no),
judged AS (SELECT *, i = 'LARCH' OR (i = 'BIRCH' AND t = 'REVERSAL') OR (i = 'MAPLE' AND (t = 'CHARGE' OR (t = 'SWEEP' AND v = '4.0'))) AS sealed FROM files)
SELECT path, concat(name, CASE WHEN sealed THEN '.json.pgp' ELSE '.json' END) AS name, sealed, records, digest FROM judged"""


def sealing_chain() -> Chain:
    return Chain([protect_step(PROTECT), fold_step(WRAP), path_step(SEAL_LAYOUT)])


def _stored_files(spark: SparkSession, root: str, stored: DataFrame) -> DataFrame:
    """Read every landed file back, sealed ones through their key, and digest their lines in order."""
    ring = sample.key_ring(spark)
    kinds = [
        bulk.open_folder(spark, f"{root}/{{BIRCH,MAPLE}}", ring, "keys/seal-a", True, "*.json.pgp"),
        bulk.open_folder(spark, f"{root}/LARCH", ring, "keys/seal-b", False, "*.json.pgp"),
    ]
    sealed_lines = kinds[0].unionByName(kinds[1]).select(
        "file", "frame", F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("at", "line")
    ).select("file", (F.col("frame") + F.col("at")).alias("at"), "line")
    # A plain file holds at most flush_size records.
    listed = bulk.read_files(spark, root, "*.json").where(~F.contains("file", F.lit(f"/{LOG}/")))
    plain = listed.select(
        "file",
        F.posexplode(F.split(F.regexp_replace(F.col("content").cast("string"), "\n$", ""), "\n")).alias("at", "line"),
    )
    lines = sealed_lines.unionByName(plain.select("file", F.col("at").cast("bigint"), "line"))
    record_id = F.coalesce(F.get_json_object("line", "$.payload.transactionId"), F.get_json_object("line", "$.key"))
    ordered = F.array_sort(F.collect_list(F.struct("at", record_id.alias("id"))))
    digests = lines.groupBy(
        F.regexp_extract("file", "([^/]+/[^/]+)/[^/]+$", 1).alias("path"),
        F.regexp_extract("file", "([^/]+)$", 1).alias("name"),
    ).agg(
        F.count("*").alias("records"),
        F.md5(F.array_join(F.transform(ordered, lambda r: r["id"]), "\n").cast("binary")).alias("digest"),
    )
    return digests.join(stored.select("path", "name", "sealed"), ["path", "name"], "left").select(
        "path", "name", "sealed", "records", "digest"
    )


@query("seal_roundtrip", SEALED)
def seal_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "sealed")
    batch = sealing_chain()(decode_dynamic(sample.records(spark, sf_dir)))
    stored = land_batch(batch, root, f"{root}/_manifest", SHARP, sample.policy(spark), sample.key_ring(spark))
    return _stored_files(spark, root, stored)


# A file closes with its micro-batch: numbers start anew in each.
SEALED_BY_BATCH = SEALED.replace(FILES, FILES.replace("PARTITION BY part, path", f"PARTITION BY part, path, {sample.BATCH_SQL}")).replace(
    "GROUP BY path, part, file_no", f"GROUP BY path, part, {sample.BATCH_SQL}, file_no")


@query("stream_landing", SEALED_BY_BATCH)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered in several micro-batches that arrive out of order."""
    root, checkpoint = shared_dir(spark, "streamed"), shared_dir(spark, "checkpoint")
    for source in sample.deliveries(spark, sf_dir):
        stream_files(
            source, lambda df: sealing_chain()(decode_dynamic(df)), root, checkpoint, SHARP, sample.policy(spark),
            sample.key_ring(spark),
        ).awaitTermination()
    return _stored_files(spark, root, spark.read.option("basePath", f"{root}/_manifest").parquet(f"{root}/_manifest"))


@query("stream_rate", RATE)
def stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, checkpoint = shared_dir(spark, "rates"), shared_dir(spark, "checkpoint")
    for source in sample.deliveries(spark, sf_dir):
        stream_rates(source, "timestamp", root, checkpoint).awaitTermination()
    return latest_rates(spark.read.parquet(root)).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("second"), "records"
    )


@query("bulk_files", """SELECT lang, count(*) AS documents, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes,
  min(md5(text)) AS least, max(md5(text)) AS greatest FROM documents GROUP BY lang""")
def bulk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written to files, sealed and unsealed as files in small ranges, then read again."""
    base = shared_dir(spark, "bulk")
    ring = sample.key_ring(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    documents.write.partitionBy("lang").json(f"{base}/plain")
    for armor in (False, True):
        kind = "armored" if armor else "binary"
        source = f"{base}/plain" if not armor else f"{base}/opened-binary"
        bulk.seal_folder(
            spark, source, f"{base}/{kind}", ring, "keys/seal-a", armor, "*.json", range_bytes=100_000
        )
        bulk.unseal_folder(spark, f"{base}/{kind}", f"{base}/opened-{kind}", ring, "keys/seal-a", armor)
    opened = spark.read.schema("text string, lang string").json(f"{base}/opened-armored")
    return opened.groupBy("lang").agg(
        F.count("*").alias("documents"), F.sum(F.octet_length("text")).alias("bytes"),
        F.min(F.md5(F.col("text").cast("binary"))).alias("least"), F.max(F.md5(F.col("text").cast("binary"))).alias("greatest"),
    )


@query("disabled_passthrough", f"""WITH {MESSAGES} SELECT record_offset, institution IN ('BIRCH', 'LARCH', 'MAPLE') AND institution IS NOT NULL AND pan IS NOT NULL AS sealed,
  pan AS opened FROM msg""")
def disabled_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenant with sealing switched off, or empty content, keeps the data as it is."""
    from quayside.operators.seal import seal

    ring, pol = sample.key_ring(spark), sample.policy(spark)
    flat = sample.spread(sample.messages(spark, sf_dir).select("record_offset", "institution", "pan"))
    joined = pol.attach(flat, F.col("institution"))
    content = F.encode("pan", "UTF-8")
    wanted = F.col("policy.enc_enabled") & (F.octet_length(content) > 0)
    sealed = seal(
        joined, F.when(wanted, content), F.col("policy.public_key"), F.col("policy.armor"), ring, "data", compress=False
    )
    data = F.coalesce(F.col("data"), content)
    changed = F.col("data").isNotNull()
    key = F.coalesce(F.col("policy.public_key"), F.lit(""))
    opened = unseal(
        sealed.withColumn("stored", data), F.when(changed, F.col("data")), F.col("policy.armor"), key, ring, "plain"
    )
    return opened.select(
        "record_offset", changed.alias("sealed"),
        F.when(changed, F.col("plain")).otherwise(F.col("stored")).cast("string").alias("opened"),
    )


# ---------------------------------------------------------------- files that roll exactly, stay open, or are committed

EXACT = FileOptions(flush_size=25, rotate_ms=7_200_000, rotate_exact=True, chunk_offsets=512)


@query("file_rotation_exact", f"""WITH RECURSIVE {MESSAGES}, {COARSE},
numbered AS (SELECT *, row_number() OVER (PARTITION BY part, path ORDER BY record_offset) - 1 AS n FROM routed),
follows AS (SELECT a.part, a.path, a.n, min(b.n) AS m FROM numbered a JOIN numbered b ON a.part = b.part AND a.path = b.path AND b.n > a.n AND b.n <= a.n + 25
  AND (b.n = a.n + 25 OR epoch_ms(b.record_ts) - epoch_ms(a.record_ts) >= 7200000) GROUP BY 1, 2, 3),
starts(part, path, n) AS (SELECT part, path, n FROM numbered WHERE n = 0 UNION ALL SELECT s.part, s.path, f.m FROM starts s JOIN follows f USING (part, path, n)),
marked AS (SELECT numbered.*, s.n AS start_n FROM numbered LEFT JOIN starts s ON s.part = numbered.part AND s.path = numbered.path AND s.n = numbered.n),
filed AS (SELECT *, max(start_n) OVER (PARTITION BY part, path ORDER BY n) AS file_no FROM marked)
SELECT path, {NAME} AS name, max(record_offset) AS end_offset, count(*) AS records FROM filed GROUP BY path, part, file_no""")
def file_rotation_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file ends two hours after its own first record, or with 25 records."""
    return manifest(assign_files(coarse(spark, sf_dir), EXACT), EXACT).select("path", "name", "end_offset", "records")


OPEN_LAYOUT = LayoutOptions(("headers.X-Institution-Id",), labelled=False, path_format="'all'", duration_ms=86_400_000).with_defaults()
WIDE = FileOptions(flush_size=100, frame_bytes=4_096)


def open_chain() -> Chain:
    return Chain([protect_step(PROTECT), fold_step(WRAP), path_step(OPEN_LAYOUT)])


@query("stream_open_files", SEALED.replace("strftime(record_ts, 'day=%d')", "'all'").replace("// 10 AS", "// 100 AS"))
def stream_open_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six micro-batches in order; files stay open between them, so they are those of one batch over all records."""
    root, checkpoint = shared_dir(spark, "open"), shared_dir(spark, "checkpoint")
    policy, ring = sample.policy(spark), sample.key_ring(spark)
    stream_open_files(
        sample.ordered_deliveries(spark, sf_dir, 6), lambda df: open_chain()(decode_dynamic(df)), root, checkpoint, WIDE, policy, ring,
    ).awaitTermination()
    land_open_files(spark, root, checkpoint, WIDE, policy, ring)
    return _stored_files(spark, root, committed_files(spark, root))


@query("landed_snapshot", f"""WITH {MESSAGES}, {COARSE}, dealt AS (SELECT *, record_offset % 3 AS batch FROM routed),
filed AS (SELECT *, (row_number() OVER (PARTITION BY batch, part, path ORDER BY record_offset) - 1) // 10 AS file_no FROM dealt WHERE batch <> 1)
SELECT batch, path, concat({NAME}, '.json') AS name, count(*) AS records, md5(string_agg(transaction_id, chr(10) ORDER BY record_offset)) AS digest,
  CAST(0 AS BIGINT) AS left_over FROM filed GROUP BY batch, path, part, file_no""")
def landed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, of which the second fails while its files are being written: readers see the others whole, and its remains go."""
    root = shared_dir(spark, "committed")
    lines = coarse(spark, sf_dir).drop("institution", "event_type", "event_version")
    for batch in range(3):
        frames = seal_frames(file_frames(assign_files(lines.where(F.col("offset") % 3 == batch), SHARP), SHARP), None, None)
        if batch == 1:
            frames = frames.withColumn("content", F.when(F.xxhash64("name") % 5 != 0, F.col("content")))
        try:
            land_committed(frames, root, batch)
        except PySparkException:
            if batch != 1:
                raise
    remove_uncommitted(spark, root)
    left = uncommitted_files(spark, root).count()
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    digests = landed_lines(spark, root).groupBy("path", "name").agg(F.md5(F.array_join(ordered, "\n").cast("binary")).alias("digest"))
    files = committed_files(spark, root).join(digests, ["path", "name"], "left")
    return files.select("batch", "path", "name", "records", "digest", F.lit(left).cast("bigint").alias("left_over"))


TEMPLATES = """
{"banks": {
  "ALDER": {"s3_config": {"bucket": "first", "object_key_template": "alder/year={{yyyy}}/month={{MM}}/day={{dd}}/{{topic}}-{{partition}}.json"}},
  "CEDAR": {"s3_config": {"bucket": "second", "object_key_template": "{{headers.X-Event-Type}}/{{HH}}/"}},
  "LARCH": {"s3_config": {"bucket": "second", "object_key_template": "larch/{{topic}}/p{{partition}}/{{yyyy-MM-dd}}/"}},
  "MAPLE": {"s3_config": {"bucket": "first", "object_key_template": "{{headers.X-Event-Type}}/{{HH}}/"}},
  "BIRCH": {"s3_config": {"bucket": "first", "path_prefix": "birch"}}},
 "default": {"s3_config": {"bucket": "first", "path_prefix": "others"}}}
"""


@query("tenant_layouts", f"""WITH {STAGED}, placed AS (SELECT *, CASE inst_some WHEN 'CEDAR' THEN 'second' WHEN 'LARCH' THEN 'second' ELSE 'first' END AS bucket,
  CASE WHEN value_case = 'broken' THEN 'decode' WHEN value_case = 'null' OR (inst_some IN ('CEDAR', 'MAPLE') AND event_type IS NULL) THEN 'partition' END AS failed,
  CASE inst_some WHEN 'ALDER' THEN strftime(record_ts, 'alder/year=%Y/month=%m/day=%d') WHEN 'CEDAR' THEN concat(event_type, strftime(record_ts, '/%H'))
    WHEN 'MAPLE' THEN concat(event_type, strftime(record_ts, '/%H')) WHEN 'LARCH' THEN concat('larch/card-events/p', part, strftime(record_ts, '/%Y-%m-%d'))
    WHEN 'BIRCH' THEN strftime(record_ts, 'birch/day=%d') ELSE strftime(record_ts, 'others/day=%d') END AS folder FROM routed)
SELECT bucket AS root, folder AS path, count(*) AS records, min(transaction_id) AS first_id, max(transaction_id) AS last_id
FROM placed WHERE failed IS NULL GROUP BY 1, 2""")
def tenant_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan, one write: each tenant's own folders below the root of its bucket."""
    base = shared_dir(spark, "layouts")
    roots = {"first": f"{base}/first", "second": f"{base}/second"}
    policy = policy_from_text(spark, TEMPLATES)
    folded = fold_headers(decode_dynamic(sample.records(spark, sf_dir)), WRAP)
    plain = LayoutOptions((), path_format="'day='dd", duration_ms=86_400_000)
    placed = add_tenant_layout(folded, policy, H.header(F.col("headers"), "X-Institution-Id"), plain)
    land_batch(placed, f"{base}/rest", f"{base}/_manifest", FileOptions(), None, None, roots=roots)
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(list(roots.values()))
    below = F.substring_index(F.col("_metadata.file_path"), f"/{base.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    where, path = F.substring_index(below, "/", 1), F.regexp_extract(below, "^[^/]+/(.*)/[^/]+$", 1)
    record_id = F.get_json_object("value", "$.payload.transactionId")
    return lines.groupBy(where.alias("root"), path.alias("path")).agg(
        F.count("*").alias("records"), F.min(record_id).alias("first_id"), F.max(record_id).alias("last_id"))


# ---------------------------------------------------------------- rules as a table, keys with a history

RULE_ROWS = """SELECT CAST(CASE WHEN j = 6 THEN 10000000 + c_custkey ELSE c_custkey * 7 + j + 1 END AS INT) AS rule_no,
  CASE WHEN j = 6 THEN '*' WHEN j = 3 THEN concat('c', CAST(c_custkey AS VARCHAR(20))) ELSE concat('C', CAST(c_custkey AS VARCHAR(20))) END AS customer,
  CASE WHEN j = 2 OR (j = 5 AND c_custkey % 4 = 0) THEN '*' ELSE CASE (c_custkey + j) % 5 WHEN 0 THEN '1-urgent' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
    WHEN 3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END END AS priority,
  CASE WHEN j = 1 OR (j = 5 AND c_custkey % 4 = 0) THEN '*' ELSE CASE (c_custkey + j) % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'o' ELSE 'P' END END AS status,
  CASE (c_custkey + j) % 4 WHEN 0 THEN 'MASK' WHEN 1 THEN 'REMOVE' WHEN 2 THEN 'DECRYPT' ELSE 'NONE' END AS outcome
FROM {customer} CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6)) AS v(j)"""
ORDER_ROWS = """SELECT o_orderkey, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE concat('C', CAST(o_custkey AS VARCHAR(20))) END AS customer,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_orderstatus AS status FROM {orders}"""


@query("rules_table", f"""WITH rules AS ({RULE_ROWS.format(customer='customer')}), o AS ({ORDER_ROWS.format(orders='orders')}),
seen AS (SELECT DISTINCT customer, priority, status FROM o),
hit AS (SELECT seen.customer, seen.priority, seen.status, min(rule_no) AS rule_no FROM seen JOIN rules r ON (r.customer = '*' OR lower(r.customer) = lower(seen.customer))
  AND (r.priority = '*' OR lower(r.priority) = lower(seen.priority)) AND (r.status = '*' OR lower(r.status) = lower(seen.status)) GROUP BY 1, 2, 3)
SELECT o_orderkey, hit.rule_no, rules.outcome FROM o LEFT JOIN hit ON o.customer IS NOT DISTINCT FROM hit.customer AND o.priority IS NOT DISTINCT FROM hit.priority
  AND o.status IS NOT DISTINCT FROM hit.status LEFT JOIN rules ON rules.rule_no = hit.rule_no""")
def rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven rules for each customer: 10,500 at the size of the correctness run."""
    rules = spark.sql(RULE_ROWS, customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))
    orders = spark.sql(ORDER_ROWS, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    matched = match_rule_table(orders, rules, ["customer", "priority", "status"])
    return matched.select("o_orderkey", "matched.rule_no", "matched.outcome")


@query("rules_table_tenant", f"""WITH rules AS ({RULE_ROWS.format(customer='customer')}), o AS ({ORDER_ROWS.format(orders='orders')}),
hit AS (SELECT o_orderkey, min(r.rule_no) AS rule_no FROM o JOIN rules r ON r.customer = o.customer AND (r.priority = '*' OR lower(r.priority) = lower(o.priority))
  AND (r.status = '*' OR lower(r.status) = lower(o.status)) GROUP BY 1)
SELECT o.o_orderkey, hit.rule_no, rules.outcome FROM o LEFT JOIN hit USING (o_orderkey) LEFT JOIN rules ON rules.rule_no = hit.rule_no""")
def rules_table_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules as each customer's own list: only rows of exactly that customer follow it."""
    rules = spark.sql(RULE_ROWS, customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))
    orders = spark.sql(ORDER_ROWS, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    matched = match_rule_table(orders, rules, ["priority", "status"], scope=F.col("customer"), rule_scope="customer")
    return matched.select("o_orderkey", "matched.rule_no", "matched.outcome")


# Sixty keys for each of five tenants: periods overlap, end early or leave gaps; some are disabled, some open at an end.
KEY_ROWS = """SELECT id, concat('keys/', id, '-', CAST(n AS VARCHAR(9))) AS public_key, CAST(NULL AS VARCHAR(9)) AS key_id, n % 7 <> 3 AS enabled,
  CASE WHEN n = 0 AND k = 1 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(n * 12 + k - n % 2 AS INT) END AS valid_from,
  CASE WHEN n = 57 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(n * 12 + k + CASE n % 5 WHEN 0 THEN 4 WHEN 1 THEN 60 WHEN 2 THEN 13
    WHEN 3 THEN 20 ELSE 2 END AS INT) END AS valid_to
FROM (SELECT DISTINCT event_id % 60 AS n FROM {events}) CROSS JOIN (VALUES ('ALDER', 0), ('BIRCH', 1), ('CEDAR', 2), ('LARCH', 3), ('MAPLE', 4)) AS t(id, k)"""


@query("key_as_of", f"""WITH {MESSAGES}, k AS ({KEY_ROWS.format(events='events')}),
fit AS (SELECT record_offset, public_key, coalesce(valid_from, TIMESTAMP '1900-01-01') AS since FROM msg JOIN k ON k.id = institution AND enabled
  AND (valid_from IS NULL OR valid_from <= record_ts) AND (valid_to IS NULL OR record_ts < valid_to)),
best AS (SELECT record_offset, public_key FROM fit QUALIFY row_number() OVER (PARTITION BY record_offset ORDER BY since DESC, public_key DESC) = 1)
SELECT record_offset, public_key, CASE WHEN public_key IS NULL THEN 'key' END AS error_stage FROM msg LEFT JOIN best USING (record_offset)""")
def key_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.sql(KEY_ROWS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    flat = sample.messages(spark, sf_dir)
    found = attach_key_as_of(flat, F.col("institution"), keys, "public_key", F.col("record_ts").cast("timestamp"))
    return found.select("record_offset", "public_key", F.col("error.stage").alias("error_stage"))


# ---------------------------------------------------------------- replay of a stored topic

@query("topic_replay", f"""WITH {MESSAGES}, kept AS (SELECT kafka_partition % 2 AS part, record_offset, transaction_id FROM msg),
late AS (SELECT part, max(record_offset) // 2 AS middle FROM kept GROUP BY part)
SELECT 'earliest' AS start, part, count(*) AS records, min(record_offset) AS first_offset, max(record_offset) AS last_offset,
  count(DISTINCT transaction_id) AS ids FROM kept GROUP BY part
UNION ALL SELECT 'given', part, count(*), min(record_offset), max(record_offset), count(DISTINCT transaction_id) FROM kept JOIN late USING (part)
  WHERE part = 1 AND record_offset >= middle GROUP BY part
UNION ALL SELECT 'latest', part, count(*), min(record_offset), max(record_offset), count(DISTINCT transaction_id) FROM kept
  WHERE record_offset >= 3 * (SELECT max(event_id) + 1 FROM events) / 4 GROUP BY part""")
def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored topic read from its beginning in bounded micro-batches, from given offsets, and from its end while it grows."""
    log = shared_dir(spark, "log")
    flat = sample.messages(spark, sf_dir)
    size = flat.agg(F.max("record_offset")).first()[0] + 1
    early = F.col("record_offset") * 4 < 3 * size
    append_records(sample.as_records(flat.where(early)), log, 500)
    tops = {r["p"]: r["m"] for r in flat.groupBy((F.col("kafka_partition") % 2).alias("p")).agg(F.max("record_offset").alias("m")).collect()}

    def replay(start: str, limit: int | None, between=lambda: None) -> str:
        root, checkpoint = shared_dir(spark, "replayed"), shared_dir(spark, "checkpoint")

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.selectExpr("partition", "offset", "cast(key AS string) AS key").write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

        source = read_records(spark, log, start, max_per_trigger=limit, checkpoint=checkpoint)
        run = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
        try:
            run.processAllAvailable()
            between()
            run.processAllAvailable()
        finally:
            run.stop()
        return root

    latest = replay("latest", None, lambda: append_records(sample.as_records(flat.where(~early)), log, 500))
    given = json.dumps({"card-events": {"0": -1, "1": tops[1] // 2}})
    roots = {"earliest": replay("earliest", max(size // 6, 1)), "given": replay(given, None), "latest": latest}
    counted = [
        spark.read.parquet(root).groupBy("partition").agg(
            F.count("*").alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.countDistinct("key").alias("ids"),
        ).select(F.lit(name).alias("start"), F.col("partition").alias("part"), "records", "first_offset", "last_offset", "ids")
        for name, root in roots.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])



# ---------------------------------------------------------------- audit of landed offsets

# Two batches, the second of which lands the end of the first again; some offsets never land, some twice.
LANDED_OFFSETS = """SELECT 'card-events' AS topic, kafka_partition % 2 AS part, CAST(floor(record_offset / 2) AS BIGINT) AS o, b AS batch
FROM {messages} CROSS JOIN (VALUES (0), (1)) AS t(b) CROSS JOIN (VALUES (0), (1)) AS r(again)
WHERE floor(record_offset / 2) % 97 <> 5 AND floor(record_offset / 2) NOT BETWEEN 40 AND 52
  AND (b = 0 AND floor(record_offset / 2) < 260 OR b = 1 AND floor(record_offset / 2) >= 250) AND (again = 0 OR floor(record_offset / 2) % 211 = 7)"""


@query("offset_gaps", f"""WITH {MESSAGES}, landed AS ({LANDED_OFFSETS.format(messages='messages')}),
here AS (SELECT part, o, count(DISTINCT batch) AS batches FROM landed GROUP BY 1, 2),
ends AS (SELECT part, min(o) AS a, max(o) AS z FROM here GROUP BY part),
every AS (SELECT part, unnest(range(a, z + 1)) AS o FROM ends),
marked AS (SELECT part, o, 'missing' AS kind FROM every ANTI JOIN here USING (part, o) UNION ALL SELECT part, o, 'overlap' FROM here WHERE batches > 1),
runs AS (SELECT part, kind, o, o - row_number() OVER (PARTITION BY part, kind ORDER BY o) AS run FROM marked),
per AS (SELECT part, batch, o, count(*) AS n FROM landed GROUP BY 1, 2, 3),
lands AS (SELECT *, o - row_number() OVER (PARTITION BY part, batch ORDER BY o) AS run FROM per)
SELECT part, kind, min(o) AS first_offset, max(o) AS last_offset, count(*) AS records FROM runs GROUP BY part, kind, run
UNION ALL SELECT part, 'repeated', min(o), max(o), CAST(sum(n) - count(*) AS BIGINT) FROM lands GROUP BY part, batch, run HAVING sum(n) > count(*)""")
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.sql(LANDED_OFFSETS, messages=sample.messages(spark, sf_dir))
    shaped = landed.select("topic", F.col("part").alias("partition"), F.col("o").alias("offset"), "batch")
    faults = offset_faults(offset_islands(shaped, F.col("batch"), chunk=64))
    return faults.select(F.col("partition").alias("part"), "kind", F.col("first").alias("first_offset"), F.col("last").alias("last_offset"), "records")


# ---------------------------------------------------------------- values that are plain strings

STRING_VALUE = """CASE record_offset % 4 WHEN 0 THEN concat('"note ', transaction_id, ' \\\\"q\\\\" caf\\\\u00e9"') WHEN 1 THEN '"true"' WHEN 2 THEN '17' ELSE concat('{"a":"', transaction_id, '"}') END"""


@query("strings_raw", f"""WITH {MESSAGES} SELECT record_offset, CASE WHEN record_offset % 4 = 2 THEN 'decode' END AS error_stage,
  CASE record_offset % 4 WHEN 0 THEN concat('note ', transaction_id, ' "q" café') WHEN 1 THEN 'true' WHEN 3 THEN concat('{{"a":"', transaction_id, '"}}') END AS line,
  CASE WHEN record_offset % 4 = 2 THEN '_dead_letter/decode' ELSE {HOUR} END AS path FROM msg""")
def strings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON string lands as its text; numbers are still no records."""
    value = F.expr(STRING_VALUE).cast("binary")
    named = sample.records(spark, sf_dir).withColumn("transaction_id", F.col("key").cast("string")).withColumn("record_offset", F.col("offset"))
    lines = route(add_path(decode_dynamic(named.withColumn("value", value), plain_strings=True), LayoutOptions(())))
    failed = F.col("error").isNotNull()
    return lines.select("record_offset", F.col("error.stage").alias("error_stage"), F.when(~failed, F.col("line")).alias("line"), "path")
