"""Payment messages derived from the ``events`` table: the input of the registered queries.

The base SELECT is plain SQL that Spark and DuckDB both run. It covers missing tenants, missing types, repeated and
empty headers, absent, null, short, numeric and token-shaped card numbers, missing values and broken JSON.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.rsa import KeyRing, load_key
from quayside.session import shared_dir
from quayside.sources.messages import read_record_files
from quayside.sources.policy import Policy, policy_from_text

BASE_SQL = """
SELECT event_id AS record_offset, CAST(event_id % 20 AS INT) AS kafka_partition, ts AS record_ts, user_id,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN user_id % 6 = 0 THEN 'ALDER' WHEN user_id % 6 = 1 THEN 'BIRCH'
       WHEN user_id % 6 = 2 THEN 'CEDAR' WHEN user_id % 6 = 3 THEN 'LARCH' WHEN user_id % 6 = 4 THEN 'MAPLE'
       ELSE 'ROWAN' END AS institution,
  CASE WHEN event_id % 113 = 0 THEN NULL WHEN event_type = 'purchase' THEN 'CHARGE' WHEN event_type = 'error' THEN 'REVERSAL'
       WHEN event_type = 'view' THEN 'SWEEP' WHEN event_type = 'click' THEN 'CASHOUT' ELSE 'TOPUP' END AS event_type,
  CASE event_id % 3 WHEN 0 THEN '3.0' WHEN 1 THEN '3.1' ELSE '4.0' END AS event_version,
  concat('rec-', CAST(event_id AS VARCHAR(20))) AS transaction_id, value AS amount,
  concat('Shop ', CAST(event_id % 100 AS VARCHAR(20))) AS merchant_name,
  CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN '12345678' WHEN event_id % 107 = 0 THEN 'h.k.i.c.t'
       ELSE concat(CASE event_id % 5 WHEN 0 THEN '9101' WHEN 1 THEN '9202' WHEN 2 THEN '9303' WHEN 3 THEN '9404' ELSE '9505' END,
            lpad(CAST((event_id * 982451 + user_id * 7919) % 1000000000000 AS VARCHAR(20)), 12, '0')) END AS pan,
  CASE WHEN event_id % 89 = 0 THEN 'null' WHEN event_id % 83 = 0 THEN 'broken' WHEN event_id % 79 = 0 THEN 'absent'
       WHEN event_id % 73 = 0 THEN 'number' ELSE 'text' END AS value_case,
  CASE WHEN event_id % 7 = 0 THEN 'stale' WHEN event_id % 11 = 0 THEN 'emptied' ELSE 'single' END AS header_case
FROM {events}
"""

HEADERS = """
concat(
  CASE WHEN institution IS NULL THEN cast(array() AS array<struct<key:string,value:binary>>)
       WHEN header_case = 'stale' THEN array(
         named_struct('key', 'X-Institution-Id', 'value', cast(NULL AS binary)),
         named_struct('key', 'X-Institution-Id', 'value', cast('STALE' AS binary)),
         named_struct('key', 'X-Institution-Id', 'value', cast(institution AS binary)))
       WHEN header_case = 'emptied' THEN array(
         named_struct('key', 'X-Institution-Id', 'value', cast(institution AS binary)),
         named_struct('key', 'X-Institution-Id', 'value', cast(NULL AS binary)))
       ELSE array(named_struct('key', 'X-Institution-Id', 'value', cast(institution AS binary))) END,
  CASE WHEN event_type IS NULL THEN cast(array() AS array<struct<key:string,value:binary>>)
       ELSE array(named_struct('key', 'X-Event-Type', 'value', cast(event_type AS binary))) END,
  array(named_struct('key', 'X-Event-Version', 'value', cast(event_version AS binary)),
        named_struct('key', 'X-Event-Id', 'value', cast(cast(record_offset AS string) AS binary))),
  CASE WHEN user_id % 4 = 0 THEN cast(array() AS array<struct<key:string,value:binary>>)
       ELSE array(named_struct('key', 'X-User-Id', 'value', cast(cast(user_id AS string) AS binary))) END)
"""

VALUE = """
CASE value_case WHEN 'null' THEN NULL WHEN 'broken' THEN '{"transactionId":' ELSE concat(
  '{"transactionId":"', transaction_id, '","amount":', coalesce(cast(amount AS string), 'null'), ',"currency":"EUR",',
  CASE WHEN value_case = 'absent' THEN '' WHEN value_case = 'number' THEN '"encryptedPrimaryAccountNumber":42,'
       WHEN pan IS NULL THEN '"encryptedPrimaryAccountNumber":null,'
       ELSE concat('"encryptedPrimaryAccountNumber":"', pan, '",') END,
  '"merchantName":"', merchant_name, '"}') END
"""

PAYLOAD_SCHEMA = (
    "transactionId string, amount double, currency string, encryptedPrimaryAccountNumber string, merchantName string"
)

POLICY_TEXT = """
{"banks": {
  "ALDER": {"name": "First", "pan_strategy": "REMOVE",
    "pan_config": {"source_field": "encryptedPrimaryAccountNumber"},
    "pgp_encryption": {"enabled": false, "rules": "*:*:ENCRYPT"},
    "s3_config": {"bucket": "landing", "path_prefix": "alder"}},
  "BIRCH": {"name": "Second", "pan_strategy": "DECRYPT",
    "pan_config": {"target_field": "primaryAccountNumber", "private_key_path": "keys/private"},
    "pgp_encryption": {"enabled": true, "public_key_path": "keys/seal-a", "armor": true,
                       "rules": "CHARGE:3.0:SKIP,reversal:*:encrypt"},
    "s3_config": {"bucket": "landing", "path_prefix": "birch"}},
  "CEDAR": {"name": "Third", "pan_strategy": "REKEY",
    "pan_config": {"source_field": "encryptedPrimaryAccountNumber", "target_field": "encryptedPrimaryAccountNumber",
                   "private_key_path": "keys/private"},
    "s3_config": {"bucket": "isolated", "path_prefix": "cedar"}},
  "LARCH": {"name": "Fourth", "pan_strategy": "MASK", "pan_config": {"target_field": "maskedNumber"},
    "pgp_encryption": {"enabled": true, "public_key_path": "keys/seal-b", "armor": false},
    "s3_config": {"bucket": "landing", "path_prefix": "larch"}},
  "MAPLE": {"name": "Fifth", "pan_strategy": "DECRYPT",
    "pan_config": {"target_field": "tokenizedPAN", "private_key_path": "keys/private", "tokenize": true},
    "pgp_encryption": {"enabled": true, "public_key_path": "keys/seal-a", "armor": true,
                       "rules": "CHARGE:*:ENCRYPT,SWEEP:4.0:ENCRYPT,*:*:SKIP"},
    "s3_config": {"bucket": "landing", "path_prefix": "maple"}},
  "FIR": {"name": "Sixth", "pan_strategy": "NONE"}},
 "default": {"name": "Others", "pan_strategy": "MASK", "pgp_encryption": {"enabled": false, "rules": "*:*:SKIP"},
    "s3_config": {"bucket": "landing", "path_prefix": "default"}}}
"""

PARTNER_TEXT = """
{"version": "1.0", "keys": {
  "ALDER": {"publicKeyPath": "keys/partner-1", "keyId": "k1", "enabled": true},
  "BIRCH": {"publicKeyPath": "keys/partner-1", "keyId": "k2", "enabled": false},
  "CEDAR": {"publicKeyPath": "keys/partner-3", "keyId": "k3", "enabled": true,
             "validFrom": "2023-01-01T00:00:00Z", "validTo": "2030-01-01T00:00:00Z"},
  "LARCH": {"publicKeyPath": "keys/partner-1", "keyId": "k4", "enabled": true,
           "validFrom": "2024-01-10T00:00:00Z", "validTo": "2024-01-20T00:00:00Z"}}}
"""

PARTITION_MAP = "# tenant,partition\nALDER,0\nBIRCH,1\nCEDAR,2\n# others are hashed\nDOGWOOD,3\nELDER,4\n"

KEY_IDS = ("keys/private", "keys/partner-1", "keys/partner-3", "keys/seal-a", "keys/seal-b")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat messages, one row per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(BASE_SQL, events=events)


# Rows of a task of costly row work: its time stays the same however large the table is.
TASK_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Use every core for costly row work, in tasks of bounded size; splits that are already small enough stay as they are.

    A split of a file is cut by bytes, and a few bytes of a narrow table are many messages.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def as_records(flat: DataFrame) -> DataFrame:
    """The same rows in the shape of the Kafka source."""
    return flat.selectExpr(
        "cast(transaction_id AS binary) AS key",
        f"cast({VALUE} AS binary) AS value",
        "'card-events' AS topic",
        "kafka_partition % 2 AS partition",
        "record_offset AS offset",
        "cast(record_ts AS timestamp) AS timestamp",
        "0 AS timestampType",
        f"{HEADERS} AS headers",
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(spread(messages(spark, sf_dir)))


# The delivery that a record belongs to, of four of about equal size; DuckDB and Spark both run it.
BATCH_SQL = "floor(record_offset * 4 / (SELECT max(event_id) + 1 FROM events))"


def deliveries(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """All records in four deliveries, the newest not last: before each a stream over all that has come is given.

    A stream that ends when everything available is read, restarted with its checkpoint, thus takes one micro-batch each.
    """
    folder = shared_dir(spark, "deliveries")
    flat = messages(spark, sf_dir)
    size = flat.agg(F.max("record_offset")).first()[0] + 1
    batch = F.floor(F.col("record_offset") * 4 / F.lit(size))
    for part in (2, 0, 3, 1):
        as_records(spread(flat.where(batch == part))).write.mode("append").parquet(folder)
        yield read_record_files(spark, folder)


def ordered_deliveries(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """A stream over all records in ``parts`` deliveries of about equal size, in offset order, one micro-batch each."""
    folder = shared_dir(spark, "ordered")
    flat = messages(spark, sf_dir)
    size = flat.agg(F.max("record_offset")).first()[0] + 1
    batch = F.floor(F.col("record_offset") * parts / F.lit(size))
    for part in range(parts):
        # Files are taken in order of their modification times, so each delivery is one file.
        as_records(flat.where(batch == part)).coalesce(1).write.mode("append").parquet(folder)
    return read_record_files(spark, folder, files_per_trigger=1)


def policy(spark: SparkSession) -> Policy:
    return policy_from_text(spark, POLICY_TEXT)


def new_key(spark: SparkSession, bits: int = 2048) -> str:
    """A new private key (PKCS#8, base64) from the JVM's key generator."""
    jvm = spark.sparkContext._jvm
    generator = jvm.java.security.KeyPairGenerator.getInstance("RSA")
    generator.initialize(bits)
    pair = generator.generateKeyPair()
    factory = jvm.java.security.KeyFactory.getInstance("RSA")
    spec = jvm.java.lang.Class.forName("java.security.spec.PKCS8EncodedKeySpec")
    encoded = factory.getKeySpec(pair.getPrivate(), spec).getEncoded()
    return base64.encodebytes(bytes(encoded)).decode()


_RINGS: dict[int, KeyRing] = {}


def key_ring(spark: SparkSession, bits: int = 2048) -> KeyRing:
    """Fresh key pairs, made once per process; none are stored."""
    if bits not in _RINGS:
        keys = {name: load_key(new_key(spark, bits)) for name in KEY_IDS}
        _RINGS[bits] = KeyRing(keys)
    return _RINGS[bits]

