"""Reading keyed messages with headers, and decoding their JSON values.

Every step accepts any DataFrame with the columns of Spark's Kafka source (``includeHeaders`` on):
key, value, topic, partition, offset, timestamp, timestampType, headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.once import once
from quayside.session import keep_methods_short

RECORD_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "timestampType", "headers")
KAFKA_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int, "
    "headers array<struct<key:string,value:binary>>"
)
ERROR = "error"
FLAW = "__flaw"
ERROR_TYPE = "struct<stage:string,message:string>"


def topic_options(
    servers: str,
    topics: str,
    start: str = "earliest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: start position and the size of one micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": start,
        "includeHeaders": "true",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:  # split hot topic partitions over several tasks
        options["minPartitions"] = str(min_partitions)
    return options | (extra or {})


def read_topic(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Topic scan; needs the Kafka connector on the cluster's class path."""
    reader = spark.readStream if stream else spark.read
    chosen = {k: v for k, v in options.items() if stream or k != "maxOffsetsPerTrigger"}
    return reader.format("kafka").options(**chosen).load()


def read_record_files(
    spark: SparkSession, path: str, stream: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """The same shape from Parquet files, for replays and for clusters without the connector."""
    if not stream:
        return spark.read.schema(KAFKA_SCHEMA).parquet(path)
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def first_error(df: DataFrame, *checks: tuple[str, Column, Column | str]) -> Column:
    """The row's error so far, or else that of the first (stage, failed, message) check that fails.

    Messages never contain field values.
    """
    found = []
    for stage, failed, message in checks:
        text = F.lit(message) if isinstance(message, str) else message
        found.append(F.when(failed, F.struct(F.lit(stage).alias("stage"), text.alias("message"))))
    before = [F.col(ERROR)] if ERROR in df.columns else [F.lit(None).cast(ERROR_TYPE)]
    return once(F.coalesce(*before, *found).cast(ERROR_TYPE))


def with_error(df: DataFrame, stage: str, failed: Column, message: Column | str) -> DataFrame:
    """Mark rows that fail here; the first failure of a row is the one kept."""
    return df.withColumn(ERROR, first_error(df, (stage, failed, message)))


def decode_dynamic(df: DataFrame, where: Column | str | None = None, plain_strings: bool = False) -> DataFrame:
    """Add ``record`` MAP<STRING,VARIANT> from schemaless JSON values; anything but an object is an error.

    A message without a value passes through with a NULL record. An object that names a member twice is an error: which
    value counts is for the producer to say. ``where`` is a filter on the source columns; placed below the parse, it reaches the scan.
    With ``plain_strings`` a JSON string is no error: its text is ``plain``, the record is NULL, and it lands as that text. It has no
    fields, so only a layout without fields has a place for it.
    """
    keep_methods_short(df.sparkSession)
    df = df if where is None else df.where(where)
    value = F.try_parse_json(F.col("value").cast("string"))
    unread = F.col("value").isNotNull() & F.col("record").isNull()
    if not plain_strings:
        df = df.withColumn("record", once(F.try_variant_get(value, "$", "map<string,variant>")))
        return with_error(df, "decode", unread, "value is not a JSON object")
    df = df.withColumn("__value", once(value))
    text = F.when(F.schema_of_variant("__value") == "STRING", F.try_variant_get("__value", "$", "string"))
    df = df.withColumn("record", once(F.try_variant_get("__value", "$", "map<string,variant>"))).withColumn("plain", once(text)).drop("__value")
    return with_error(df, "decode", unread & F.col("plain").isNull(), "value is neither a JSON object nor a string")


def decode_typed(df: DataFrame, schema: str | T.StructType, where: Column | str | None = None) -> DataFrame:
    """Add ``record`` STRUCT from JSON values of a known schema: only the named fields are kept in memory.

    A value that is no JSON object, or has a field that does not fit its type, is an error.
    """
    keep_methods_short(df.sparkSession)
    df = df if where is None else df.where(where)
    text = F.col("value").cast("string")
    with_flaw = schema.add(FLAW, "string") if isinstance(schema, T.StructType) else f"{schema}, {FLAW} string"
    parsed = once(F.from_json(text, with_flaw, {"columnNameOfCorruptRecord": FLAW}))
    df = df.withColumn("__parsed", parsed)
    whole = F.ltrim(text).startswith("{") & F.col("__parsed")[FLAW].isNull()
    df = df.withColumn("record", once(F.when(whole, F.col("__parsed").dropFields(FLAW)))).drop("__parsed")
    return with_error(
        df, "decode", F.col("value").isNotNull() & F.col("record").isNull(), "value is not a JSON object"
    )
