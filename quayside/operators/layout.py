"""Assigning records to partition paths and to numbered output files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.once import once
from quayside.functions.paths import field_segment, nested, safe_segment, time_segment
from quayside.options import FileOptions, LayoutOptions
from quayside.session import require_utc
from quayside.sources.messages import first_error, with_error
from quayside.sources.policy import Policy

DEAD_LETTER = "_dead_letter"
FILE_KEY = ["topic", "partition", "path", "rotation", "file_no"]


def add_path(df: DataFrame, options: LayoutOptions) -> DataFrame:
    """Add ``path``; a missing record or partition field is an error row unless the layout names a default."""
    require_utc(df.sparkSession)
    values = {name: nested(df, name) for name in options.fields}
    defaults = dict(options.defaults)
    timed = F.col("timestamp").isNotNull()
    # A plain string has no fields: without any in the layout it has a place, else its fields are null.
    present = F.col("record").isNotNull() | F.col("plain").isNotNull() if "plain" in df.columns else F.col("record").isNotNull()
    checks = [
        ("partition", ~present, "record has no value"),
        ("partition", ~timed, "record has no timestamp"),
    ]
    checks += [
        ("partition", value.isNull(), f"partition field {name} is null")
        for name, value in values.items() if name not in defaults
    ]
    when = time_segment(F.col("timestamp"), options)
    fields = field_segment(values, options)  # NULL when a field without default is
    whole = F.concat(fields, F.lit(options.delimiter), when) if options.fields else when
    fine = present & timed
    if "error" in df.columns:
        fine = fine & F.col("error").isNull()
    return df.select(
        *[c for c in df.columns if c not in ("error", "path")], first_error(df, *checks).alias("error"),
        once(F.when(fine, whole)).alias("path"),
    )


def add_tenant_prefix(df: DataFrame, policy: Policy, tenant: Column) -> DataFrame:
    """Put each tenant's bucket and path prefix before its path."""
    joined = policy.attach(df, tenant, "__place")
    place = F.concat_ws("/", F.col("__place.bucket"), F.col("__place.path_prefix"), F.col("path"))
    return joined.withColumn("path", F.when(F.col("path").isNotNull(), place)).drop("__place")


_SLOT = re.compile(r"\{\{(.*?)\}\}")
# What a slot of letters like these means: a part of the record's time.
_TIME_SLOT = re.compile(r"[yMdHhms][yMdHhms:._-]*")


def template_folder(df: DataFrame, template: str, zone: str = "UTC") -> Column:
    """The folder that an object key template gives a record; NULL where a field in it is missing.

    Slots in double braces are ``topic``, ``partition``, a time pattern (``yyyy``, ``MM``, ``yyyy-MM-dd``), or a dotted field of the record, whose
    value becomes one folder name. What follows the last slash is the file's name, which stays that of the package.
    """
    folder = template.rpartition("/")[0].strip("/")
    moment = F.col("timestamp") if zone == "UTC" else F.from_utc_timestamp("timestamp", zone)
    pieces, at = [], 0
    for slot in _SLOT.finditer(folder):
        name = slot.group(1).strip()
        pieces.append(F.lit(folder[at:slot.start()]))
        if name in ("topic", "partition"):
            pieces.append(safe_segment(F.col(name).cast("string")))
        elif _TIME_SLOT.fullmatch(name):
            pieces.append(F.date_format(moment, name))
        else:
            pieces.append(safe_segment(nested(df, name)))
        at = slot.end()
    return F.concat(*pieces, F.lit(folder[at:]))


def add_tenant_layout(df: DataFrame, policy: Policy, tenant: Column, default: LayoutOptions) -> DataFrame:
    """Add ``path``: the tenant's bucket and the folder of its own object key template, or its prefix and the ``default`` layout.

    Each distinct template of the policy is one expression, and a record takes that of its tenant: one scan, whatever the number of
    tenants and layouts. A record without value, time or a field that its layout needs is an error row.
    """
    require_utc(df.sparkSession)
    values = {name: nested(df, name) for name in default.fields}
    when = time_segment(F.col("timestamp"), default)
    plain = F.concat(field_segment(values, default), F.lit(default.delimiter), when) if default.fields else when
    joined = policy.attach(df, tenant, "__place")
    template = F.col("__place.template")
    folder = F.when(template.isNull(), F.concat(F.coalesce(F.concat(F.col("__place.path_prefix"), F.lit("/")), F.lit("")), plain))
    for text in policy.templates():
        folder = folder.when(template == text, template_folder(df, text, default.zone))
    fine = F.col("record").isNotNull() & F.col("timestamp").isNotNull()
    if "error" in df.columns:
        fine = fine & F.col("error").isNull()
    whole = F.when(folder.isNotNull(), F.concat_ws("/", F.col("__place.bucket"), folder))
    placed = joined.withColumn("path", once(F.when(fine, whole)))
    error = first_error(
        df, ("partition", F.col("record").isNull(), "record has no value"), ("partition", F.col("timestamp").isNull(), "record has no timestamp"),
        ("partition", F.col("path").isNull(), "a field of the tenant's layout is null"),
    )
    return placed.select(*[c for c in df.columns if c not in ("error", "path")], error.alias("error"), "path")


def route(df: DataFrame) -> DataFrame:
    """One line per record: landed records under their path, failed ones with error context under the dead-letter path.

    Both kinds leave in one job, so nothing upstream (decryption above all) runs twice to split them.
    """
    landed = json_line(F.col("record"))
    if "plain" in df.columns:
        landed = F.coalesce(F.col("plain"), landed)
    if "sealed" in df.columns:
        # Sealed text is the whole line. A row that should be sealed and is not must never land in the clear.
        df = with_error(df, "seal", F.col("sealed") & F.col("sealed_value").isNull(), "record could not be sealed")
        landed = F.when(F.col("sealed"), F.col("sealed_value")).otherwise(landed)
    failed = F.col("error").isNotNull()
    return df.withColumns({
        "line": once(F.when(failed, dead_letter(df)).otherwise(landed)),
        "path": once(
            F.when(failed, F.concat(F.lit(f"{DEAD_LETTER}/"), F.col("error")["stage"])).otherwise(F.col("path"))
        ),
    })


def dead_letter(df: DataFrame) -> Column:
    """The original message and where it failed, as one JSON text.

    ``key`` and ``value`` are for reading; ``message_bytes`` has the exact key, value and header bytes in base64, so that
    :func:`read_dead_letters` gives the message back as it came.
    """
    def given(name: str, column: Column) -> list[Column]:
        return [column] if name in df.columns else []

    headers = F.transform("headers", lambda h: F.struct(h["key"].alias("key"), F.base64(h["value"]).alias("value")))
    exact = [
        F.base64("key").alias("key"), F.base64("value").alias("value"),
        *given("headers", headers.alias("headers")),
        *given("timestamp", F.unix_micros("timestamp").alias("timestamp_micros")),
        *given("timestampType", F.col("timestampType")),
    ]
    return F.to_json(F.struct(
        F.col("error")["stage"].alias("stage"), F.col("error")["message"].alias("message"),
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), F.struct(*exact).alias("message_bytes"),
    ), {"ignoreNullFields": "false"})


DEAD_LETTER_SCHEMA = (
    "stage string, message string, topic string, partition int, offset bigint, message_bytes struct<key:string,value:string,"
    "headers:array<struct<key:string,value:string>>,timestamp_micros:bigint,timestampType:int>"
)


def read_dead_letters(lines: DataFrame, column: str = "value") -> DataFrame:
    """Landed dead letters as messages again, in the shape of the Kafka source, with ``stage`` and ``message``."""
    letter = F.from_json(F.col(column), DEAD_LETTER_SCHEMA)
    read = lines.select(letter.alias("d"))
    exact = F.col("d.message_bytes")
    return read.select(
        F.unbase64(exact["key"]).alias("key"), F.unbase64(exact["value"]).alias("value"),
        F.col("d.topic").alias("topic"), F.col("d.partition").alias("partition"), F.col("d.offset").alias("offset"),
        F.timestamp_micros(exact["timestamp_micros"]).alias("timestamp"), exact["timestampType"].alias("timestampType"),
        F.transform(exact["headers"], lambda h: F.struct(h["key"].alias("key"), F.unbase64(h["value"]).alias("value"))).alias("headers"),
        F.col("d.stage").alias("stage"), F.col("d.message").alias("message"),
    )


def json_line(record: Column) -> Column:
    """A record as one JSON text with explicit nulls; a missing record is the word ``null``."""
    return F.coalesce(F.to_json(record, {"ignoreNullFields": "false"}), F.lit("null"))


def rotation_bucket(options: FileOptions) -> Column:
    """Fixed record-time buckets in place of a roll timer; zero when rolling by time is off."""
    if not options.rotate_ms:
        return F.lit(0).cast("bigint")
    return F.call_function("div", F.unix_millis(F.col("timestamp")), F.lit(options.rotate_ms))


def positions(df: DataFrame, group: list[str], options: FileOptions) -> DataFrame:
    """Add ``__position``, the place of each row in its group in offset order, counted from 0.

    One tenant's hour may hold a third of the data, so the group is never ranked in one task: offsets are unique in a topic
    partition, hence ``chunk_offsets`` consecutive ones bound a chunk. Records are ranked inside their chunk, chunk
    sizes are counted with map-side combining, and a running total over the few chunk rows gives each chunk its
    starting rank.
    """
    keyed = df.withColumn("__chunk", F.call_function("div", F.col("offset"), F.lit(options.chunk_offsets)))
    sizes = keyed.groupBy(*group, "__chunk").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *group, "__chunk", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy(*group, "__chunk").orderBy("offset")
    ranked = keyed.withColumn("__rank", F.row_number().over(inside) - 1)
    joined = ranked.join(starts, [*group, "__chunk"], "left")  # same keys as the ranking: no second shuffle
    return joined.select(*df.columns, (F.col("__start") + F.col("__rank")).alias("__position"))


def assign_files(df: DataFrame, options: FileOptions) -> DataFrame:
    """Add ``rotation``, ``file_no`` and ``line_no`` (0-based within the file), exact over any group size.

    Within a topic partition and path, in offset order, a new file starts every ``flush_size`` records. With ``rotate_exact`` it also starts
    when a record is ``rotate_ms`` later than the open file's first one; otherwise rolling by time uses fixed buckets of record time.
    """
    if options.rotate_ms and options.rotate_exact:
        from quayside.operators.rotation import roll_exactly

        return roll_exactly(df, options)
    group = ["topic", "partition", "path", "rotation"]
    keyed = (
        df.withColumn("topic", F.coalesce("topic", F.lit("")))
        .withColumn("path", F.coalesce("path", F.lit("")))
        .withColumn("rotation", rotation_bucket(options))
    )
    position = F.col("__position")
    return positions(keyed, group, options).select(
        *df.columns, "rotation",
        F.call_function("div", position, F.lit(options.flush_size)).alias("file_no"),
        (position % F.lit(options.flush_size)).cast("bigint").alias("line_no"),
    )


def file_name(topic: Column, partition: Column, start: Column, options: FileOptions) -> Column:
    """topic+partition+start offset, the offset zero-padded but never cut."""
    digits = start.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(options.pad)), F.lit("0"))
    return F.concat_ws("+", topic, partition.cast("string"), padded)


def manifest(assigned: DataFrame, options: FileOptions, size: Column | None = None) -> DataFrame:
    """One row per file: path, name, start and end offset, records, bytes, and the first record's headers if present."""
    measure = F.octet_length("line") if size is None and "line" in assigned.columns else size
    totals = [
        F.min("offset").alias("start_offset"), F.max("offset").alias("end_offset"),
        F.count("*").alias("records"),
    ]
    if measure is not None:
        totals.append(F.sum(measure.cast("bigint") + 1).alias("bytes"))  # one line break per record
    deciding = [c for c in ("institution", "event_type", "event_version") if c in assigned.columns]
    totals += [F.min_by(c, "offset").alias(c) for c in deciding]  # the first record decides for its file
    files = assigned.groupBy(*FILE_KEY).agg(*totals)
    return files.withColumn(
        "name", file_name(F.col("topic"), F.col("partition"), F.col("start_offset"), options)
    )
