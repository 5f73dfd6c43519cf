"""Partner keys and the tenant-to-partition map."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.hashing import kafka_partition
from quayside.session import bounded_count, small_side, stored
from quayside.sources.messages import with_error

# Member names of the partner-key document.
KEY_ENTRY = "struct<publicKeyPath:string,keyId:string,enabled:boolean,validFrom:timestamp,validTo:timestamp>"


def _as_table(spark: SparkSession, text: DataFrame | str) -> DataFrame:
    return spark.createDataFrame([(text,)], "value string") if isinstance(text, str) else text


def partner_keys(spark: SparkSession, text: DataFrame | str) -> DataFrame:
    """id, public_key, key_id, enabled, valid_from, valid_to from either form of the document.

    The flat form maps an id to a key path; the nested form has a ``keys`` member with one entry per id.
    """
    source = _as_table(spark, text)
    nested = source.select(F.explode(F.from_json("value", f"keys map<string,{KEY_ENTRY}>")["keys"]).alias("id", "k"))
    flat = source.where(F.get_json_object("value", "$.keys").isNull()).select(
        F.explode(F.from_json("value", "map<string,string>")).alias("id", "path")
    )
    no_time = F.lit(None).cast("timestamp")
    return nested.select(
        "id", F.col("k.publicKeyPath").alias("public_key"), F.col("k.keyId").alias("key_id"),
        F.coalesce("k.enabled", F.lit(True)).alias("enabled"),
        F.col("k.validFrom").alias("valid_from"), F.col("k.validTo").alias("valid_to"),
    ).unionByName(flat.select(
        "id", F.col("path").alias("public_key"), F.lit(None).cast("string").alias("key_id"),
        F.lit(True).alias("enabled"), no_time.alias("valid_from"), no_time.alias("valid_to"),
    ))


def attach_key(
    df: DataFrame, tenant: Column, keys: DataFrame, into: str, as_of: Column | None = None,
    needed: Column | None = None,
) -> DataFrame:
    """Add the tenant's public-key name; a blank tenant, a miss or an unusable key is an error row where needed."""
    moment = F.current_timestamp() if as_of is None else as_of
    side = keys.select(
        F.col("id").alias("__id"), F.struct("public_key", "enabled", "valid_from", "valid_to").alias("__k")
    )
    joined = df.withColumn("__tenant", tenant).join(
        small_side(side, bounded_count(side)), F.col("__tenant") == F.col("__id"), "left"
    )
    entry = F.col("__k")
    usable = (
        entry["enabled"]
        & (entry["valid_from"].isNull() | (entry["valid_from"] <= moment))
        & (entry["valid_to"].isNull() | (moment < entry["valid_to"]))
    )
    joined = joined.withColumn(into, F.when(usable, entry["public_key"]))
    required = F.lit(True) if needed is None else needed
    return with_error(
        joined, "key", required & F.col(into).isNull(), "no usable public key for the institution"
    ).drop("__tenant", "__id", "__k")


# The ends of open periods, in microseconds: before and after any timestamp.
_EVER, _NEVER = -(1 << 62), 1 << 62
# Width of the time buckets of an as-of lookup.
BUCKET_SECONDS = 86_400


def partner_key_history(spark: SparkSession, text: DataFrame | str) -> DataFrame:
    """As :func:`partner_keys`, from a document whose ``keys`` member lists several entries per id."""
    source = _as_table(spark, text)
    listed = source.select(F.explode(F.from_json("value", f"keys map<string,array<{KEY_ENTRY}>>")["keys"]).alias("id", "entries"))
    each = listed.select("id", F.explode("entries").alias("k"))
    return each.select(
        "id", F.col("k.publicKeyPath").alias("public_key"), F.col("k.keyId").alias("key_id"),
        F.coalesce("k.enabled", F.lit(True)).alias("enabled"),
        F.col("k.validFrom").alias("valid_from"), F.col("k.validTo").alias("valid_to"),
    )


def key_periods(keys: DataFrame) -> DataFrame:
    """(id, since, until, public_key): which key holds when, in microseconds, without overlaps.

    Of several keys that are valid at one moment the one whose period began last holds, of equal ones that with the larger name. Disabled
    keys and empty periods hold never. One id's periods are swept in one task: as many as it had keys, not records.
    """
    spans = keys.where("enabled AND public_key IS NOT NULL AND id IS NOT NULL").select(
        "id", "public_key", F.coalesce(F.unix_micros("valid_from"), F.lit(_EVER)).alias("since"),
        F.coalesce(F.unix_micros("valid_to"), F.lit(_NEVER)).alias("until"),
    ).where("since < until")

    def sweep(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["since"].to_pylist(), group["until"].to_pylist(), group["public_key"].to_pylist(), strict=True))
        moments = sorted({m for since, until, _ in rows for m in (since, until)})
        # Open periods, the one that began last on top; those that have ended go when they come up.
        latest: list[tuple] = []
        out: list[list] = []
        at = 0
        for moment, after in pairwise(moments):
            while at < len(rows) and rows[at][0] <= moment:
                latest.append(rows[at])  # in order of (since, until, name)
                at += 1
            # Of equal begins the larger name holds, whichever ends first.
            while latest and latest[-1][1] <= moment:
                latest.pop()
            holder = max((r for r in _same_begin(latest, moment)), key=lambda r: r[2], default=None)
            if holder is None:
                continue
            if out and out[-1][1] == moment and out[-1][2] == holder[2]:
                out[-1][1] = after
            else:
                out.append([moment, after, holder[2]])
        names = [key[0].as_py()] * len(out)
        return pa.table([pa.array(names, pa.string()), *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                        names=["id", "since", "until", "public_key"])

    return spans.groupBy("id").applyInArrow(sweep, "id string, since long, until long, public_key string")


def _same_begin(periods: list[tuple], moment: int) -> Iterator[tuple]:
    """The periods at the top that began together and have not ended."""
    for period in reversed(periods):
        if period[0] != periods[-1][0]:
            return
        if period[1] > moment:
            yield period


def attach_key_as_of(
    df: DataFrame, tenant: Column, keys: DataFrame, into: str, as_of: Column, needed: Column | None = None, bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Add the name of the tenant's public key that held at ``as_of``, from a history of any number of periods per id.

    Records and periods meet by id and bucket of time, so a hot tenant is spread over its buckets. A bucket knows the periods that begin
    in it and the one in force at its begin, whenever that began; only buckets that have records are asked. A missing tenant, time or
    period is an error row where ``needed`` holds (everywhere by default).
    """
    width = bucket_seconds * 1_000_000
    periods = stored(key_periods(keys), "periods")
    moment = F.unix_micros(as_of)
    keyed = df.withColumns({"__id": tenant, "__moment": moment}).withColumn("__bucket", F.floor(F.col("__moment") / F.lit(width)))
    known = small_side(periods.select(F.col("id").alias("__known")).distinct(), bounded_count(periods))
    pairs = keyed.where("__id IS NOT NULL AND __moment IS NOT NULL").select("__id", "__bucket").distinct()
    asked = stored(pairs.join(known, F.col("__id") == F.col("__known")).drop("__known"), "asked")
    span = F.struct("since", "until", "public_key")
    begins = periods.select(F.col("id").alias("__id"), F.col("since").alias("at"), span.alias("span"), F.lit(None).cast("long").alias("__bucket"))
    marks = asked.select("__id", (F.col("__bucket") * F.lit(width)).alias("at"), F.lit(None).cast(begins.schema["span"].dataType).alias("span"), "__bucket")
    # Per id one row for each of its periods and for each bucket with records.
    before = Window.partitionBy("__id").orderBy("at", F.col("span").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    carried = begins.unionByName(marks).withColumn("span", F.last("span", ignorenulls=True).over(before)).where("__bucket IS NOT NULL")
    carried = carried.where(F.col("span.until") > F.col("at")).select("__id", "__bucket", "span.*")
    starting = periods.where(F.col("since") != F.lit(_EVER)).select(
        F.col("id").alias("__id"), F.floor(F.col("since") / F.lit(width)).alias("__bucket"), "since", "until", "public_key",
    ).where(F.col("since") > F.col("__bucket") * F.lit(width))
    pieces = stored(carried.unionByName(starting).join(asked, ["__id", "__bucket"], "left_semi"), "pieces")
    right = pieces.select(F.col("__id").alias("__rid"), F.col("__bucket").alias("__rbucket"), "since", "until", F.col("public_key").alias("__key"))
    right = right.withColumnsRenamed({"since": "__since", "until": "__until"})
    holds = (F.col("__id") == F.col("__rid")) & (F.col("__bucket") == F.col("__rbucket")) & (F.col("__since") <= F.col("__moment")) & (F.col("__moment") < F.col("__until"))
    joined = keyed.join(small_side(right, bounded_count(right)), holds, "left").withColumn(into, F.col("__key"))
    required = F.lit(True) if needed is None else needed
    marked = with_error(joined, "key", required & F.col(into).isNull(), "no usable public key for the institution")
    return marked.select(*dict.fromkeys([*(c for c in df.columns if c not in (into, "error")), into, "error"]))


def read_partition_map(spark: SparkSession, path: str) -> DataFrame:
    """bank, partition from a CSV file with ``#`` comments."""
    return spark.read.csv(path, schema="bank string, partition int", comment="#")


def partition_map(spark: SparkSession, text: str) -> DataFrame:
    """The same from CSV text held by the caller."""
    lines = F.explode(F.split(F.lit(text), "\r?\n")).alias("line")
    rows = spark.range(1).select(lines).where("trim(line) != '' and line not like '#%'")
    parts = F.split("line", ",")
    return rows.select(F.trim(parts[0]).alias("bank"), F.trim(parts[1]).cast("int").alias("partition"))


def tenant_partitions(df: DataFrame, tenant: Column, mapping: DataFrame, partitions: int) -> DataFrame:
    """tenant, records, partition, listed: the mapped partition or else the hash of the tenant code.

    Records are counted per tenant before the lookup, so the hash runs once per tenant.
    """
    seen = df.where(tenant.isNotNull()).groupBy(tenant.alias("tenant")).agg(F.count("*").alias("records"))
    listed = mapping.select(F.col("bank").alias("tenant"), F.col("partition").alias("__listed"))
    joined = seen.join(listed, "tenant", "left")
    return joined.select(
        "tenant", "records",
        F.coalesce("__listed", kafka_partition(F.col("tenant"), partitions)).alias("partition"),
        F.col("__listed").isNotNull().alias("listed"),
    )
