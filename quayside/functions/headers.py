"""Reading values out of a Kafka-style header list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.once import once

PICKS = ("first", "first_non_null", "last_non_null")


def header(headers: Column, name: str, pick: str = "first_non_null") -> Column:
    """Text of the named header; names are case-sensitive and repeated headers resolved by ``pick``."""
    if pick not in PICKS:
        raise ValueError(f"pick must be one of {PICKS}")
    keys, values = headers["key"], headers["value"]
    if pick == "last_non_null":
        keys, values = F.reverse(keys), F.reverse(values)
    place = F.array_position(keys, F.lit(name))
    found = values[place.cast("int") - 1]
    if pick != "first":
        # Only a repeated header whose nearest occurrence is empty needs the element-wise search.
        kept = F.filter(headers, lambda h: (h["key"] == name) & h["value"].isNotNull())
        found = F.coalesce(found, F.try_element_at(kept, F.lit(-1 if pick == "last_non_null" else 1))["value"])
    return F.make_valid_utf8(F.when(place > 0, found).cast("string"))


def map_of(values: dict[str, Column]) -> Column:
    """MAP<STRING,STRING> of the values that are not NULL. Pass plain columns: lambdas evaluate their input unoptimized."""
    pairs = [F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in values.items()]
    if not pairs:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull()))


def split_out(df: DataFrame, names: tuple[str, ...], into: str) -> tuple[DataFrame, dict[str, Column]]:
    """Add one helper column per name (last non-null occurrence); returns them by header name."""
    columns = {n: f"__{into}_{i}" for i, n in enumerate(names)}
    df = df.withColumns({c: once(header(F.col("headers"), n, "last_non_null")) for n, c in columns.items()})
    return df, {n: F.col(c) for n, c in columns.items()}


def extract(df: DataFrame, names: tuple[str, ...], into: str) -> DataFrame:
    """Add MAP<STRING,STRING> of the listed headers that have a value."""
    before = df.columns
    df, values = split_out(df, names, into)
    return df.select(*before, once(map_of(values)).alias(into))
