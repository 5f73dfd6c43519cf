"""The Kafka client's default key hash, as a column expression over 64-bit arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published 32-bit murmur2 variant.
SEED = 0x9747B28C
MULTIPLIER = 0x5BD1E995
LOW_32 = 0xFFFFFFFF


def _times(value: Column) -> Column:
    # 32-bit times 31-bit stays below 2**63, so ANSI overflow checks never fire.
    return (value * F.lit(MULTIPLIER)).bitwiseAND(F.lit(LOW_32))


def _fold(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftrightunsigned(value, bits))


def murmur2(text: Column) -> Column:
    """Unsigned 32-bit hash (as BIGINT) of the UTF-8 bytes."""
    digits = F.hex(F.encode(text, "UTF-8"))
    size = (F.length(digits) / 2).cast("int")

    def byte(index: Column) -> Column:
        # Past the end the substring is empty, conv gives NULL and the byte counts as zero.
        pair = F.substring(digits, index * 2 + 1, F.lit(2))
        return F.coalesce(F.conv(F.nullif(pair, F.lit("")), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))

    def word(start: Column) -> Column:
        return (
            byte(start)
            + F.shiftleft(byte(start + 1), 8)
            + F.shiftleft(byte(start + 2), 16)
            + F.shiftleft(byte(start + 3), 24)
        )

    whole = (size / 4).cast("int")
    starts = F.when(whole > 0, F.transform(F.sequence(F.lit(0), whole - 1), lambda i: i * 4)).otherwise(
        F.array().cast("array<int>")
    )
    start = F.lit(SEED).cast("bigint").bitwiseXOR(size.cast("bigint"))
    body = F.aggregate(
        starts, start, lambda h, i: _times(h).bitwiseXOR(_times(_fold(_times(word(i)), 24)))
    )
    rest = word(whole * 4)
    mixed = F.aggregate(
        F.array(body), F.lit(0).cast("bigint"),
        lambda _, h: F.when(size % 4 > 0, _times(h.bitwiseXOR(rest))).otherwise(h),
    )
    final = F.aggregate(F.array(mixed), F.lit(0).cast("bigint"), lambda _, h: _fold(_times(_fold(h, 13)), 15))
    return final


def kafka_partition(text: Column, partitions: int) -> Column:
    return (murmur2(text).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(partitions)).cast("int")
