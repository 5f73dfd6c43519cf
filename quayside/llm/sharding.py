"""Placement of keys on shards through a permutation-filled lookup table.

Each shard has its own preference order over the slots of a table of prime size (an offset and a step, both from its name). The
shards take turns claiming their next free slot, so each gets the same share to within one slot, and adding
or removing a shard moves few slots. A key's slot comes from its digest; the table is a broadcast of constant size.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _digest(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The owner (index into ``shards``) of every slot. ``size`` must be prime and no smaller than the number of shards."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"table size {size} is not prime")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("need distinct shards, at least one and at most one for each slot")
    at = [_digest(s, "offset") % size for s in shards]
    step = [_digest(s, "step") % (size - 1) + 1 for s in shards]
    owner = [-1] * size
    free = size
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def slot_of(key, size: int = TABLE_SIZE):
    """Slot of a key column: the first 60 bits of its text's MD5, modulo the size; null counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % F.lit(size)).cast("long")


def lookup_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """One row per slot: (slot, shard)."""
    return spark.createDataFrame(list(enumerate(fill_table(shards, size))), "slot long, shard int")


def place(df: DataFrame, shards: list[str], key_col: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """(key, slot, shard) for every row of ``df``, in constant time per row and without a shuffle.

    Repeated keys repeat with the same shard; null keys count as the empty text and keep null in the output; an empty table gives
    no rows. Other columns are not carried, so their names cannot clash. Order of the key's type does not matter.
    """
    keyed = df.select(F.col(f"`{key_col}`").alias(key_col)).withColumn("slot", slot_of(F.col(f"`{key_col}`"), size))
    # The broadcast has `size` rows however large the corpus is.
    return keyed.join(F.broadcast(lookup_frame(df.sparkSession, shards, size)), "slot").select(key_col, "slot", "shard")


def write_shards(df: DataFrame, path: str, shards: list[str], key_col: str = "doc_id", size: int = TABLE_SIZE) -> None:
    """All of ``df`` below ``path`` in one folder per shard; the rebalance lets AQE split a shard's rows over tasks."""
    slot, shard = "_quayside_slot", "_quayside_shard"
    table = lookup_frame(df.sparkSession, shards, size).toDF(slot, shard)
    placed = df.withColumn(slot, slot_of(F.col(f"`{key_col}`"), size)).join(F.broadcast(table), slot).drop(slot)
    placed.hint("rebalance", F.col(shard)).write.partitionBy(shard).parquet(path)
