"""Auditing landed offsets: which are missing, and which landed twice.

Offsets of a topic partition are summed up as islands of successive ones, first inside chunks of offsets, then over the chunks' islands, so no
task sorts a partition's records. Islands of all batches, one short row each, tell gaps and overlaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["topic", "partition"]
# Offsets of a topic partition that one task sorts.
CHUNK = 1 << 20


def _islands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of rows (first, last, records) of a group that follow each other without a hole."""
    order = Window.partitionBy(*keys).orderBy("first")
    new = F.when(F.col("first") == F.lag("last").over(order) + 1, 0).otherwise(1)
    run = F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumn("__new", new).withColumn("__run", run)
    return numbered.groupBy(*keys, "__run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("records").alias("records")).drop("__run")


def offset_islands(df: DataFrame, batch: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """(topic, partition, batch, first, last, records): runs of successive offsets of each batch, and how many records have them.

    More records than offsets means that some landed twice in the batch. Rows without an offset are left out.
    """
    keys = [*GROUP, "batch"]
    named = df.select(
        F.coalesce("topic", F.lit("")).alias("topic"), "partition", (F.lit(0) if batch is None else batch).cast("bigint").alias("batch"),
        F.col("offset").alias("first"),
    ).where("first IS NOT NULL")
    each = named.groupBy(*keys, "first").agg(F.count("*").alias("records"))
    chunked = each.withColumn("last", F.col("first")).withColumn("__chunk", F.call_function("div", F.col("first"), F.lit(chunk)))
    return _islands(_islands(chunked, [*keys, "__chunk"]).drop("__chunk"), keys)


def offset_faults(islands: DataFrame) -> DataFrame:
    """(topic, partition, kind, first, last, records) of what is wrong with the landed offsets.

    ``missing``: offsets between the first and the last landed one that no batch has. ``overlap``: offsets that more than one batch has.
    ``repeated``: an island in which some offsets landed more than once; ``records`` counts the surplus. One row per island
    is sorted per topic partition.
    """
    order = Window.partitionBy(*GROUP).orderBy("first", "last", "batch")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    seen = islands.withColumn("__reach", reach)
    gap = seen.where(F.col("first") > F.col("__reach") + 1).select(
        *GROUP, F.lit("missing").alias("kind"), (F.col("__reach") + 1).alias("first"), (F.col("first") - 1).alias("last"),
        (F.col("first") - F.col("__reach") - 1).alias("records"))
    shared = seen.where(F.col("first") <= F.col("__reach")).select(
        *GROUP, F.lit("overlap").alias("kind"), "first", F.least("last", "__reach").alias("last"),
        (F.least("last", "__reach") - F.col("first") + 1).alias("records"))
    surplus = F.col("records") - (F.col("last") - F.col("first") + 1)
    repeated = islands.where(surplus > 0).select(*GROUP, F.lit("repeated").alias("kind"), "first", "last", surplus.alias("records"))
    return gap.unionByName(shared).unionByName(repeated)
