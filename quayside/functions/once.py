"""Keeping an expensive column from being copied around the plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(column: Column) -> Column:
    """The same value, evaluated where it is defined.

    The optimizer pushes a filter below a projection by copying the projected expressions into it, so a filter on
    ``error`` would parse each message's JSON dozens of times. It does not copy non-deterministic expressions; the
    partition number is the cheapest of those. The price: filters on source columns belong before the decoding step.
    """
    return F.when(F.spark_partition_id() >= 0, column)
