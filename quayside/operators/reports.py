"""Reports over protected records, landed files and errors. All pre-aggregate before shuffling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.headers import header
from quayside.options import INSTITUTION_HEADER

def strategy_counts(df: DataFrame) -> DataFrame:
    """Records per institution and applied strategy."""
    return df.groupBy("institution", "strategy").agg(F.count("*").alias("records"))


def coverage_matrix(df: DataFrame, event_types: list[str]) -> DataFrame:
    """Tenant by event type; the types are given, so no extra pass finds them."""
    return df.groupBy("institution").pivot("event_type", event_types).agg(F.count(F.lit(1))).na.fill(0, event_types)


def landing_statistics(files: DataFrame) -> DataFrame:
    """Total files and bytes, mean file size, mean records per file."""
    return files.agg(
        F.count("*").alias("files"), F.sum("bytes").alias("total_bytes"), F.sum("records").alias("total_records"),
        F.avg("bytes").alias("mean_bytes"), F.avg("records").alias("mean_records"),
    )


def files_per_institution(files: DataFrame) -> DataFrame:
    """Files and sealed files per institution."""
    return files.groupBy("institution").agg(
        F.count("*").alias("files"), F.count_if("sealed").alias("sealed_files"), F.sum("records").alias("records")
    )


def error_rates(df: DataFrame) -> DataFrame:
    """Records per failing stage, with the share of all records; stage NULL counts the good ones."""
    counts = df.groupBy(F.col("error")["stage"].alias("stage")).agg(F.count("*").alias("records"))
    total = F.sum("records").over(Window.partitionBy(F.lit(0)))  # over one row per stage
    return counts.select("stage", "records", (F.col("records") / total).alias("share"))


def message_rate(df: DataFrame, moment: Column | str, width: str = "1 second") -> DataFrame:
    """Records per time window; also runs on a stream, with a watermark set by the caller."""
    stamp = F.col(moment) if isinstance(moment, str) else moment
    grouped = df.groupBy(F.window(stamp, width).alias("w")).agg(F.count("*").alias("records"))
    return grouped.select(F.col("w.start").alias("window_start"), "records")


def institution_counts(df: DataFrame) -> DataFrame:
    """Records and errors by institution (as its header says) and strategy."""
    return df.groupBy(header(F.col("headers"), INSTITUTION_HEADER).alias("institution"), "strategy").agg(
        F.count("*").alias("records"), F.count("error").alias("errors")
    )


def observed(df: DataFrame, name: str = "landing") -> DataFrame:
    """Attach live counters that Spark reports per batch without another pass over the data."""
    strategy = F.col("strategy") if "strategy" in df.columns else F.lit(None).cast("string")
    counters = [
        F.count_if(strategy == s).alias(s.lower()) for s in ("REMOVE", "MASK", "DECRYPT", "REKEY", "TOKENIZE")
    ]
    return df.observe(
        name, F.count(F.lit(1)).alias("records"), F.count_if(F.col("error").isNotNull()).alias("errors"), *counters
    )
