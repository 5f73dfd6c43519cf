"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a lookup table may have to be broadcast; beyond it the join shuffles and AQE splits hot keys.
BROADCAST_ROWS = 50_000
ARROW_BYTES = "4m"


def local_session(name: str, cores: int | str = "*", **conf) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster the submitter owns the settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def keep_methods_short(spark: SparkSession) -> None:
    """Steps fused into a method beyond 8,000 bytes run slower than one by one: the JVM never compiles such a method."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_SHIPPED: set[str] = set()


def prepare_session(spark: SparkSession) -> SparkSession:
    """Runtime settings every job here relies on, and the package for the Python workers."""
    # Record times are UTC, so paths and windows need the session to agree.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # What a Python worker gets at once follows bytes, not rows: texts and lines may be long.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers; executors on other machines do not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # Spark serves the archive to every executor, so its place on the driver does not matter.
    archive = os.path.join(tempfile.mkdtemp(prefix="quayside-ship-"), "quayside.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    # The processes that Spark starts beside the driver for streams get no archives: they import the package from where the driver has it.
    paths = [os.path.dirname(here), *context.environment.get("PYTHONPATH", "").split(os.pathsep)]
    context.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(p for p in paths if p))
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="quayside-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and still there when executors are lost."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"path encoding needs spark.sql.session.timeZone=UTC, found {zone}")


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a table whose counted size is within the limit."""
    return F.broadcast(df) if rows <= limit else df


def bounded_count(df: DataFrame, limit: int = BROADCAST_ROWS) -> int:
    """Rows of ``df``, counted no further than one past the limit."""
    return df.limit(limit + 1).count()
