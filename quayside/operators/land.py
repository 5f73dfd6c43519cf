"""Writing lines and files."""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.layout import FILE_KEY

WRITTEN = pa.schema([
    ("path", pa.string()), ("name", pa.string()), ("start_offset", pa.int64()), ("records", pa.int64()),
    ("bytes", pa.int64()), ("sealed", pa.bool_()), ("institution", pa.string()),
])
WRITTEN_SCHEMA = (
    "path string, name string, start_offset bigint, records bigint, bytes bigint, sealed boolean, institution string"
)


def land_lines(df: DataFrame, root: str, columns: dict[str, Column], mode: str = "append") -> None:
    """JSON lines under Hive-style folders, one per distinct value of ``columns``, written by Spark's own committer.

    The rebalance hint lets AQE split the folder of a hot tenant over several tasks and merge the small ones; rows are
    never forced into one task per folder.
    """
    shaped = df.select(*[c.alias(n) for n, c in columns.items()], F.col("line").alias("value"))
    names = list(columns)
    (shaped.hint("rebalance", *names) if names else shaped).write.mode(mode).partitionBy(*names).text(root)


def keep_tolerated(df: DataFrame, tolerance: str = "all") -> DataFrame:
    """``all`` drops error rows (they were counted or written elsewhere), ``none`` fails the job on the first one."""
    if tolerance == "all":
        return df.where(F.col("error").isNull()).drop("error")
    text = F.concat_ws(": ", F.col("error")["stage"], F.col("error")["message"])
    return df.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))).drop(
        "error"
    )


def checked(df: DataFrame, tolerance: str = "all") -> DataFrame:
    """All rows for dead-letter landing with the tolerance ``all``; with ``none`` the first error row fails the job."""
    if tolerance == "all":
        return df
    if tolerance != "none":
        raise ValueError(f"unknown tolerance: {tolerance}")
    none_left = F.lit(None).cast(df.schema["error"].dataType)
    return keep_tolerated(df, "none").withColumn("error", none_left)


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, dead letters). Dead letters keep the original message and where it failed."""
    good = df.where(F.col("error").isNull()).drop("error")
    bad = df.where(F.col("error").isNotNull()).select(
        F.col("error")["stage"].alias("stage"), F.col("error")["message"].alias("message"),
        *[c for c in ("topic", "partition", "offset", "timestamp", "key", "value", "headers") if c in df.columns],
    )
    return good, bad


class _Target:
    """One output file on any file system, visible only when complete; a repeated attempt replaces it whole."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.system, self.path = system, path
        # Object stores publish on close, so only real file systems need the detour over a temporary name.
        self.direct = system.type_name in ("s3", "gcs", "abfs")
        if not self.direct:
            system.create_dir(posixpath.dirname(path), recursive=True)
        folder, name = posixpath.split(path)
        self.temporary = path if self.direct else f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.stream = system.open_output_stream(self.temporary)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        if not self.direct:
            self.system.move(self.temporary, self.path)


# Schemes of the cluster's file systems, and what the Arrow side calls them.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
_SCHEME = re.compile("[A-Za-z][A-Za-z0-9+.-]*:")


def arrow_uri(root: str) -> str:
    """The folder as the Arrow side names it; an unknown scheme is an error."""
    scheme, _, rest = root.partition(":")
    if scheme not in _SCHEMES:
        raise ValueError(f"cannot write named files to {scheme}: use one of {', '.join(sorted(_SCHEMES))}")
    if scheme == "file":
        return f"file:///{rest.lstrip('/')}"
    return f"{_SCHEMES[scheme]}:{rest}"


def _mounted(spark: SparkSession, root: str) -> str:
    """The folder that a mount table (viewfs) has behind ``root``, which need not be there yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system, missing = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), []
    while path.getParent() is not None and not system.exists(path):
        missing.append(path.getName())
        path = path.getParent()
    return "/".join([system.resolvePath(path).toString().rstrip("/"), *reversed(missing)])


def located(spark: SparkSession, root: str) -> str:
    """``root`` as the Arrow side can open it: on the cluster's default file system if without scheme, and behind a mount table's name."""
    if not _SCHEME.match(root):
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        if default.startswith("file:"):
            return root
        root = f"{default.rstrip('/')}/{root.lstrip('/')}"
    if root.startswith("viewfs:"):
        root = _mounted(spark, root)
    arrow_uri(root)
    return root


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether a local folder lies below one that the driver and all executors share by Spark's own settings."""
    for setting in ("spark.checkpoint.dir", "spark.sql.warehouse.dir"):
        base = spark.conf.get(setting, None)
        base = located(spark, base) if base else ""
        if base and (not _SCHEME.match(base) or base.startswith("file:")):
            if f"{folder}/".startswith(f"{posixpath.abspath(_file_system(base)[1]).rstrip('/')}/"):
                return True
    return False


def shared_root(spark: SparkSession, root: str) -> str:
    """``root`` with its scheme, resolved once on the driver so that tasks and Spark's own writers mean the same place.

    A folder without scheme lies on the cluster's default file system. If that is the local one, only a local master may use it, or it
    lies below ``spark.checkpoint.dir`` or the warehouse, which Spark's own writers need to be shared: else each executor would write to
    its own disk.
    """
    root = located(spark, root)
    if not _SCHEME.match(root):
        folder = posixpath.abspath(root)
        if not spark.sparkContext.master.startswith("local") and not _is_shared(spark, folder):
            raise ValueError(f"{root} would lie on each executor's own disk: name it with a scheme")
        root = f"file://{folder}"
    return root


def below(base: str, *parts: str) -> str:
    """``base`` and the parts joined; an error if any part could lead out of ``base``."""
    joined = "/".join(p for p in parts if p)
    if any(p in ("", ".", "..") for p in joined.split("/")):
        raise ValueError("a file's path must stay below the landing root")
    return posixpath.join(base, joined)


def _file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file, and its path there; names may hold characters that a URI may not."""
    scheme, _, rest = arrow_uri(root if _SCHEME.match(root) else f"file:{posixpath.abspath(root)}").partition("://")
    if scheme == "file":
        return fs.LocalFileSystem(), rest
    authority, _, path = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}")
    return system, f"{base.rstrip('/')}/{path}"


def _remove(system: fs.FileSystem, path: str) -> None:
    if system.get_file_info(path).type == fs.FileType.File:
        system.delete_file(path)


def frame_columns(frames: DataFrame) -> DataFrame:
    """The columns that writing needs, in their order."""
    return frames.select(
        *FILE_KEY, "name", "start_offset", "frame", "records", "last", "content", "sealed", "framing",
        (F.col("siblings") if "siblings" in frames.columns else F.lit(None).cast("array<string>")).alias("siblings"),
        (F.col("institution") if "institution" in frames.columns else F.lit(None).cast("string")).alias("institution"),
    )


def frame_writer(root: str, buckets: Mapping[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that writes the frames of a task, file by file and in order, and gives one manifest row per file."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems = {name: _file_system(place) for name, place in {**buckets, "": root}.items()}
        target, row, expected = None, None, 0
        for batch in batches:
            done = []
            contents = batch.column("content")
            for index, item in enumerate(batch.drop_columns(["content"]).to_pylist()):
                if target is None:
                    bucket, _, rest = item["path"].partition("/")
                    bucket, folder = (bucket, rest) if bucket in buckets else ("", item["path"])
                    system, base = systems[bucket]
                    target = _Target(system, below(base, folder, item["name"]))
                    row, expected = {n: item.get(n) for n in WRITTEN.names}, 0
                    row["name"], identity = item["name"], tuple(item[k] for k in FILE_KEY)
                if item["frame"] != expected or tuple(item[k] for k in FILE_KEY) != identity:
                    raise RuntimeError("frames of a file must arrive together and in order")
                expected += item["records"]
                content = contents[index].as_py()  # one frame at a time
                if content is None:
                    raise RuntimeError("a frame has no content: it could not be sealed or opened")
                if item["framing"] == "length":
                    target.write(len(content).to_bytes(4, "big"))
                target.write(content)
                if item["framing"] == "line":
                    target.write(b"\n")
                if item["last"]:
                    target.close()
                    # Sealed or plain is part of the name: after a change of policy a replay must not leave both.
                    for stale in item["siblings"] or ():
                        _remove(system, below(base, folder, stale))
                    done.append({**row, "records": expected, "bytes": target.size})
                    target = None
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=WRITTEN)
        if target is not None:
            raise RuntimeError("the last frame of a file is missing")

    return write


def write_files(frames: DataFrame, root: str, clustered: bool = False, roots: Mapping[str, str] | None = None) -> DataFrame:
    """Write each file's frames, in order, to ``root/path/name``; returns one manifest row per file when evaluated.

    Rows are clustered by file and sorted inside their task, then streamed: a task holds a few frames at a time. Names
    are fixed by topic, partition and first offset, so a retried task or a replayed batch overwrites instead of adding.
    ``framing`` says how frames are told apart: by ``line``, by a ``length`` prefix, or not at all (``raw``).
    ``clustered`` skips the shuffle for frames that still lie file by file, as ``file_frames`` leaves them; the write
    fails rather than produce a file with a missing or misplaced frame.
    ``roots`` gives the landing root of each bucket, the first folder of a tenant's path; other paths lie below ``root``.
    """
    wanted = frame_columns(frames)
    spark = frames.sparkSession
    root, buckets = shared_root(spark, root), {name: shared_root(spark, place) for name, place in (roots or {}).items()}
    ordered = (wanted if clustered else wanted.repartition(*FILE_KEY)).sortWithinPartitions(*FILE_KEY, "frame")
    return ordered.mapInArrow(frame_writer(root, buckets), WRITTEN_SCHEMA)


def land_files(
    frames: DataFrame, root: str, manifest_path: str, mode: str = "append", clustered: bool = False,
    roots: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write the files once and store their manifest; returns the stored manifest.

    The manifest is one Spark write, so a failed job leaves no rows for files of its unfinished tasks.
    """
    write_files(frames, root, clustered, roots).write.mode(mode).parquet(manifest_path)
    return frames.sparkSession.read.parquet(manifest_path)
