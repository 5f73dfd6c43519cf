"""A replayable topic: stored records read by offset, as a stream with bounded micro-batches or as a batch.

A log is a folder of Parquet files in the shape of Spark's Kafka source, and an index that says which offsets of which topic partition
each file holds. The data source ``quayside_records`` plans from the index alone: a task reads the part of one file that
lies between two offsets. Starting positions are ``earliest``, ``latest`` or an offset per topic partition, as for a topic.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quayside.operators.land import _file_system, shared_root
from quayside.sources.messages import KAFKA_SCHEMA, RECORD_COLUMNS

FORMAT = "quayside_records"
INDEX = "topic string, partition int, file string, first bigint, last bigint"
# Records of one file, at most.
FILE_RECORDS = 1 << 20
# Records that a task reads or writes, about, where files are smaller: a task of a few records is mostly its own start.
TASK_RECORDS = 50_000
Offsets = dict[str, dict[str, int]]
# The columns of KAFKA_SCHEMA as a task gives them to Spark.
_ARROW = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", tz="UTC")), ("timestampType", pa.int32()),
    ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))),
])


def append_records(df: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Add records to the log at ``path``, in files of successive offsets: a hot topic partition has as many as it needs.

    A task writes as many files as ``TASK_RECORDS`` make, so neither tasks nor the range bounds sampled for them follow the number of files. The index is written after the files, so a reader sees an append as a whole or not at all.
    """
    spark, path = df.sparkSession, shared_root(df.sparkSession, path).rstrip("/")
    order = ["topic", "partition", "offset"]
    dealt = df.select(*RECORD_COLUMNS).repartitionByRange(-(-df.count() // max(file_records, TASK_RECORDS)) or 1, *order)
    system, base = _file_system(path)
    number = len([i for i in system.get_file_info(fs.FileSelector(posixpath.join(base, "index"), allow_not_found=True)) if i.type == fs.FileType.Directory])
    folder = f"append={number:09d}"
    dealt.sortWithinPartitions(*order).write.mode("overwrite").option("maxRecordsPerFile", file_records).parquet(f"{path}/data/{folder}")
    stored = spark.read.schema(KAFKA_SCHEMA).parquet(f"{path}/data/{folder}")
    name = F.concat(F.lit(f"data/{folder}/"), F.col("_metadata.file_name"))
    index = stored.groupBy("topic", "partition", name.alias("file")).agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    index.write.mode("overwrite").parquet(f"{path}/index/{folder}")


@dataclass
class _Piece:
    """Offsets [start, end) of a topic partition in one file."""

    file: str
    topic: str
    partition: int
    start: int
    end: int


@dataclass
class _Share(InputPartition):
    """What one task reads: pieces one after the other."""

    pieces: list[_Piece]


def read_index(path: str) -> list[dict]:
    """The index rows: one for each file and topic partition in it, only those of complete appends."""
    system, base = _file_system(path)
    rows: list[dict] = []
    for folder in system.get_file_info(fs.FileSelector(posixpath.join(base, "index"), allow_not_found=True)):
        inside = system.get_file_info(fs.FileSelector(folder.path)) if folder.type == fs.FileType.Directory else []
        if any(i.base_name == "_SUCCESS" for i in inside):
            for file in inside:
                if file.base_name.endswith(".parquet"):
                    rows += pq.read_table(file.path, filesystem=system).to_pylist()
    return rows


def _ends(index: list[dict], latest: bool) -> Offsets:
    out: Offsets = {}
    for row in index:
        known = out.setdefault(row["topic"], {})
        key = str(row["partition"])
        value = row["last"] + 1 if latest else row["first"]
        known[key] = value if key not in known else (max if latest else min)(known[key], value)
    return out


def starting(option: str, index: list[dict]) -> Offsets:
    """Where to start: named partitions at their offsets (-2 earliest, -1 latest), others at their beginning."""
    early, late = _ends(index, False), _ends(index, True)
    if option == "earliest":
        return early
    if option == "latest":
        return late
    given = json.loads(option)
    return {
        topic: {
            p: early[topic][p] if (at := given.get(topic, {}).get(p, -2)) == -2 else late[topic][p] if at == -1 else int(at) for p in parts
        } for topic, parts in early.items()
    }


def bounded(start: Offsets, end: Offsets, limit: int | None) -> Offsets:
    """``end``, or as far as ``limit`` offsets reach, shared by how much each partition has left; some progress wherever there is any."""
    left = {(t, p): e - start.get(t, {}).get(p, 0) for t, parts in end.items() for p, e in parts.items()}
    total = sum(n for n in left.values() if n > 0)
    if limit is None or total <= limit:
        return {t: {p: max(e, start.get(t, {}).get(p, 0)) for p, e in parts.items()} for t, parts in end.items()}
    share = {k: max(n * limit // total, 1) if n > 0 else 0 for k, n in left.items()}
    return {t: {p: start.get(t, {}).get(p, 0) + share[t, p] for p in parts} for t, parts in end.items()}


def pieces(index: list[dict], start: Offsets, end: Offsets) -> list[_Piece]:
    """The parts of files that lie between two positions."""
    out = []
    for row in index:
        key = str(row["partition"])
        low = max(start.get(row["topic"], {}).get(key, 0), row["first"])
        high = min(end.get(row["topic"], {}).get(key, 0), row["last"] + 1)
        if low < high:
            out.append(_Piece(row["file"], row["topic"], row["partition"], low, high))
    return out


def shares(found: list[_Piece], records: int = TASK_RECORDS) -> list[_Share]:
    """Pieces dealt to tasks in order, each task of at most ``records`` offsets or one piece."""
    out, held = [], records
    for piece in sorted(found, key=lambda p: (p.topic, p.partition, p.start)):
        size = piece.end - piece.start
        if held + size > records:
            out.append(_Share([]))
            held = 0
        out[-1].pieces.append(piece)
        held += size
    return out


def read_piece(path: str, piece: _Piece) -> Iterator[pa.RecordBatch]:
    """The records of one piece, in offset order, row group by row group."""
    system, base = _file_system(path)
    schema = _ARROW
    with system.open_input_file(posixpath.join(base, piece.file)) as handle:
        for batch in pq.ParquetFile(handle).iter_batches(batch_size=8_192, columns=schema.names):
            offset = batch.column("offset")
            inside = pc.and_(pc.greater_equal(offset, piece.start), pc.less(offset, piece.end))
            inside = pc.and_(inside, pc.and_(pc.equal(batch.column("topic"), piece.topic), pc.equal(batch.column("partition"), piece.partition)))
            found = pa.Table.from_batches([batch.filter(inside)]).select(schema.names).cast(schema)
            yield from found.to_batches()


class _Log:
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.start = options.get("startingoffsets", "earliest")
        limit = options.get("maxoffsetspertrigger")
        self.limit = int(limit) if limit else None
        self.checkpoint = options.get("resume")

    def read(self, partition: _Share | None) -> Iterator[pa.RecordBatch]:
        # Without any pieces Spark asks once for none.
        for piece in partition.pieces if partition else ():
            yield from read_piece(self.path, piece)


class RecordReader(_Log, DataSourceReader):
    """All records from the starting position on."""

    def partitions(self) -> Sequence[_Share]:
        index = read_index(self.path)
        return shares(pieces(index, starting(self.start, index), _ends(index, True)))


class RecordStreamReader(_Log, DataSourceStreamReader):
    """Micro-batches of at most ``maxOffsetsPerTrigger`` records.

    How far the query has come is known from what Spark plans. A restarted query plans nothing before it asks for the end, so bounded
    reading needs its checkpoint (``resume``), whose last offsets say where it was.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        if self.limit is not None and not self.checkpoint:
            raise ValueError("maxOffsetsPerTrigger needs the query's checkpoint as resume")
        self.current = self._planned() if self.checkpoint else None

    def _planned(self) -> Offsets | None:
        """The offsets of the last planned micro-batch: the last line of the checkpoint's newest offset file."""
        system, base = _file_system(self.checkpoint)
        names = [i for i in system.get_file_info(fs.FileSelector(posixpath.join(base, "offsets"), allow_not_found=True)) if i.base_name.isdigit()]
        if not names:
            return None
        with system.open_input_stream(max(names, key=lambda i: int(i.base_name)).path) as stream:
            return json.loads(stream.read().decode().splitlines()[-1])

    def initialOffset(self) -> Offsets:
        first = starting(self.start, read_index(self.path))
        self.current = self.current or first
        return first

    def latestOffset(self) -> Offsets:
        index = read_index(self.path)
        end = _ends(index, True)
        if self.current is None:
            self.current = starting(self.start, index)
        return bounded(self.current, end, self.limit) or self.current

    def partitions(self, start: Offsets, end: Offsets) -> Sequence[_Share]:
        self.current = end
        return shares(pieces(read_index(self.path), start, end))

    def commit(self, end: Offsets) -> None:
        pass


class RecordSource(DataSource):
    """Options: ``path``; ``startingOffsets``; for streams ``maxOffsetsPerTrigger`` and ``resume``, the query's checkpoint."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return KAFKA_SCHEMA

    def reader(self, schema) -> RecordReader:
        return RecordReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema) -> RecordStreamReader:
        return RecordStreamReader({k.lower(): v for k, v in self.options.items()})


def read_records(
    spark: SparkSession, path: str, start: str = "earliest", stream: bool = True, max_per_trigger: int | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """The log from ``start`` on: ``earliest``, ``latest``, or JSON like that of the Kafka source's ``startingOffsets``.

    ``max_per_trigger`` is what a consumer calls ``max.poll.records``; it needs the ``checkpoint`` of the query that reads the stream.
    """
    spark.dataSource.register(RecordSource)
    reader = (spark.readStream if stream else spark.read).format(FORMAT).option("path", shared_root(spark, path)).option("startingOffsets", start)
    if stream and max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger)).option("resume", shared_root(spark, checkpoint or ""))
    return reader.load()
