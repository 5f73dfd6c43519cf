"""Files that stay open across micro-batches, kept as state per topic partition and path.

A file is closed when it has ``flush_size`` records, when a record comes ``rotate_ms`` or more after its first one, or when it has been open
for ``schedule_ms`` of wall-clock time. Only closed files leave the state, so short triggers do not make small files, and the files are
those that one batch over all records would give. A group is one path of one topic partition, which is in order and
whose share of a micro-batch is bounded by the source; its open file holds at most ``flush_size`` lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quayside.functions.rsa import KeyRing
from quayside.operators.commits import land_committed
from quayside.operators.land import checked
from quayside.operators.seal import file_frames, seal_frames
from quayside.options import FileOptions, SealOptions
from quayside.sources.policy import Policy
from quayside.streaming.landing import routed

# State stores of this kind can hold lists and timers.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DECIDING = ["institution", "event_type", "event_version"]
CLOSED = (
    "topic string, partition int, path string, start_offset bigint, end_offset bigint, records bigint, "
    "institution string, event_type string, event_version string, lines array<string>"
)
_HEAD = "records bigint, first_moment bigint, opened bigint, institution string, event_type string, event_version string"
_LINES = "offset bigint, line string"
_NO_TIME = -(1 << 62)


class OpenFile(StatefulProcessor):
    """The open file of one topic partition and path: its lines, and what its first record said."""

    def __init__(self, files: FileOptions, schedule_ms: int | None = None):
        self.files, self.schedule_ms = files, schedule_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", _HEAD)
        self.lines = handle.getListState("lines", _LINES)

    def _closed(self, key: tuple, head: tuple, lines: list[tuple]) -> pd.DataFrame:
        row = (*key, lines[0][0], lines[-1][0], len(lines), *head[3:], [line for _, line in lines])
        names = ["topic", "partition", "path", "start_offset", "end_offset", "records", *DECIDING, "lines"]
        return pd.DataFrame([row], columns=names)

    def _keep(self, head: tuple | None, lines: list[tuple], fresh: bool, known: int) -> None:
        """Store the open file. Only lines that are not stored yet are added when the file is still the same."""
        if head is None:
            self.head.clear()
            self.lines.clear()
            return
        self.head.update((len(lines), *head[1:]))
        if fresh:
            self.lines.put(lines)
        elif len(lines) > known:
            self.lines.appendList(lines[known:])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows), ignore_index=True).sort_values("offset", kind="stable")
        head = tuple(self.head.get()) if self.head.exists() else None
        lines = [(int(o), line) for o, line in self.lines.get()] if head else []
        known, fresh = len(lines), False
        now = timerValues.getCurrentProcessingTimeInMs() if self.schedule_ms else 0
        limit, rotate = self.files.flush_size, self.files.rotate_ms
        text = [came[c].where(came[c].notna(), None).tolist() for c in DECIDING]
        for offset, moment, line, *deciding in zip(came["offset"].tolist(), came["moment"].tolist(), came["line"].tolist(), *text, strict=True):
            late = rotate and head and head[1] != _NO_TIME and moment - head[1] >= rotate
            if head and (len(lines) >= limit or late):
                yield self._closed(key, head, lines)
                head, lines = None, []
            if head is None:
                head, fresh = (0, int(moment), now, *deciding), True
                if self.schedule_ms:
                    self.handle.registerTimer(now + self.schedule_ms)
            lines.append((int(offset), line))
        if len(lines) >= limit:
            yield self._closed(key, head, lines)
            head, lines, fresh = None, [], True
        self._keep(head, lines, fresh, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        head = tuple(self.head.get()) if self.head.exists() else None
        if head and expiredTimerInfo.getExpiryTimeInMs() >= head[2] + self.schedule_ms:
            yield self._closed(key, head, [(int(o), line) for o, line in self.lines.get()])
            self._keep(None, [], True, 0)

    def close(self) -> None:
        pass


def closing_files(lines: DataFrame, files: FileOptions, schedule_ms: int | None = None) -> DataFrame:
    """One row per file that closes, from a stream of routed lines (topic, partition, offset, timestamp, path, line, deciding headers)."""
    lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    shaped = lines.select(
        F.coalesce("topic", F.lit("")).alias("topic"), F.col("partition").cast("int").alias("partition"), F.coalesce("path", F.lit("")).alias("path"),
        "offset", F.coalesce(F.unix_millis("timestamp"), F.lit(_NO_TIME)).alias("moment"), "line", *DECIDING,
    )
    return shaped.groupBy("topic", "partition", "path").transformWithStateInPandas(
        OpenFile(files, schedule_ms), CLOSED, "Append", "ProcessingTime" if schedule_ms else "None")


def still_open(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The files that a stopped stream has left open, in the shape of closed ones; read from its checkpoint, which stays as it is."""
    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    heads = state("head").select("key.*", F.col("value.*"))
    lines = state("lines").select("key.*", F.col("list_element.offset").alias("offset"), F.col("list_element.line").alias("line"))
    # An open file has at most flush_size lines.
    ordered = F.array_sort(F.collect_list(F.struct("offset", "line")))
    files = lines.groupBy("topic", "partition", "path").agg(ordered.alias("l")).join(heads, ["topic", "partition", "path"])
    return files.select(
        "topic", F.col("partition").cast("int").alias("partition"), "path", F.col("l")[0]["offset"].alias("start_offset"),
        F.element_at("l", -1)["offset"].alias("end_offset"), F.size("l").cast("bigint").alias("records"), *DECIDING,
        F.transform("l", lambda x: x["line"]).alias("lines"),
    )


def land_closed(
    closed: DataFrame, root: str, batch: int, files: FileOptions, policy: Policy | None = None, ring: KeyRing | None = None,
    seal: SealOptions | None = None, roots: Mapping[str, str] | None = None,
) -> None:
    """Frame, seal and write closed files and commit them as one batch. Their rows are evaluated once, and nothing is staged."""
    lines = closed.select(
        "topic", "partition", "path", F.lit(0).cast("bigint").alias("rotation"), F.col("start_offset").alias("file_no"), "start_offset", *DECIDING,
        F.posexplode("lines").alias("line_no", "line"),
    )
    # Frames go by the order of lines; a file is named after its first record.
    assigned = lines.withColumn("line_no", F.col("line_no").cast("bigint")).withColumn("offset", F.col("start_offset") + F.col("line_no")).drop("start_offset")
    land_committed(seal_frames(file_frames(assigned, files), policy, ring, seal), root, batch, dict(roots or {}))


def stream_open_files(
    source: DataFrame, prepare: Callable[[DataFrame], DataFrame], root: str, checkpoint: str, files: FileOptions, policy: Policy | None = None,
    ring: KeyRing | None = None, seal: SealOptions | None = None, every_ms: int | None = None, schedule_ms: int | None = None,
    tolerance: str = "all", roots: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Land a stream as files that close by their own rules, whatever the trigger; each micro-batch commits the files that it closed.

    A replayed batch closes the same files from the same state and replaces its commit. ``every_ms`` is the trigger; without it everything
    available is read and the query ends. What is open then stays in the checkpoint: the next run goes on with it, and
    :func:`land_open_files` lands it as it is. Open lines lie in the checkpoint, so it needs the protection of clear records.
    """
    seal = seal or SealOptions()
    closed = closing_files(routed(checked(prepare(source), tolerance), seal), files, schedule_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        land_closed(batch, root, batch_id, files, policy, ring, seal, roots)

    trigger = {"processingTime": f"{every_ms} milliseconds"} if every_ms else {"availableNow": True}
    return closed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# The commit of open files comes before those of the stream, whose versions of a file replace it.
OPEN_BATCH = -1


def land_open_files(
    spark: SparkSession, root: str, checkpoint: str, files: FileOptions, policy: Policy | None = None, ring: KeyRing | None = None,
    seal: SealOptions | None = None, roots: Mapping[str, str] | None = None,
) -> None:
    """Land what a stopped stream has left open. A file that a later run goes on with is replaced by the longer one of the same name."""
    land_closed(still_open(spark, checkpoint), root, OPEN_BATCH, files, policy, ring, seal or SealOptions(), roots)
