"""Helpers the text operators share: tables, scratch tables, slices of Arrow batches, word fingerprints."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quayside.session import shared_dir

# Bytes of text that one step of a task works on at once; a longer text is a step of its own.
SLICE_BYTES = 1 << 20
# Rows (of a few words each) a lookup may have to be broadcast; beyond it the join shuffles.
LOOKUP_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and still there when executors are lost."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with shuffles_given_back(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """Remove a job's shuffle files when it ends; otherwise they stay until the driver happens to collect garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def lookup(df: DataFrame, rows: int, limit: int = LOOKUP_ROWS) -> DataFrame:
    """Hint a broadcast for a table counted to at most ``limit`` short rows; otherwise the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with at most ``limit`` bytes each, or one row."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = ends[start] - lengths[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end and the rows' offsets; a null counts as empty."""
    column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Return freed memory to the system at the end of a task: the worker process lives on, for stages with other needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which has its own ways


# What a worker keeps between tasks: the cache of one operator at a time.
_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once for ``key`` and dropped when a worker turns to other work."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def computed(
    df: DataFrame, inputs: list[str], fields: str, step: Callable[..., list], setup: Callable[[], object] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of every row (all by default) and those that ``step`` computes from ``inputs``.

    ``step`` gets one Arrow array per input, the last of which is the text, and first what ``setup`` made, once a
    task; it returns one sequence per field and row. Works slice by slice, so memory follows the slice or the longest text.
    A field with the name of a kept column gets ``_`` before it.
    """
    keep = df.columns if keep is None else keep
    given = list(dict.fromkeys([*keep, *inputs]))
    source = df.select(*(F.col(f"`{c}`") for c in given))
    kinds = T.StructType([T.StructField(fresh(df.select(*(F.col(f"`{c}`") for c in keep)), f.name), f.dataType) for f in T.StructType.fromDDL(fields)])
    result = T.StructType([*(source.schema[c] for c in keep), *kinds])
    at, kept = [given.index(c) for c in inputs], [given.index(c) for c in keep]

    def run(batches):
        if not setup:
            _KEPT.clear()
        state = (setup(),) if setup else ()
        types = [to_arrow_type(f.dataType) for f in kinds]
        for batch in batches:
            for start, stop in slices(batch.column(at[-1])):
                part = batch.slice(start, stop - start)
                made = step(*state, *(part.column(i) for i in at))
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *arrays], names=result.names)
        give_back()

    return source.mapInArrow(run, result)


# --- fingerprints of words and runs of words -------------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xD6E8FEB86659FD93)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BLOCK = 8
# Words of more bytes than this are digested one by one, the others block by block together.
_SHORT = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(_BLOCK)] + [(1 << 64) - 1], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole value; no two values become one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _blocks_at(data: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each ``start`` on, as numbers; ``data`` has eight bytes more than its words reach."""
    views = np.lib.stride_tricks.sliding_window_view(data, _BLOCK)
    return views[start].view("<u8").ravel() & _MASKS[np.minimum(left, _BLOCK)]


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate((data, np.zeros(_BLOCK, dtype=np.uint8)))


def byte_prints(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of byte ranges of padded ``data``.

    Blocks of eight bytes are taken in one by one, each through a full mixing, so nothing cancels out; ranges of one length up
    to eight bytes never share a fingerprint. Long ranges are digested by themselves.
    """
    size = end - start
    out = mixed(size.astype(np.uint64) * _ODD + _WORD)
    live = np.flatnonzero(size <= _SHORT)
    at = 0
    while len(live):
        left = size[live] - at
        if at:
            live, left = live[left > 0], left[left > 0]
        out[live] = mixed((out[live] ^ _blocks_at(data, start[live] + at, left)) * _ODD)
        at += _BLOCK
        live = live[left > _BLOCK]
    for i in np.flatnonzero(size > _SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def same_bytes(data: np.ndarray, start: np.ndarray, other: np.ndarray, other_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ranges of two padded byte arrays, of equal sizes, hold the same bytes."""
    same = np.ones(len(size), dtype=bool)
    live = np.flatnonzero((size > 0) & (size <= _SHORT))
    at = 0
    while len(live):
        left = size[live] - at
        same[live] &= _blocks_at(data, start[live] + at, left) == _blocks_at(other, other_start[live] + at, left)
        at += _BLOCK
        live = live[left > _BLOCK]
    for i in np.flatnonzero(size > _SHORT).tolist():
        same[i] = np.array_equal(data[start[i]:start[i] + size[i]], other[other_start[i]:other_start[i] + size[i]])
    return same


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of what ``a`` and ``b`` stand for, one after the other."""
    return mixed(a * _ODD + b)


def run_prints(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Fingerprint of each ``width`` successive values; another ``seed`` gives independent ones.

    Runs are put together from runs of half the width, each time through a full mixing, so no pattern of values cancels out.
    """
    level = mixed(words ^ np.uint64(seed)) if seed else words
    size, done, out, rest = 1, 0, None, width
    while True:
        if rest & 1:
            count = max(len(words) - done - size + 1, 0)
            out = level[:count] if out is None else _joined(out[:count], level[done:done + count])
            done += size
        rest >>= 1
        if not rest:
            return out
        count = max(len(words) - 2 * size + 1, 0)
        level = _joined(level[:count], level[size:size + count])
        size *= 2


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of several texts: byte ranges, rows and 64-bit fingerprints.

    ``lower`` folds A-Z first. ``first[r]:first[r + 1]`` are the words of row ``r``; ``data`` is padded.
    """

    def __init__(self, column: pa.Array, lower: bool):
        data, offsets = text_bytes(column)
        size = len(data)
        inside = np.zeros(size + 1, dtype=bool)
        inside[:size] = ~_SPACE[data]
        starts = inside[:size].copy()
        starts[1:] &= ~inside[: size - 1] if size else starts[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < size)]
        starts[cuts] = inside[cuts]
        ends = inside[:size].copy()
        ends[: size - 1] &= ~inside[1:size] if size else ends[:0]
        ends[cuts - 1] = inside[cuts - 1]
        self.data, self.offsets = _padded(_FOLD[data] if lower else data), offsets
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.hash = byte_prints(self.data, self.start, self.end)

    def runs(self, width: int, seed: int = 0) -> np.ndarray:
        """Fingerprint of the ``width`` words from each word on; meaningless where the row has fewer words left."""
        return run_prints(self.hash, width, seed)

    def whole(self, row: int) -> np.uint64:
        """Fingerprint of all words of a row that has any, as ``runs`` would give it for that width."""
        a, b = self.first[row], self.first[row + 1]
        return run_prints(self.hash[a:b], int(b - a))[0]


# --- a total order without a single task -----------------------------------------------------------------------------

# Rows of one range of an ordered table, about.
ORDERED_ROWS = 100_000


def ordered(df: DataFrame, order: list[str], purpose: str, rows: int = ORDERED_ROWS) -> DataFrame:
    """``df``, a stored table, stored again in ranges of ``order``, with ``_range`` and ``_place``: comparing (_range, _place) compares rows.

    Rows equal in ``order`` come in any order; nulls come first. A hot value is spread over ranges, as a last,
    arbitrary column breaks ties.
    """
    parts = -(-df.count() // rows) or 1
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(parts, *(F.col(f"`{c}`") for c in order), F.col("_tie"))
    sorted_rows = dealt.sortWithinPartitions(*(F.col(f"`{c}`") for c in order), "_tie").drop("_tie")
    at = F.monotonically_increasing_id()
    return written(sorted_rows.withColumn("_range", F.shiftright(at, 33)).withColumn("_place", at.bitwiseAND(F.lit((1 << 33) - 1))), purpose)


def first_of_ranges(df: DataFrame, group: str, totals: dict[str, Column]) -> DataFrame:
    """Per (group, _range) of an ``ordered`` table: ``totals``, each summed over the group's ranges before, and the range's least place.

    One short row per group and range, summed up along the ranges of each group. The order must start with ``group``.
    """
    parts = df.groupBy(group, "_range").agg(F.min("_place").alias("_least"), *(v.alias(k) for k, v in totals.items()))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(group, "_range", "_least", *(F.coalesce(F.sum(k).over(before), F.lit(0)).cast("long").alias(k) for k in totals))


def ranked(df: DataFrame, group: str) -> DataFrame:
    """An ``ordered`` table with ``_rank``, counted from 0 within ``group`` (no nulls), by which its order must start."""
    first = first_of_ranges(df, group, {"_first": F.count("*")})
    # Every (group, range) is one row there and at most one range of rows here.
    return df.join(first, [group, "_range"]).withColumn("_rank", F.col("_first") + F.col("_place") - F.col("_least")).drop("_first", "_least")
