"""Jaccard join of word n-gram sets with signature trees.

Documents with the same set become one class, and only classes are joined. A class meets those with which it shares one of its
rarest shingles (any two sets of similarity ``percent`` share one in a prefix of that order), so classes are gathered in cells around
the smallest class of a shared shingle. In a cell a signature tree is built: leaves hold a bitmap of their tokens, inner nodes
the OR and the AND of their children's and their range of sizes. A dual traversal of the tree with itself drops every pair of nodes
whose largest possible overlap is too small; what is left is compared exactly, unless it is connected already.
A cell of more than ``CELL_SHINGLES`` is dealt to a grid of bounded cells; first those with the first share, and the rest only where
the cell is not yet one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Words, computed, give_back, lookup, mixed, slices, written

WIDTH = 5
PERCENT = 80
# Counters of the sketch that orders shingles by rarity; a coarser order costs time, never links.
COUNTERS = 1 << 20
_PART = 1 << 14
# Sketches merged by one task at a time.
_FAN_IN = 128
CELL_SHINGLES = 1_500_000
CELL_CLASSES = 4_096
LOOKUP_VALUES = 4_000_000
# Members of cells that one call works on, about; it takes one cell after the other.
GROUP_MEMBERS = 1_000
# Whole sets go to their cells in waves: the shuffle files of one are gone before the next. At most so many, each of so many members.
WAVES = 4
WAVE_MEMBERS = 10_000
_FANOUT = 8
_CELL = ["cell", "x", "y"]


def shingle_sets(texts, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct fingerprints of each text's shingles; of the whole sequence where there are fewer words."""
    words = Words(texts, lower=True)
    runs = words.runs(width)
    out = []
    for row, count in enumerate(words.counts):
        first = words.first[row]
        if count >= width:
            out.append(np.unique(runs[first:first + count - width + 1]))
        else:
            out.append(np.array([words.whole(row)] if count else [], dtype=np.uint64))
    return out


def _counter(values: np.ndarray) -> np.ndarray:
    return (mixed(values) >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def rarity(df: DataFrame, text_col: str, width: int) -> np.ndarray:
    """Occurrences of all shingles of all rows by counter of a hash: ``COUNTERS`` numbers, whatever the corpus."""
    def count(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                for values in shingle_sets(batch.column(0).slice(start, stop - start), width):
                    np.add.at(total, _counter(values), 1)
        task = TaskContext.get().partitionId()
        parts = np.minimum(total, (1 << 32) - 1).astype("<u4").reshape(-1, _PART)
        kept = [p for p in range(len(parts)) if parts[p].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int32()), pa.array([task] * len(kept), pa.int64()), pa.array([parts[p].tobytes() for p in kept], pa.binary())],
            names=["part", "task", "counts"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_PART, dtype=np.int64)
        for counts in group["counts"]:
            total += np.frombuffer(counts, dtype="<u4")
        counts = np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes()
        return pd.DataFrame({"part": [key[0]], "task": [key[1]], "counts": [counts]})

    schema = "part int, task long, counts binary"
    rows = df.select(F.col(f"`{text_col}`")).mapInArrow(count, schema)
    for _ in range(3):
        rows = rows.withColumn("task", F.floor(F.col("task") / _FAN_IN)).groupBy("part", "task").applyInPandas(add, schema)
    out = np.zeros((COUNTERS // _PART, _PART), dtype=np.uint32)
    # Beyond the cube of the fan-in several rows per part are left: they are added here.
    for r in rows.collect():
        out[r["part"]] = np.minimum(out[r["part"]].astype(np.int64) + np.frombuffer(r["counts"], dtype="<u4"), (1 << 32) - 1)
    return out.reshape(-1)


def _prefix(values: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles, of which any set at least ``percent`` similar has one among its own."""
    size = len(values) - -(-len(values) * percent // 100) + 1
    return values[np.lexsort((values, counts[_counter(values)]))[:size]]


def bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    """One bit per token, ``bits`` (a power of two) in all."""
    out = np.zeros(bits, dtype=bool)
    out[(values % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def _width(size: int, per_token: int) -> int:
    return max(64, 1 << (per_token * max(size, 1) - 1).bit_length())


class SignatureTree:
    """Bitmaps of the sets of a cell, of equal width, in levels from the leaves up; ``sizes`` are the sets'."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray):
        own = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        # (OR, AND, smallest size, largest size, most tokens that share a bit with another)
        self.levels = [(maps, maps, sizes, sizes, sizes - own)]
        while len(self.levels[-1][0]) > 1:
            any_, all_, low, high, lost = self.levels[-1]
            cuts = np.arange(0, len(low), _FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(any_, cuts), np.bitwise_and.reduceat(all_, cuts), np.minimum.reduceat(low, cuts),
                np.maximum.reduceat(high, cuts), np.maximum.reduceat(lost, cuts),
            ))

    def candidates(self, percent: int, connected):
        """Pairs of leaves that no bound excludes, in batches; ``connected(level, a, b)`` may drop pairs of nodes."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
        while stack:
            level, a, b = stack.pop()
            if level < top:
                keep = ~connected(level, a, b)
                a, b = a[keep], b[keep]
                keep = self._possible(level, a, b, percent)
                a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == 0:
                yield a, b
                continue
            below = len(self.levels[level - 1][2])
            shift = np.arange(_FANOUT)
            left = np.repeat((a[:, None] * _FANOUT + shift)[:, :, None], _FANOUT, axis=2).ravel()
            right = np.repeat((b[:, None] * _FANOUT + shift)[:, None, :], _FANOUT, axis=1).ravel()
            keep = (left < below) & (right < below) & ((left < right) | ((left == right) & (level > 1)))
            left, right = left[keep], right[keep]
            step = max(_FANOUT, (1 << 21) // max(1, self.levels[0][0].shape[1]))
            stack += [(level - 1, left[i:i + step], right[i:i + step]) for i in range(0, len(left), step)][::-1]

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        any_, all_, low, high, lost = self.levels[level]
        least = np.maximum(low[a], low[b])
        need = np.maximum(-(-percent * (low[a] + low[b]) // (100 + percent)), -(-percent * least // 100))
        fits = need <= np.minimum(high[a], high[b])
        kept = np.flatnonzero(fits)
        a, b, need = a[kept], b[kept], need[kept]
        shared = np.bitwise_count(any_[a] & any_[b]).sum(axis=1, dtype=np.int64) + np.minimum(lost[a], lost[b])
        only_a = high[a] - np.bitwise_count(all_[a] & ~any_[b]).sum(axis=1, dtype=np.int64)
        only_b = high[b] - np.bitwise_count(all_[b] & ~any_[a]).sum(axis=1, dtype=np.int64)
        fits[kept] = np.minimum(np.minimum(shared, only_a), only_b) >= need
        return fits


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the first set (in the given order) that it reaches by links; ties in nothing: a set without links is its own."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:1].tolist()))
    inside = [sets[i] for i in order]
    bits = _width(max(map(len, sets), default=1), 8)
    tree = SignatureTree(np.array([bitmap(s, bits) for s in inside]), np.array([len(s) for s in inside], dtype=np.int64))
    root = np.arange(len(sets))

    def connected(level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if level:
            # Nodes whose leaves are all in one component.
            cuts = np.arange(0, len(root), _FANOUT**level)
            low, high = np.minimum.reduceat(root, cuts), np.maximum.reduceat(root, cuts)
            return (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        return root[a] == root[b]

    for a, b in tree.candidates(percent, connected):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if root[x] == root[y]:
                continue
            one, two = inside[x], inside[y]
            both = len(np.intersect1d(one, two, assume_unique=True))
            if both and 100 * both >= percent * (len(one) + len(two) - both):
                root[root == max(root[x], root[y])] = min(root[x], root[y])
    first: dict[int, int] = {}
    for place, r in enumerate(root.tolist()):
        first[r] = min(first.get(r, order[place]), order[place])
    out = np.empty(len(sets), dtype=np.int64)
    for place, r in enumerate(root.tolist()):
        out[order[place]] = first[r]
    return out


def possible(maps: list[np.ndarray], sizes: list[int], percent: int = PERCENT) -> np.ndarray:
    """Which sets have another one in the cell that their bitmaps alone do not exclude.

    Bitmaps are as wide as their own set asks for (a power of two). Sets that may be linked differ in size by less than a
    factor of two, so each width is held against itself and the next one, folded to its half.
    """
    widths = np.array([len(m) for m in maps])
    sizes_ = np.array(sizes, dtype=np.int64)
    hit = np.zeros(len(maps), dtype=bool)
    for width in sorted(set(widths.tolist())):
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        rows = rows[np.argsort(sizes_[rows], kind="stable")]
        folded = [maps[r] if len(maps[r]) == width else maps[r][:width] | maps[r][width:] for r in rows]
        tree, marked = SignatureTree(np.array(folded), sizes_[rows]), np.zeros(len(rows), dtype=bool)

        def done(level: int, a: np.ndarray, b: np.ndarray, marked=marked) -> np.ndarray:
            every = np.minimum.reduceat(marked, np.arange(0, len(marked), _FANOUT**level)) if level else marked
            return every[a] & every[b]

        for a, b in tree.candidates(percent, done):
            marked[a] = marked[b] = True
        hit[rows[marked]] = True
    return hit


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) reaches. Nothing of it is gathered on the driver."""
    both = written(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        told = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("told"))
        lower = labels.join(told, "node").select("node", "label", F.least("label", "told").alias("lower"))
        # A label's own label is as good or better: chains shorten by half each time.
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("next"))
        moved = written(lower.join(jump, "lower").select("node", "label", F.least("lower", "next").alias("new")), "labels")
        changed = moved.where(F.col("new") < F.col("label")).limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def _largest(members: DataFrame) -> DataFrame:
    """``members`` without the cells that lie within another one: all their pairs meet there.

    A cell is named after its smallest class, and is held against the smallest cell that has this class: among near copies that
    is the cell around the smallest of them, so of the many cells of a group about one is left.
    """
    above = members.groupBy(F.col("one").alias("cell")).agg(F.min("cell").alias("above")).where("above < cell")
    held = members.join(above, "cell").select("cell", "above", "one")
    inside = members.select(F.col("cell").alias("above"), "one", F.lit(1).alias("in")).distinct()
    within = held.join(inside, ["above", "one"], "left").groupBy("cell").agg(F.count("in").alias("i"), F.count("*").alias("n")).where("i = n")
    return written(members.join(within, "cell", "left_anti"), "members")


def _together(needed: DataFrame) -> Column:
    """A number that puts cells of about ``GROUP_MEMBERS`` members together: most cells are small, and a group costs time."""
    members = needed.agg(F.sum(F.size("cells"))).first()[0] or 0
    return F.pmod(F.xxhash64(*_CELL), F.lit(-(-members // GROUP_MEMBERS) or 1)).alias("group")


def _waves(needed: DataFrame) -> Iterator[DataFrame]:
    """``needed`` cell by cell in several tables; each cell is whole in one of them."""
    members = needed.agg(F.sum(F.size("cells"))).first()[0] or 0
    waves = max(1, min(WAVES, members // WAVE_MEMBERS))
    if waves == 1:
        yield needed
        return
    dealt = needed.withColumn("waves", F.transform("cells", lambda c: F.pmod(F.xxhash64(c, F.lit("wave")), F.lit(waves))))
    for wave in range(waves):
        own = F.expr(f"filter(cells, (c, i) -> waves[i] = {wave})")
        yield written(dealt.select("_doc", "_hash", own.alias("cells")).where(F.size("cells") > 0), "cells")


def _edges(docs: DataFrame, cells: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): what the classes of each cell are linked to, from (cell, x, y, rep) with ``rep`` the class's document."""
    per_document = cells.select(F.col("rep._doc").alias("_doc"), F.col("rep._hash").alias("_hash"), F.struct("cell", "x", "y").alias("where")).groupBy(
        "_doc", "_hash").agg(F.collect_set("where").alias("cells"))
    needed = written(per_document, "cells")
    values = needed.agg(F.sum(F.size("cells") * 3 + 2)).first()[0] or 0

    def maps(texts):
        sets = shingle_sets(texts, width)
        return [bitmap(s, _width(len(s), 2)).tobytes() for s in sets], [len(s) for s in sets]

    def screen(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates([*_CELL, "_doc", "_hash"], ignore_index=True)
        bits, sizes, hit = group["bits"].tolist(), group["n"].to_numpy(), np.zeros(len(group), dtype=bool)
        for rows in group.groupby(_CELL, sort=False).indices.values():
            hit[rows] = possible([np.frombuffer(bits[r], dtype=np.uint64) for r in rows], sizes[rows].tolist(), percent)
        give_back()
        return group.loc[hit, [*_CELL, "_doc", "_hash"]]

    # First the bitmaps, a quarter of a byte per shingle, go to the cells; only what they leave follows with whole sets.
    kind = docs.schema["_doc"].dataType.simpleString()
    bits = computed(docs.join(lookup(needed, values, LOOKUP_VALUES), ["_doc", "_hash"]), ["_text"], "bits binary, n long", maps, keep=["_doc", "_hash", "cells"])
    sent = bits.select("_doc", "_hash", "bits", "n", F.explode("cells").alias("w")).select("_doc", "_hash", "bits", "n", "w.*")
    left = sent.groupBy(_together(needed)).applyInPandas(screen, f"cell long, x long, y long, _doc {kind}, _hash long")
    needed = written(left.groupBy("_doc", "_hash").agg(F.collect_list(F.struct("cell", "x", "y")).alias("cells")), "cells")

    def sets(texts):
        return [[s.tobytes() for s in shingle_sets(texts, width)]]

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates([*_CELL, "_doc"]).sort_values("_doc", ignore_index=True)
        ids, sets, found = group["_doc"].tolist(), group["shingles"].tolist(), []
        for rows in group.groupby(_CELL, sort=False).indices.values():
            first = linked([np.frombuffer(sets[r], dtype=np.uint64) for r in rows], percent)
            found += [(ids[rows[i]], ids[rows[f]]) for i, f in enumerate(first) if f != i]
        give_back()
        return pd.DataFrame(found, columns=["a", "b"])

    found = []
    for part in _waves(needed):
        values = part.agg(F.sum(F.size("cells") * 3 + 2)).first()[0] or 0
        joined = docs.join(lookup(part, values, LOOKUP_VALUES), ["_doc", "_hash"])
        rows = computed(joined, ["_text"], "shingles binary", sets, keep=["_doc", "cells"])
        placed = rows.select("_doc", "shingles", F.explode("cells").alias("w")).select("_doc", "shingles", "w.*")
        found.append(written(placed.groupBy(_together(part)).applyInPandas(link, f"a {kind}, b {kind}"), "links"))
    return reduce(DataFrame.unionAll, found)


def near_groups(df: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _hash, n_shingles, component_id) of every row of ``df``; ``_hash`` is the text's xxhash64.

    ``component_id`` is the smallest id reachable by links, the row's own included. Texts without words (null, empty) have no shingles and
    link with nothing, nor do rows with a null id, whose component is null. Rows of one id are judged each by its own
    text; repeated rows agree. An empty table gives no rows. Other columns are not read; whole texts are, of any length.
    """
    ids, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    docs = df.select(ids.alias("_doc"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    shared_counts = df.sparkSession.sparkContext.broadcast(rarity(docs, "_text", width))

    def one_of(values: np.ndarray) -> int:
        return int(np.add.reduce(mixed(values), dtype=np.uint64).view(np.int64))

    def mark(texts):
        sizes, one, two = [], [], []
        for values in shingle_sets(texts, width):
            sizes.append(len(values))
            one.append(one_of(values))
            two.append(int(np.bitwise_xor.reduce(mixed(values + np.uint64(0x5851F42D4C957F2D)), initial=np.uint64(0)).view(np.int64)))
        return sizes, one, two

    def prefixes(texts):
        sets = shingle_sets(texts, width)
        return [one_of(v) for v in sets], [_prefix(v, shared_counts.value, percent).view(np.int64) if len(v) else [] for v in sets]

    marked = written(computed(docs, ["_text"], "n long, one long, two long", mark, keep=["_doc", "_hash"]), "classes")
    classed = marked.where((F.col("n") > 0) & F.col("_doc").isNotNull())
    same = ["n", "one", "two"]
    classes = classed.groupBy(*same).agg(F.min(F.struct("_doc", "_hash")).alias("rep"))
    # A fifth of all shingles: computed again for each use rather than stored.
    keys = computed(docs.where(F.col("_doc").isNotNull()), ["_text"], "one long, keys array<long>", prefixes, keep=[]).select(F.explode("keys").alias("key"), "one")
    met = keys.groupBy("key").agg(F.min("one").alias("cell"), F.max("one").alias("last")).where(F.col("cell") < F.col("last")).select("key", "cell")
    # Stored, so that the join has two plain sides and the rows of a hot key can be split.
    met = written(met, "met")
    members = keys.join(met, "key").select("cell", "one").distinct().join(classes, "one").select("cell", "one", "n", "rep")
    members = _largest(written(members, "members"))
    size = members.groupBy("cell").agg(F.greatest(F.ceil(F.sum("n") / CELL_SHINGLES), F.ceil(F.count("*") / CELL_CLASSES)).alias("shares"))
    split = members.join(size, "cell").withColumn("share", F.pmod(F.xxhash64("rep", "cell"), F.col("shares")))
    grid = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).select(
        "cell", "shares", F.least("share", "other").alias("x"), F.greatest("share", "other").alias("y"), "rep")
    edges = _edges(docs, grid.where((F.col("x") == 0) | (F.col("x") == F.col("y"))), width, percent)
    labels = components(edges)
    # Cells that the first row of the grid has not made one component: all other pairs of shares.
    known = split.where("shares > 2").withColumn("node", F.col("rep._doc")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed_cells = written(known.groupBy("cell").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("cell"), "mixed")
    if mixed_cells.limit(1).count():
        rest = grid.where("shares > 2 AND x > 0 AND x < y").join(mixed_cells, "cell", "left_semi")
        labels = components(edges.unionAll(_edges(docs, rest, width, percent)))
    # Between documents of one class there is no edge: a class's label is that of its first document.
    named = classes.select(*same, F.col("rep._doc").alias("node")).join(labels, "node", "left").select(*same, F.coalesce("label", "node").alias("label"))
    alone = marked.where((F.col("n") == 0) | F.col("_doc").isNull()).select(F.col("_doc").alias(id_col), "_hash", F.col("n").alias("n_shingles"), F.col("_doc").alias("component_id"))
    grouped = classed.select("_doc", "_hash", *same).join(named, same).select(F.col("_doc").alias(id_col), "_hash", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"))
    return grouped.unionAll(alone)


def keep_representatives(df: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the documents whose component has a smaller id. Rows of one id are one document and stay or go by their own
    texts; all columns are kept, in order. Cases as in ``near_groups``."""
    gone = near_groups(df, width, percent, id_col, text_col).where(F.col("component_id") < F.col(f"`{id_col}`")).select(
        F.col(f"`{id_col}`").alias("_gone"), "_hash").distinct()
    gone = written(gone, "copies")
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    on = (F.col(names[id_col]) == F.col("_gone")) & (F.xxhash64(F.col(names[text_col])) == F.col("_hash"))
    left = df.withColumnsRenamed(names).join(lookup(gone, gone.count()), on, "left_anti")
    return left.select(*(F.col(n).alias(c) for c, n in names.items()))
