"""Merkle manifest of a dataset with nested-interval labels.

Every row is a leaf of the tree of its group; its rank there is its interval [rank, rank + 1). Nodes carry the interval of leaf ranks
that they cover, so a node is an ancestor of all nodes whose intervals lie in its own. Nodes are stored in buckets of
``LEVELS`` levels: those over the same ``arity ** LEVELS`` nodes of the bucket's lowest level. A bucket is a bounded group
however many leaves a tree has, and each band of levels has that many times fewer buckets than the one below. Leaves meet their
ancestors by containment, bucket by bucket; what a parent's interval covers beyond the node's own names the siblings.
The trees' roots, in order, are the leaves of one more tree.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ordered, ranked, written

ARITY = 2
# Levels of one bucket: at most ARITY ** LEVELS nodes at its bottom.
LEVELS = 10
# A step of a proof: the digests of the run before and after the node, next to each other.
STEP = "struct<before:string,after:string>"
_NODE = "tree string, bucket long, level int, lo long, hi long, digest string, top boolean"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(F.lit(""), *map(encoded, values)), 256)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _above(digests: list[str], arity: int) -> list[str]:
    return [digest_of("".join(digests[at:at + arity])) for at in range(0, len(digests), arity)]


def _depth(size: int, whole: bool, arity: int, levels: int) -> int:
    """Levels above the bottom of a bucket: all of them, but where the bucket is the whole tree and the tree is lower."""
    if not whole:
        return levels
    depth = 0
    while arity**depth < size:
        depth += 1
    return depth


def _bucket_nodes(arity: int, levels: int):
    """All nodes above the bottom nodes of one bucket, with the intervals that they cover; the highest is marked."""
    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        tree, bucket = key[0].as_py(), key[1].as_py()
        group = group.sort_by("lo")
        lo, hi = group["lo"].to_numpy(), group["hi"].to_numpy()
        digests = group["digest"].to_pylist()
        # The first bucket is a whole tree unless it is full; a full one has all levels either way.
        depth = _depth(len(digests), bucket == 0, arity, levels)
        found = [(lo, hi, digests)]
        for _ in range(depth):
            starts = np.arange(0, len(digests), arity)
            lo, hi = lo[starts], hi[np.minimum(starts + arity, len(hi)) - 1]
            digests = _above(digests, arity)
            found.append((lo, hi, digests))
        level = np.repeat(np.arange(depth + 1), [len(x) for x, _, _ in found])
        rows = len(level)
        return pa.table({
            "tree": pa.array([tree] * rows, pa.string()), "bucket": np.full(rows, bucket, np.int64), "level": pa.array(level, pa.int32()),
            "lo": np.concatenate([x for x, _, _ in found]), "hi": np.concatenate([x for _, x, _ in found]),
            "digest": pa.array([d for _, _, x in found for d in x], pa.string()), "top": level == depth,
        })

    return build


@dataclass
class Forest:
    """Stored nodes by band, and (tree, subroot) of every tree."""

    bands: list[DataFrame]
    roots: DataFrame
    arity: int
    levels: int


def build_forest(leaves: DataFrame, purpose: str, arity: int = ARITY, levels: int = LEVELS) -> Forest:
    """Nodes over ``leaves`` (tree, rank, digest), ranks counted from 0 without gaps in each tree; no leaves, no trees.

    Each node is stored once, with its interval; one job per ``levels`` levels.
    """
    if arity < 2 or levels < 1:
        raise ValueError("a tree needs an arity of 2 or more, a bucket a level or more")
    span = arity**levels
    bottom = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")
    bands: list[DataFrame] = []
    width = 1
    while True:
        width *= span
        bucketed = bottom.withColumn("bucket", F.expr(f"lo div {width}L"))
        nodes = bucketed.groupBy("tree", "bucket").applyInArrow(_bucket_nodes(arity, levels), _NODE)
        bands.append(written(nodes, f"{purpose}-{len(bands)}"))
        bottom = bands[-1].where("top").select("tree", "lo", "hi", "digest")
        if bands[-1].where("bucket > 0").isEmpty():
            return Forest(bands, bottom.select("tree", F.col("digest").alias("subroot")), arity, levels)


def _bucket_paths(columns: list[str]):
    """Proof steps of the bucket's bottom nodes: their ancestors by containment, the siblings by what the parents cover beyond."""
    def attach(bottom: pa.Table, nodes: pa.Table) -> pa.Table:
        lo = bottom["lo"].to_numpy()
        level = nodes["level"].to_numpy()
        by_level = [nodes.filter(pa.array(level == k)).sort_by("lo") for k in range(level.max() + 1)]
        top = by_level[-1]
        rest = top["steps"][0].as_py() or []
        paths: list[list[dict]] = [[] for _ in range(len(lo))]
        for own, parents in pairwise(by_level):
            own_lo, digests = own["lo"].to_numpy(), own["digest"].to_pylist()
            # The node of this level and its parent are those whose intervals contain the leaf's.
            at = np.searchsorted(own_lo, lo, side="right") - 1
            above = np.searchsorted(parents["lo"].to_numpy(), lo, side="right") - 1
            # Interval difference: the nodes that the parent covers before the own node and after it.
            begin = np.searchsorted(own_lo, parents["lo"].to_numpy()[above])
            end = np.searchsorted(own_lo, parents["hi"].to_numpy()[above])
            for path, a, i, z in zip(paths, begin.tolist(), at.tolist(), end.tolist(), strict=True):
                path.append({"before": "".join(digests[a:i]), "after": "".join(digests[i + 1:z])})
        made = bottom.select(columns)
        steps = pa.array([path + rest for path in paths], pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
        ends = pa.array([top["subroot"][0].as_py()] * len(lo), pa.string())
        return made.append_column("steps", steps).append_column("subroot", ends)

    return attach


def _paths(bottom: DataFrame, nodes: DataFrame, above: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``bottom`` (tree, bucket, lo) with steps up to the tree's root and beyond, and the root's digest."""
    fields = {f.name: f.dataType.simpleString() for f in bottom.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in columns), f"steps array<{STEP}>", "subroot string"])
    # A bucket's highest node meets its own steps, one row per bucket.
    known = nodes.join(above, ["tree", "lo", "top"], "left").select("tree", "bucket", "level", "lo", "hi", "digest", "top", "steps", "subroot")
    return bottom.groupBy("tree", "bucket").cogroup(known.groupBy("tree", "bucket")).applyInArrow(_bucket_paths(columns), schema)


def attach_paths(leaves: DataFrame, columns: list[str], forest: Forest, roots: DataFrame, purpose: str) -> DataFrame:
    """``columns`` of every leaf (tree, rank), its proof ``steps`` from the leaf on, and ``subroot``.

    ``roots`` has (tree, steps, subroot): what follows above each tree. Bands are walked from the top, where they are smallest.
    """
    span = forest.arity**forest.levels
    above = roots.select("tree", F.lit(0).cast("long").alias("lo"), F.lit(True).alias("top"), "steps", "subroot")
    for band in range(len(forest.bands) - 1, 0, -1):
        nodes = forest.bands[band]
        # New names, as both sides of the join come from one table.
        bottom = nodes.where("level = 0").select(*(F.col(c).alias(c) for c in ("tree", "bucket", "lo")))
        paths = _paths(bottom, nodes, above, ["tree", "lo"])
        above = written(paths.select("tree", "lo", F.lit(True).alias("top"), "steps", "subroot"), f"{purpose}-{band}")
    bottom = leaves.withColumn("lo", F.col("rank")).withColumn("bucket", F.expr(f"rank div {span}L"))
    return _paths(bottom, forest.bands[0], above, columns)


@dataclass
class Manifest:
    """The stored leaves (key columns, leaf, tree, rank), the trees over them and the tree over the trees."""

    leaves: DataFrame
    forest: Forest
    crown: Forest
    roots: DataFrame

    def root(self) -> str | None:
        """The digest of the whole dataset; None where it has no rows."""
        row = self.crown.roots.first()
        return row["subroot"] if row else None


def build_manifest(
    df: DataFrame, columns: list[str], group_col: str = "lang", key_col: str = "doc_id", keep: dict[str, Column] | None = None,
    arity: int = ARITY, levels: int = LEVELS, purpose: str = "manifest",
) -> Manifest:
    """Leaves over ``columns`` of every row of ``df``, a tree per value of ``group_col`` (null is a value, the first), a tree over those.

    Leaves ascend by ``key_col``, null first, and rows of one key by their digests, so the result does not depend on the order of
    rows; equal rows are leaves of their own. Nulls in any column and empty or very long texts are told apart by their lengths. An
    empty table has no root. ``keep`` names further values of each row. Other columns are not read; their names
    cannot clash. A hot group is ordered and cut into buckets by rank, so no task has a whole tree.
    """
    keep = keep or {}
    # A mark before the group's name keeps null first, apart from all names, and bytewise order.
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-"))
    hashed = df.select(
        F.col(f"`{key_col}`").alias("key"), tree.alias("tree"), leaf_digest([F.col(f"`{c}`") for c in columns]).alias("digest"),
        *(v.alias(k) for k, v in keep.items()),
    )
    # Stored before ordering, which reads it more than once.
    stored = written(hashed, f"{purpose}-hashed")
    order = ordered(stored, ["tree", "key", "digest"], f"{purpose}-order")
    leaves = written(ranked(order, "tree").withColumnRenamed("_rank", "rank").drop("_range", "_place"), f"{purpose}-leaves")
    forest = build_forest(leaves, f"{purpose}-nodes", arity, levels)
    trees = ordered(written(forest.roots.select(F.lit("").alias("all"), "tree", "subroot"), f"{purpose}-trees"), ["all", "tree"], f"{purpose}-sorted")
    tops = ranked(trees, "all").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("_rank").alias("rank"), F.col("subroot").alias("digest"))
    tops = written(tops, f"{purpose}-tops")
    crown = build_forest(tops, f"{purpose}-crown", arity, levels)
    end = crown.roots.select("tree", F.array().cast(f"array<{STEP}>").alias("steps"), "subroot")
    reach = attach_paths(tops, ["name", "digest"], crown, end, f"{purpose}-reach")
    roots = reach.select(F.col("name").alias("tree"), "steps", F.struct(F.col("digest").alias("subroot"), F.col("subroot").alias("root")).alias("ends"))
    return Manifest(leaves, forest, crown, written(roots, f"{purpose}-roots"))


def prove(manifest: Manifest, purpose: str = "proofs") -> DataFrame:
    """Every leaf's row with subroot, root and ``steps``: array of (before, after), the siblings on either side from the leaf up to the root."""
    named = manifest.roots.select("tree", "steps", F.concat_ws(",", "ends.subroot", "ends.root").alias("subroot"))
    columns = [c for c in manifest.leaves.columns if c not in ("tree", "rank")]
    proofs = attach_paths(manifest.leaves, columns, manifest.forest, named, purpose)
    ends = F.split("subroot", ",")
    return proofs.select(*columns, ends[0].alias("subroot"), ends[1].alias("root"), "steps")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` leads to by the proof's ``steps``."""
    return F.aggregate(steps, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def sibling_digest(steps: Column) -> Column:
    """One digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda step: F.concat(step["before"], step["after"])), ""), 256)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def verify_documents(df: DataFrame, tampered: Column, purpose: str = "manifest") -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, and folded_root and verified of a copy whose ``n_chars`` is one more where
    ``tampered`` holds (a null stays)."""
    changed = [F.col("n_chars") + F.when(tampered, 1).otherwise(0) if c == "n_chars" else F.col(c) for c in COLUMNS]
    # Only the tampered rows are hashed a second time.
    manifest = build_manifest(df, COLUMNS, keep={"changed": F.when(tampered, leaf_digest(changed))}, purpose=purpose)
    folded = fold(F.coalesce("changed", "digest"), F.col("steps"))
    proofs = prove(manifest, f"{purpose}-proofs").select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", sibling_digest(F.col("steps")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
