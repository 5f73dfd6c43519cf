"""Whitening, mixing and manifests on small tables: against plain loops, and the defined cases."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from compare import duck
from pyspark.sql import functions as F

from quayside.llm import common, manifest, mixing, queries, whitening
from quayside.llm.common import ordered, ranked, written

# --- order -----------------------------------------------------------------------------------------------------------


def test_ranks_over_many_ranges(spark):
    rows = [("hot" if i % 3 else "cold", i * 7919 % 100) for i in range(500)]
    table = written(spark.createDataFrame(rows, "g string, v int").repartition(5), "t")
    got = ranked(ordered(table, ["g", "v"], "o", rows=40), "g").select("g", "v", "_rank").collect()
    for group in ("hot", "cold"):
        mine = sorted((r["_rank"], r["v"]) for r in got if r["g"] == group)
        assert [v for _, v in mine] == sorted(v for g, v in rows if g == group)
        assert [n for n, _ in mine] == list(range(len(mine)))


# --- whitening -------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, whitened string, x int, index string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "own", 3, "own") for i, v in rows], VECTORS)


def usable(rows):
    return [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]


def check_whitening(got, rows, components=16):
    mine = usable(rows)
    fit = np.unique(np.array([x for _, x in mine]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centre = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centre.T @ centre / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, len(values))
    expected = defaultdict(list)
    for i, x in mine:
        expected[i].append((int(((n * x - sums) ** 2).sum()), (n * x - sums) / n @ axes[:, :kept] / np.sqrt(values[:kept])))
    found = defaultdict(list)
    for r in got:
        found[r["vec_id"], r["component"]].append(r)
    assert {k: len(v) for k, v in found.items()} == {(i, c): len(v) for i, v in expected.items() for c in range(1, kept + 1)}
    signs = np.ones(kept)
    for c in range(kept):
        rows_c = [(found[i, c + 1][0], v[0][1][c]) for i, v in expected.items()]
        signs[c] = np.sign(sum(r["whitened"] * e for r, e in rows_c))
    for (i, c), rs in found.items():
        assert {r["deviation"] for r in rs} == {d for d, _ in expected[i]} and {r["n"] for r in rs} == {n}
        for r in rs:
            assert r["whitened"] == pytest.approx(signs[c - 1] * expected[i][0][1][c - 1], abs=1e-8)
            assert r["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    assert {r["identity_error"] < 1e-9 for r in got} == {True}


def test_whitening_of_the_whole_table(spark, sf_dir):
    stored = duck(sf_dir).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    check_whitening(queries.op11_embedding_whitening(spark, sf_dir).collect(), stored)


def test_whitening_cases(spark, monkeypatch):
    """Copies, unusable vectors, null ids, one row per block and several bands, one of them without a row."""
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 2)
    monkeypatch.setattr(whitening.whiten, "__defaults__", ("vec_id", "embedding", 16, 64, 1_000_000, 16))
    draw = np.random.default_rng(5)
    plain = [(i, draw.normal(size=4).astype(np.float32).tolist()) for i in range(30)]
    rows = plain + [(100 + i, plain[0][1]) for i in range(40)] + [(None, plain[1][1])]
    rows += [(201, None), (202, []), (203, [1.0, None, 0.0, 0.0]), (204, [1.0, float("nan"), 0.0, 0.0]), (205, [float("-inf"), 0.0, 0.0, 0.0])]
    check_whitening(whitening.whitened_components(vectors(spark, rows + [(206, [1.0, 2.0])]).coalesce(1)).collect(), rows)


def test_whitening_without_variance(spark):
    rows = [(1, [1.0, 2.0, 0.5]), (2, [1.0, 2.0, 0.5]), (3, [3.0, 2.0, 0.5])]
    got = whitening.whitened_components(vectors(spark, rows)).collect()
    assert len(got) == 9 and {r["n"] for r in got} == {2}
    assert {(r["component"], round(abs(r["whitened"]), 9)) for r in got} == {(1, 1.0), (2, 0.0), (3, 0.0)}
    assert {r["explained"] for r in got if r["component"] == 1} == {1.0}
    one = whitening.whitened_components(vectors(spark, rows[:1])).collect()
    assert {(r["whitened"], r["deviation"], r["identity_error"]) for r in one} == {(0.0, 0, 0.0)}


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None), (2, [])]):
        got = whitening.whitened_components(vectors(spark, rows))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0


def test_far_entries(spark):
    """Entries far beyond the grid stop there, and a deviation that is no long is null."""
    got = whitening.whitened_components(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5])])).collect()
    assert len(got) == 6 and {r["deviation"] is None for r in got if r["vec_id"] == 1} == {True}


# --- mixing ----------------------------------------------------------------------------------------------------------

MIXED = "doc_id long, text string, lang string, source string, n_chars long, taken string, size string, target int"


def mixed_table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "own", "own", 7) for i, t, s in rows], MIXED)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, source string")


def fair_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, sharing the excess of capped sources again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in names}
        capped |= over


def check_mix(got, rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    wanted = fair_targets(sizes)
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        whole = int(wanted[r["source"]] // sizes[r["source"]]) if sizes[r["source"]] else 0
        assert whole * r["size"] <= r["taken"] <= min(3, whole + 1) * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - wanted[source]) <= 1


@pytest.mark.parametrize("seed", range(3))
def test_mixing_equals_a_loop(spark, monkeypatch, seed):
    monkeypatch.setattr(common, "ORDERED_ROWS", 50)
    draw = np.random.default_rng(seed)
    names = ["web", "Web", "code", "böok", None, "", "-"]
    rows = [(i, "w " * int(draw.integers(0, 40)), names[min(int(draw.geometric(0.4)) - 1, 6)]) for i in range(400)]
    got = mixing.mix_documents(mixed_table(spark, rows), labels(spark, [(i, i % 2, 0, "own") for i in range(0, 400, 3)]))
    check_mix(got.collect(), rows)
    turned = mixed_table(spark, rows[::-1]).repartition(7)
    again = mixing.mix_documents(turned, labels(spark, [(i, i % 2, 0, "own") for i in range(0, 400, 3)]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_mixing_cases(spark):
    long_text = "word " * 60_000
    rows = [(1, long_text, "a"), (1, "two words", "a"), (1, "two words", "a"), (None, "x", "b"), (2, None, "b"), (3, "", None), (4, " \t", "c"), (5, "one", "d")]
    check_mix(mixing.mix_documents(mixed_table(spark, rows), labels(spark)).collect(), rows)
    assert mixing.mix_documents(mixed_table(spark, []), labels(spark)).count() == 0
    nothing = mixing.mix_documents(mixed_table(spark, [(1, "", "a"), (2, None, None)]), labels(spark)).collect()
    assert {(r["target"], r["taken"]) for r in nothing} == {(0.0, 0)}


def test_better_documents_come_first(spark):
    """Of equal documents those of four times the weight are selected about as often as exponential keys say."""
    rows = [(i, "w", "a") for i in range(2000)] + [(i, "w", "b") for i in range(2000, 2200)]
    got = mixing.mix_documents(mixed_table(spark, rows), labels(spark, [(i, i % 2, 0, None) for i in range(2000)])).where("source = 'b'").collect()
    assert {r["taken"] for r in got} == {3}
    sizes = {"a": 2000, "b": 200}
    assert fair_targets(sizes, (5, 2)) == {"a": 1600.0, "b": 600.0}
    kept = mixing.mix(mixed_table(spark, rows).withColumn("w", F.lit(1)), F.col("w"), F.when(F.col("doc_id") % 2 == 1, 1.0).otherwise(0.25), weights=(5, 2))
    part = kept.where("source = 'a' AND taken > 0").agg(F.avg(F.col("doc_id") % 2)).first()[0]
    # 1600 of 2000: u solves (1 - exp(-u)) + (1 - exp(-u / 4)) = 1.6, so about 0.97 of the good and 0.63 of the others.
    assert 0.57 < part < 0.65


def test_words_are_runs_without_blanks(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc\x0c\r\nd ", "a b  c", "\x1c \x85"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t")).alias("n"))
    assert [r["n"] for r in frame.collect()] == [len((t or "").encode().split()) for t in texts]


# --- manifest --------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, steps int, tree string"


def docs_table(spark, rows):
    return spark.createDataFrame([(*r, "own", 7, "own") for r in rows], DOCS)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return digest("".join(map(field, (doc_id, source, lang, None if n_chars is None else n_chars + more, text))))


def plain_tree(nodes, arity):
    """The root, and for each leaf the runs around it from the leaf up."""
    steps, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(at, min(at + arity, len(nodes))) for at in range(0, len(nodes), arity)]
        for run in runs:
            for i in run:
                for leaf in below[i]:
                    steps[leaf].append(("".join(nodes[j] for j in run if j < i), "".join(nodes[j] for j in run if j > i)))
        below = [[leaf for i in run for leaf in below[i]] for run in runs]
        nodes = [digest("".join(nodes[i] for i in run)) for run in runs]
    return nodes[0], steps


def plain_manifest(rows, arity=2, tampered=lambda doc_id: False):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    trees = []
    for lang in sorted(by_lang, key=lambda v: (v is not None, (v or "").encode())):
        mine = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append((mine, *plain_tree([plain_leaf(r) for r in mine], arity)))
    root, above = plain_tree([t[1] for t in trees], arity)
    out = []
    for (mine, subroot, steps), rest in zip(trees, above, strict=True):
        for row, path in zip(mine, steps, strict=True):
            folded = plain_leaf(row, 1 if tampered(row[0]) else 0)
            for before, after in path + rest:
                folded = digest(before + folded + after)
            siblings = digest("".join(b + a for b, a in path + rest))
            out.append((row[0], plain_leaf(row), subroot, root, siblings, folded, folded == root))
    return sorted(out, key=repr)


def some_rows(count, langs, seed=0):
    draw = np.random.default_rng(seed)
    return [(int(draw.integers(0, 3 * count)), f"text {i} ü", langs[min(int(draw.geometric(0.5)) - 1, len(langs) - 1)], "s", i if i % 5 else None) for i in range(count)]


@pytest.mark.parametrize("rows", [
    some_rows(300, ["en", None, "de", "", "-", "zh"]),
    some_rows(64, ["en"]), some_rows(65, ["en"]), [(1, None, None, None, None)],
    [(None, "", "en", "", 0), (None, None, "en", None, None), (7, "x" * 300_000, "en", "s", 1), (7, "x" * 300_000, "en", "s", 1), (7, "", "en", "s", 1)],
    [(i, "t", f"l{i}", "s", 1) for i in range(21)],
])
def test_manifest_equals_a_loop(spark, monkeypatch, rows):
    """Small buckets, so that trees have several bands, whole, full and partly filled ones."""
    monkeypatch.setattr(manifest, "LEVELS", 3)
    table = docs_table(spark, rows).repartition(4)
    monkeypatch.setattr(manifest.build_manifest, "__defaults__", ("lang", "doc_id", None, 2, 3, "manifest"))
    got = manifest.verify_documents(table, F.col("doc_id") % 7 == 0)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows, tampered=lambda i: i is not None and i % 7 == 0)


def test_manifest_of_wider_runs(spark):
    rows = some_rows(100, ["en", "de"])
    made = manifest.build_manifest(docs_table(spark, rows), manifest.COLUMNS, arity=3, levels=2)
    proofs = manifest.prove(made).withColumn("folded", manifest.fold(F.col("digest"), F.col("steps")))
    got = [(r["key"], r["digest"], r["subroot"], r["root"], digest("".join(s["before"] + s["after"] for s in r["steps"])), r["folded"], True) for r in proofs.collect()]
    assert sorted(got, key=repr) == plain_manifest(rows, 3)
    assert made.root() == got[0][3]


def test_nodes_are_nested_intervals(spark):
    made = manifest.build_manifest(docs_table(spark, some_rows(50, ["en"])), manifest.COLUMNS, levels=2)
    nodes = [(b, r["level"], r["lo"], r["hi"]) for b, band in enumerate(made.forest.bands) for r in band.collect()]
    for a in nodes:
        for b in nodes:
            assert a[3] <= b[2] or b[3] <= a[2] or (a[2] <= b[2] and b[3] <= a[3]) or (b[2] <= a[2] and a[3] <= b[3])
    for band in range(len(made.forest.bands)):
        bottom = sorted((lo, hi) for b, level, lo, hi in nodes if b == band and level == 0)
        assert bottom[0][0] == 0 and bottom[-1][1] == 50 and all(x[1] == y[0] for x, y in zip(bottom, bottom[1:], strict=False))


def test_manifest_of_nothing(spark):
    empty = docs_table(spark, [])
    assert manifest.verify_documents(empty, F.lit(False)).count() == 0
    assert manifest.build_manifest(empty, manifest.COLUMNS).root() is None


def test_a_changed_row_changes_the_root(spark):
    rows = some_rows(40, ["en", "de"])
    roots = {manifest.build_manifest(docs_table(spark, table), manifest.COLUMNS).root()
             for table in (rows, rows[::-1], [(rows[0][0], rows[0][1] + "!", *rows[0][2:])] + rows[1:], rows[1:])}
    assert len(roots) == 3
