from __future__ import annotations

from pyspark.sql import functions as F

from quayside.llm import common, ngram_join


def test_links_found_in_waves_are_those_found_at_once(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for group in range(12):
        text = [f"{w}g{group}" for w in words]
        for copy in range(5):
            changed = text[: 58 - copy] + [f"x{group}-{copy}"] + text[59 - copy:]
            rows.append((group * 5 + copy, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "WAVES", 1)
    once = {tuple(r) for r in ngram_join.near_groups(docs).collect()}
    monkeypatch.setattr(ngram_join, "WAVES", 3)
    monkeypatch.setattr(ngram_join, "WAVE_MEMBERS", 2)
    assert {tuple(r) for r in ngram_join.near_groups(docs).collect()} == once
    assert len({r[3] for r in once}) < len(rows)


def test_each_cell_is_whole_in_one_wave(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "WAVE_MEMBERS", 10)
    needed = spark.range(50).select(
        F.col("id").alias("_doc"), F.xxhash64("id").alias("_hash"),
        F.expr("transform(sequence(0L, id % 4), n -> named_struct('cell', (id + n) % 9, 'x', n % 2, 'y', 1L))").alias("cells"))
    flat = [[(r["_doc"], c["cell"], c["x"], c["y"]) for r in part.collect() for c in r["cells"]] for part in ngram_join._waves(needed)]
    assert len(flat) == 4 and sum(1 for f in flat if f) > 1
    cells = [{f[1:] for f in wave} for wave in flat]
    assert sum(map(len, cells)) == len(set().union(*cells))
    whole = [(r["_doc"], c["cell"], c["x"], c["y"]) for r in needed.collect() for c in r["cells"]]
    assert sorted(sum(flat, [])) == sorted(whole)


def test_a_stored_table_leaves_no_setting_behind(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    kept = common.written(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    assert kept.count() == 7 and spark.conf.get(setting) == before
