from __future__ import annotations

from pyspark.sql import functions as F

from quayside.plans import sample
from quayside.sources.messages import decode_dynamic


def test_tasks_of_costly_work_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(sample, "TASK_ROWS", 1_000)
    wide = spark.range(0, 25_500, 1, spark.sparkContext.defaultParallelism + 1)
    dealt = sample.spread(wide)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 26 and max(r["count"] for r in sizes) <= 1_100
    assert dealt.agg(F.sum("id"), F.count("*")).first()[:] == (25_500 * 25_499 // 2, 25_500)
    fine = spark.range(0, 1_000, 1, 40)
    assert sample.spread(fine).rdd.getNumPartitions() == 40


def test_decoding_keeps_methods_short_enough_to_be_compiled(spark, messages):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    decode_dynamic(messages(({}, '{"a":1}')))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
