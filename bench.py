"""Headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.options import FileOptions  # noqa: E402
from quayside.plans import sample  # noqa: E402
from quayside.plans.catalog import QUERIES, sealing_chain  # noqa: E402
from quayside.session import local_session, shared_dir  # noqa: E402
from quayside.sources.messages import decode_dynamic  # noqa: E402
from quayside.streaming.landing import land_batch  # noqa: E402

HEADLINE = [
    "landing_chain", "protect_mask", "protect_typed", "protect_by_rules", "protect_by_policy", "fold_wrap", "path_values",
    "encrypt_decision_file", "file_manifest", "report_strategy_counts", "report_matrix", "report_rate", "land_lines",
    "jwe_roundtrip", "stream_lines", "land_sealed_files",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def land_sealed_files(spark, sf_dir):
    """Protect, fold, assign files, seal the chosen ones and write all of them, at the default file size."""
    root = shared_dir(spark, "bench")
    batch = sealing_chain()(decode_dynamic(sample.records(spark, sf_dir)))
    return land_batch(batch, root, f"{root}/_manifest", FileOptions(), sample.policy(spark), sample.key_ring(spark))


def main() -> None:
    queries = QUERIES | {"land_sealed_files": land_sealed_files}
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        # The first run warms the JVM and the Python workers.
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cores": cores, "messages": messages,
        "messages_per_sec": {
            "protect_fold_path": round(messages / seconds["landing_chain"]),
            "with_sealed_files": round(messages / seconds["land_sealed_files"]),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
