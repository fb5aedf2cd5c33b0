"""Time the headline queries: warm, median of three, every row computed."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from askloom.session import build_session  # noqa: E402
from askloom.workload import QUERIES  # noqa: E402

HEADLINES = [
    "chunk_tokens", "chunk_separator", "index_rows", "embed_chunks",
    "knn_top3", "knn_top10_cells", "ann_top3", "retrieve_columns", "answer_questions",
    "request_log_flat", "assessment_unpack", "assessment_dedup_hour", "dedup_latest_hour",
    "generated_questions", "eval_set", "retrieval_metrics", "judge_score", "evaluate_run",
    "avg_metrics_by_run", "eval_report", "golden_split",
    "snapshot_diff", "sync_index", "sync_index_stream", "dedup_latest_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total of warm medians", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
