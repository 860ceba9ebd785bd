"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the list below)

Every query is run once on the smallest tables first, so that JVM and Python
worker start are not part of the times.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from engrama.plans.catalog import REGISTRY  # noqa: E402
from engrama.session import build_session  # noqa: E402

HEADLINE = [
    "vector_batch_topk", "metric_types", "batch_by_source", "ivf_flat_search", "ivf_sq8_search", "ivf_pq_search",
    "tfidf_weights", "text_search", "rrf_fusion", "structured_evidence", "similarity_search_with_score",
    "fbin_scan", "wal_log_scan", "document_chunk", "batch_split", "vector_batch_accounting", "materialize_memory",
    "upsert_latest", "memory_recall", "memory_compress", "memory_decay", "conflict_resolve", "purge_by_source",
    "proof_trace", "tool_state_pending", "task_tokens", "task_claims", "stream_wal_tail", "stream_task_lifecycle",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{cpus}]", cpus, **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = str(pathlib.Path(sf_dir).parent / "sf0.001")
    times = {}
    for name in names:
        if os.path.isdir(warm_dir):
            run(spark, name, warm_dir)
        times[name] = round(run(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": pathlib.Path(sf_dir).name.removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
