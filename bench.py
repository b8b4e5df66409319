"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once as warm-up and then ``$BENCH_REPEATS`` times; the median counts. Results are
written to Spark's no-op sink, so all columns of all rows are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.spark_queries import QUERIES  # noqa: E402
from skeindex.session import build_session  # noqa: E402

HEADLINE = (
    "bm25_doc_freq", "bm25_encode_docs", "sparse_topk", "dense_topk_dot", "hash_embed",
    "hybrid_rrf", "extract_links", "clean_pages", "chunk_text", "line_offsets",
    "merge_datapoints", "index_upsert", "full_rebuild", "bm25_stats_stemmed",
)


def run_once(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run_once(spark, sf, name)
        seconds[name] = round(statistics.median(run_once(spark, sf, name) for _ in range(repeats)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    report = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
