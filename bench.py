"""Times the headline queries and prints one JSON line."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronolode.queries import all_queries
from chronolode.session import local_session

HEADLINE = [
    "pv_statistics",
    "radix_median",
    "table_columns",
    "table_rows",
    "dataset_resolve",
    "dataset_buckets",
    "write_buckets",
    "query_samples",
    "query_pages",
    "pv_metadata",
    "spatial_enrich",
    "archive_json",
    "validate_requests",
    "axis_slice",
    "numeric_cascade",
    "expand_clock",
    "annotations_query",
    "file_order",
    "ingest_ema",
    "column_merge",
    "stream_ingest",
]


def run_once(spark, sf: str, query) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    queries = all_queries()
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    run_once(spark, sf, queries["table_summary"])  # starts the JVM's code paths, not reported
    seconds = {n: round(statistics.median(run_once(spark, sf, queries[n]) for _ in range(runs)), 3) for n in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
