"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Results go to Spark's noop sink, so every row is computed and none is sent to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import local_session  # noqa: E402
from tidemark.workloads import QUERIES  # noqa: E402

HEADLINE = [
    "csv_header_strings",
    "csv_declared_schema",
    "csv_multiline_escape",
    "json_nested_flatten",
    "json_declared_schema",
    "parquet_ingest",
    "excel_sheet",
    "filename_masks",
    "pending_files_multi",
    "dedup_within_file",
    "staging_sink",
    "schema_evolution",
    "publish_snapshot",
    "archive_cycles",
    "hist_latest",
    "hist_append",
    "stg_latest_cycle",
    "conform_union",
    "dq_gate",
    "dq_unique",
    "dq_post_load",
    "incremental_available_now",
    "ingest_end_to_end",
    "process_publish_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session("tidemark-bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
