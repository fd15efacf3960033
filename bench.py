"""Times the headline queries on local Spark and prints one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindings.queries import all_queries  # noqa: E402
from lodgemart.session import build_session  # noqa: E402

HEADLINE = (
    "daily_revenue",
    "cancellation_rate",
    "collection_rate",
    "overlap_alerts",
    "customer_value",
    "customer_value_enriched",
    "dq_bookings_full",
    "dq_payments_full",
    "dedup_latest",
    "dedup_any_total_order",
    "sentiment_label",
    "sentiment_score_joined",
    "sentiment_score_spread",
    "top_collection",
    "top_customers",
    "src_csv_typed",
    "ingest_audit",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, spent = all_queries(), {}
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().collect()
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        spent[name] = round(min(times), 3)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two runs each, summed",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
