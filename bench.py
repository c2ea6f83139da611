"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). Every
query runs once to warm up, then twice; the better run counts. All rows are produced; none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from crivo.session import tuned  # noqa: E402

HEADLINE = [
    "clean_table", "locale_parse", "universe_percentiles", "composite_score", "screen_top", "screen_status", "kpis",
    "histogram", "dedupe_first_company", "history_score", "history_portfolio", "upsert_last_wins", "manifest",
    "duplicate_keys", "lag_features", "forward_returns_30", "training_dataset", "asof_price", "compound_index",
    "rebase_from_date", "portfolio_index", "backtest_summary", "model_percentile", "eval_table", "confidence",
    "recurrence", "trends", "payload_explode",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tuned(
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        times[name] = round(min(runs[1:]), 3)
        print(f"{name:24} {times[name]:7.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
