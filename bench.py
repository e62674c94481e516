"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores.
Every query runs once to warm up and once for the clock, into the noop sink.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from batchlake.catalog.queries import CATALOG
from batchlake.session import build_session

HEADLINE = [
    "S1_read_raw_text",
    "S7_write_layer",
    "C4_parse_timestamps",
    "C7_dedupe",
    "C9_clean",
    "C10_quality_counters",
    "F1_rolling_avg",
    "F2_lag_features",
    "F6_lead_target",
    "F9_build_features",
    "F9_build_features_large_batches",
    "M1_split",
    "M6_r2",
    "R5_rows_per_batch",
    "R7_feature_stats",
    "R10_accuracy_summary",
    "D1_latest_n",
    "D8_error_histogram",
    "D10_monitor_snapshot",
    "M3_train",
]


def run(build, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    timings = {}
    for name in names:
        build = CATALOG[name].build
        run(build, spark, sf_dir)
        timings[name] = run(build, spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
