"""Timings of the headline queries: one JSON line.

Every query is run once to warm up and then three times; its figure is the median. Results
go to a sink that drops them, so all rows are computed and none is collected.

    BENCH_SF_DIR  folder of the parquet tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores                    (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

import tsnorm
from tsnorm.queries import QUERIES

HEADLINE = [
    "normalize_wide", "normalize_multi", "normalize_gap_zero", "normalize_filtered", "normalize_default_period",
    "upsample_ffill", "batch_resample", "archive_to_readings", "dedupe_last", "dedupe_row_last", "append_series",
    "archive_merge", "trend_merge", "wide_unpivot", "tag_join", "sample_period", "instrument_summary",
    "resample_mean", "resample_first", "resample_multi", "asof_backward", "locf", "wide_pivot", "parse_ts",
]
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tsnorm.configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    timings = {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 + REPEATS):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        timings[name] = round(statistics.median(runs[1:]), 3)
        print(f"{name}: {timings[name]} s", file=sys.stderr)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "readings_per_sec": {q: round(events / timings[q]) for q in ("normalize_wide", "resample_multi")},
    }))


if __name__ == "__main__":
    main()
