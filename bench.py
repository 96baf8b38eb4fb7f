"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from gridlake.session import build_session
from workload import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "regional_daily_mean",
    "a1_daily_mean",
    "a9_linear_trend",
    "a11_decompose",
    "a13_previous_temperature",
    "a16_daily_melt",
    "a22_size_summary",
    "i2_upsert_timesteps",
    "j1_merge_cubes",
    "j5_new_files",
    "j7_nearest_pixels",
    "q2_missing_pairs",
    "q4_compare_cubes",
    "s9_partition_overwrite",
    "s13_raster_tiles",
    "s16_granule_links",
    "t10_dedupe_time",
    "w2_lead_index",
)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a20_latest"](spark, SF_DIR).toArrow()  # start-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
            }
        )
    )


if __name__ == "__main__":
    main()
