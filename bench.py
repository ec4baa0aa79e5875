"""Benchmark: prints one JSON line.

Runs the warehouse build over $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: the detail and the summaries are written once, then every analysis is timed
over the stored tables and, as ``events.*``, straight from the events table. The value is the
time of the whole build and all analyses over the stored tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from footfall.plans import warehouse as wh  # noqa: E402
from footfall.plans.registered import END, QUERIES, START, raw  # noqa: E402
from footfall.session import scratch_dir, session  # noqa: E402
from footfall.sinks import save  # noqa: E402
from footfall.sources import read_layer  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FROM_EVENTS = (
    "etl_clean_audit",
    "daily_pv_uv",
    "hourly_distribution",
    "behavior_funnel",
    "top_items",
    "top_categories",
    "weekday_vs_weekend",
    "retention",
    "user_rfm",
    "rfm_summary",
    "user_path",
    "heatmap_hour_dow",
    "repurchase_distribution",
    "category_top_items",
    "verify_counts",
)


def timed(f) -> float:
    started = time.perf_counter()
    f()
    return round(time.perf_counter() - started, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        int(CPUS),
        settings={"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, "bench")
    times: dict[str, float] = {}
    run(raw(spark, FOLDER))  # first scan pays for starting the JVM's code paths
    times["load_raw"] = timed(lambda: save(raw(spark, FOLDER), wh.RAW_TABLE, root))
    # the audit is lazy: it counts as a part of the cleaning step
    times["build_detail"] = timed(lambda: run(wh.build_detail(spark, root, START, END, "UTC")))
    times["build_summaries"] = timed(lambda: wh.build_summaries(spark, root))
    for name, report in wh.reports(END).items():

        def build(name=name, report=report):
            save(report.compute(*(read_layer(spark, t, root) for t in report.reads)), name, root)

        times[name.split(".")[1]] = timed(build)
    for name, check in wh.verify(spark, root).items():
        times[f"verify_{name}"] = timed(lambda check=check: run(check))
    total = round(sum(times.values()), 3)
    for name in FROM_EVENTS:
        times[f"events.{name}"] = timed(lambda name=name: run(QUERIES[name](spark, FOLDER)))
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "warehouse build and all analyses",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
