"""Time the headline queries and print one JSON line.

``$BENCH_SF_DIR`` names the tables, ``$BENCH_CPUS`` the local cores. Each query runs into a sink that
drops the rows, ``$BENCH_RUNS`` times after a warm-up; the median counts. ``value`` is the sum.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyflow import registry  # noqa: E402
from tallyflow.operators import metrics, rollups  # noqa: E402
from tallyflow.registry.base import WINDOW  # noqa: E402
from tallyflow.sources import derived, logs  # noqa: E402

HEADLINE = [
    "h5_full_report",
    "h5_full_join_chain",
    "h5_basic_report",
    "miniprogram_report",
    "app_report",
    "app_active_report",
    "news_report",
    "sliced_uv_by_qid",
    "sliced_total_uv",
    "h5_backfill",
    "publish_max_merge",
    "rollup_union",
    "agg_salted",
    "topk_channels",
    "word_count",
]


def h5_one_pass(spark, sf):
    """The detail rows of the full report's traffic side as conditional distinct counts."""
    from pyspark.sql import functions as F

    rows = logs.h5_clean(derived.h5_log(spark, sf), WINDOW)
    grouped = rollups.with_rollups(rollups.flag_sdk(rows, derived.sdk_list(spark, sf)))
    return metrics.one_pass_metrics(grouped.withColumn("qid", F.lower("qid")), ["qid"], "uid", "clientip", WINDOW.up)


def seconds(run, spark, sf) -> float:
    start = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # no Python call site per Column: plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = {name: registry.ALL[name].run for name in HEADLINE} | {"h5_full_one_pass": h5_one_pass}
    times = {}
    for name, run in work.items():
        seconds(run, spark, sf)
        times[name] = round(statistics.median(seconds(run, spark, sf) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
