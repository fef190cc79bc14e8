"""Time the reports on a larger log with one hot channel, and show how even the tasks are.

    python tools/scale_check.py [copies] [query ...]

Copies the sf0.1 events ``copies`` times (new visitors in each copy), moves a third of all rows to
one channel, and stores the logs partitioned by day in a fresh temporary folder. Each line has the
seconds of a warm run and, for the stages that took longest, the slowest task against the median.
"""

import json
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyflow import schema  # noqa: E402
from tallyflow.functions.timing import report_window  # noqa: E402
from tallyflow.operators import metrics, rollups  # noqa: E402
from tallyflow.plans import backfill, reports  # noqa: E402
from tallyflow.sinks import tables  # noqa: E402
from tallyflow.sources import derived, logs  # noqa: E402

EVENTS = "/root/testdata/sf0.1/events.parquet"
WHOLE_DAY = report_window("20240116000500")


def build(spark: SparkSession, base: str, copies: int) -> None:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    many = spark.read.parquet(EVENTS).repartition(24).withColumn("copy", copy).select(
        (F.col("event_id") + F.col("copy") * 100_000).alias("event_id"), "ts",
        (F.col("user_id") + F.col("copy") * 1_500).alias("user_id"), "event_type", "value", "props",
    )
    many.write.parquet(f"{base}/events.parquet")
    hot = F.when(F.pmod(F.xxhash64("dateline", "clientip", "clientime"), F.lit(3)) == 0, "click_1")
    for name, channel in (("h5_log", "qid"), ("h5_active_log", "qid"), ("app_log", "appqid")):
        log = getattr(derived, name)(spark, base)
        if name != "h5_active_log":
            log = log.withColumn(channel, F.coalesce(hot, channel))
        tables.append_log_day(log, f"{base}/{name}")


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 300
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    event_log = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "14g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", event_log)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    build(spark, base, copies)
    h5 = logs.read_log(spark, f"{base}/h5_log", schema.H5_LOG)
    active = logs.read_log(spark, f"{base}/h5_active_log", schema.H5_ACTIVE_LOG)
    app = logs.read_log(spark, f"{base}/app_log", schema.APP_LOG)
    sdk = derived.sdk_list(spark, "/root/testdata/sf0.1")
    w = WHOLE_DAY

    def one_pass():
        rows = rollups.with_rollups(rollups.flag_sdk(logs.h5_clean(h5, w), sdk)).withColumn("qid", F.lower("qid"))
        return metrics.one_pass_metrics(rows, ["qid"], "uid", "clientip", w.up)

    work = {
        "h5_full_report": lambda: reports.h5_full_report(h5, active, sdk, w),
        "h5_full_one_pass_detail_only": one_pass,
        "h5_full_join_chain": lambda: reports.h5_full_joined(h5, active, sdk, w),
        "h5_basic_report": lambda: reports.h5_basic_report(h5, w),
        "app_report": lambda: reports.app_report(app, w),
        "news_report": lambda: reports.news_report(app, w),
        "h5_backfill_144_ticks": lambda: backfill.h5_full_backfill(h5, active, sdk, [w.dt]),
        "flag_sdk_broadcast": lambda: rollups.flag_sdk(logs.h5_clean(h5, w), sdk),
        "flag_sdk_salted": lambda: rollups.flag_sdk(logs.h5_clean(h5, w), sdk, list_rows=0, matched_rows=0),
    }
    chosen = sys.argv[2:] or list(work)
    print(json.dumps({"rows": h5.where(F.col("dt") == w.dt).count(), "folder": base}), flush=True)
    marks = []
    for name in chosen:
        for _ in range(2):
            start = time.time()
            work[name]().write.format("noop").mode("overwrite").save()
        marks.append((start, time.time(), name))
    spark.stop()

    stages: dict[int, list[dict]] = {}
    starts: dict[int, float] = {}
    for path in Path(event_log).rglob("*"):
        for line in path.read_text().splitlines() if path.is_file() else []:
            if not line.startswith("{"):
                continue
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                stages.setdefault(event["Stage ID"], []).append(event.get("Task Metrics") or {})
            elif event["Event"] == "SparkListenerStageCompleted":
                starts[event["Stage Info"]["Stage ID"]] = event["Stage Info"]["Submission Time"] / 1000
    for start, end, name in marks:
        mine = [s for i, s in stages.items() if start <= starts.get(i, 0) <= end]
        mine = sorted(mine, key=lambda s: -sum(m.get("Executor Run Time", 0) for m in s))[:3]
        shape = []
        for tasks in mine:
            times = sorted(m.get("Executor Run Time", 0) for m in tasks)
            shape.append({
                "tasks": len(times), "median_ms": times[len(times) // 2], "max_ms": times[-1],
                "spill_mb": round(sum(m.get("Disk Bytes Spilled", 0) for m in tasks) / 1e6, 1),
                "shuffle_mb": round(sum(m["Shuffle Write Metrics"]["Shuffle Bytes Written"] for m in tasks) / 1e6, 1),
            })
        print(json.dumps({"query": name, "sec": round(end - start, 1), "stages": shape}))


if __name__ == "__main__":
    main()
