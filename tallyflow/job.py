"""One report run, as a scheduler starts it: ``spark-submit .../job.py REPORT TICK --log ... --out ...``.

Logs and the channel list are table names, or paths with a slash; of a path, only the folder of the run's day is
listed. ``--out`` is a folder or a database, in which a report has its staging and its final table; the
mini-program report adds to those of ``h5``. A run that fails ends with a non-zero exit and leaves the final slice
as it was; a run that is repeated changes nothing.

``--days`` publishes all ticks of whole days in one run, in place of what is there; the tick is not used then.
``sliced-day`` stores the visitors summed over the day's complete slices, ``sliced_day/dt=.../now=...`` below a folder.
``--carried NAME`` (h5, app) counts on from the last tick, with the day's state in the tables NAME_members and NAME_counts.
"""

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

if __package__ in (None, ""):  # started as a file
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyflow import schema
from tallyflow.functions.timing import session_report_window
from tallyflow.plans import runs
from tallyflow.sinks import tables
from tallyflow.sinks.tables import MetricsTable
from tallyflow.sources import dims, logs

#: report: schemas of its log and of its activity log
INPUTS = {
    "sliced-day": (schema.BASIC_LOG, None),
    "h5-basic": (schema.BASIC_LOG, None),
    "h5": (schema.H5_LOG, schema.H5_ACTIVE_LOG),
    "mini-program": (schema.H5_LOG, schema.H5_ACTIVE_LOG),
    "app": (schema.APP_LOG, schema.APP_ACTIVE_LOG),
    "news": (schema.APP_LOG, None),
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyflow", description="Compute, stage and publish one report.")
    parser.add_argument("report", choices=INPUTS)
    parser.add_argument("tick", help="yyyyMMddHHmmss, wall clock of the session time zone")
    parser.add_argument("--log", required=True)
    parser.add_argument("--active", help="activity log (h5, mini-program, app)")
    parser.add_argument("--sdk", help="channel list (h5)")
    parser.add_argument("--out", required=True, help="folder or database of the metrics tables")
    parser.add_argument("--days", nargs="+", metavar="yyyyMMdd", help="all ticks of these days (h5-basic, h5, app, news)")
    parser.add_argument("--carried", metavar="NAME", help="tables of the day so far (h5, app)")
    args = parser.parse_args(argv)
    if args.days and args.report in ("sliced-day", "mini-program"):
        parser.error(f"{args.report} has no --days")
    if args.carried and (args.days or args.report not in ("h5", "app")):
        parser.error("--carried is for one tick of h5 or app")
    if args.report == "sliced-day" and not tables.is_path(args.out):
        parser.error("sliced-day needs a folder")
    if INPUTS[args.report][1] and not args.active:
        parser.error(f"{args.report} needs --active")
    if args.report == "h5" and not args.sdk:
        parser.error("h5 needs --sdk")
    return args


def _list(spark: SparkSession, name: str) -> DataFrame:
    return dims.channel_list(spark.read.parquet(name) if "/" in name else spark.table(name))


def _outputs(spark: SparkSession, out: str, name: str, table: MetricsTable) -> tuple[str, str]:
    """Staging and final table of a report: folders, or tables that are made where they are not there."""
    names = [f"{out}{'/' if tables.is_path(out) else '.'}{name}{end}" for end in ("_staging", "")]
    for n in names:
        if not tables.is_path(n):
            tables.create(spark, n, table)
    return names[0], names[1]


def _backfill(args: argparse.Namespace, spark: SparkSession, log: DataFrame, active: DataFrame | None, final: str, active_final: str) -> int | tuple[int, int]:
    if args.report == "h5-basic":
        return runs.run_h5_basic_backfill(log, args.days, final)
    if args.report == "h5":
        return runs.run_h5_full_backfill(log, active, _list(spark, args.sdk), args.days, final)
    if args.report == "news":
        return runs.run_news_backfill(log, args.days, final)
    return runs.run_app_backfill(log, args.days, final), runs.run_app_active_backfill(active, args.days, active_final)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int | tuple[int, int]:
    """Runs the report; gives the number of rows published, of both tables for ``app``."""
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName(f"tallyflow {args.report} {args.tick}").getOrCreate()
    window = session_report_window(spark, args.tick)
    columns, active_columns = INPUTS[args.report]
    days = args.days or [window.dt]
    log = logs.read_log(spark, args.log, columns, days)
    active = logs.read_log(spark, args.active, active_columns, days) if active_columns else None
    if args.report == "sliced-day":
        return runs.run_sliced_day(log, window, f"{args.out}/sliced_day")
    name = {"mini-program": "h5"}.get(args.report, args.report)
    table = tables.APP if args.report in ("app", "news") else tables.H5
    staging, final = _outputs(spark, args.out, name, table)
    active_staging, active_final = _outputs(spark, args.out, "app_active", tables.APP) if args.report == "app" else ("", "")
    if args.days:
        return _backfill(args, spark, log, active, final, active_final)
    if args.report == "h5-basic":
        return runs.run_h5_basic(spark, log, window, staging, final)
    if args.report == "h5" and args.carried:
        return runs.run_h5_full_carried(spark, args.carried, log, active, _list(spark, args.sdk), window, staging, final)
    if args.report == "h5":
        return runs.run_h5_full(spark, log, active, _list(spark, args.sdk), window, staging, final)
    if args.report == "mini-program":
        return runs.run_mini_program(spark, log, active, window, staging, final)
    if args.report == "news":
        return runs.run_news(spark, log, window, staging, final)
    if args.carried:
        traffic = runs.run_app_carried(spark, args.carried, log, window, staging, final)
        return traffic, runs.run_app_active(spark, active, window, active_staging, active_final)
    return runs.run_app_with_activity(spark, log, active, window, staging, final, active_staging, active_final)


if __name__ == "__main__":
    print(f"published rows: {main()}")
