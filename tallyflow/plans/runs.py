"""A report run as a user schedules it: compute, stage, publish."""

from pyspark.sql import DataFrame, SparkSession

from tallyflow.functions.timing import ReportWindow
from tallyflow.plans import backfill, carried, reports
from tallyflow.sinks import tables
from tallyflow.sinks.tables import APP, H5, MetricsTable


def _replace(
    spark: SparkSession, report: DataFrame, table: MetricsTable, window: ReportWindow, staging: str, final: str
) -> int:
    tables.overwrite_slice(report, staging, table, window.dt, window.up)
    return tables.publish(spark, staging, final, table, window.dt, window.up)


def run_h5_basic(spark: SparkSession, log: DataFrame, window: ReportWindow, staging: str, final: str) -> int:
    return _replace(spark, reports.h5_basic_report(log, window), H5, window, staging, final)


def run_h5_full(
    spark: SparkSession, log: DataFrame, active_log: DataFrame, sdk: DataFrame, window: ReportWindow, staging: str, final: str
) -> int:
    return _replace(spark, reports.h5_full_report(log, active_log, sdk, window), H5, window, staging, final)


def run_h5_full_carried(
    spark: SparkSession, name: str, log: DataFrame, active_log: DataFrame, sdk: DataFrame, window: ReportWindow, staging: str, final: str
) -> int:
    """As ``run_h5_full``, counted on from the last tick; the day's state is in tables of the given name."""
    state = carried.DaySoFar(spark, name)
    state.create()
    return _replace(spark, carried.h5_full_report(state, log, active_log, sdk, window), H5, window, staging, final)


def run_app_carried(spark: SparkSession, name: str, log: DataFrame, window: ReportWindow, staging: str, final: str) -> int:
    state = carried.DaySoFar(spark, name, carried.APP_KEYS)
    state.create()
    return _replace(spark, carried.app_report(state, log, window), APP, window, staging, final)


def run_sliced_day(log: DataFrame, window: ReportWindow, out: str) -> int:
    """Visitors over the complete slices of the day, in a folder of the day and tick, in place of what is there."""
    report = reports.sliced_day_report(log, window.dt, window.low, window.up)
    path = f"{out}/dt={window.dt}/now={window.up}"
    report.write.mode("overwrite").parquet(path)
    return report.sparkSession.read.schema(report.schema).parquet(path).count()


def run_mini_program(
    spark: SparkSession, log: DataFrame, active_log: DataFrame, window: ReportWindow, staging: str, final: str
) -> int:
    """Adds to the staged slice, then publishes it again."""
    tables.append(reports.mini_program_report(log, active_log, window), staging, H5)
    return tables.publish(spark, staging, final, H5, window.dt, window.up)


def run_older_loader(report: DataFrame, final: str, window: ReportWindow) -> int:
    """A report straight into its slice of the final table, in place of what is there, with quotes stripped from channels."""
    return tables.overwrite_slice(tables.strip_quotes(report), final, H5, window.dt, window.up)


def run_app(spark: SparkSession, log: DataFrame, window: ReportWindow, staging: str, final: str) -> int:
    return _replace(spark, reports.app_report(log, window), APP, window, staging, final)


def run_app_active(spark: SparkSession, active_log: DataFrame, window: ReportWindow, staging: str, final: str) -> int:
    return _replace(spark, reports.app_active_report(active_log, window), APP, window, staging, final)


def run_app_with_activity(
    spark: SparkSession, log: DataFrame, active_log: DataFrame, window: ReportWindow, staging: str, final: str,
    active_staging: str, active_final: str,
) -> tuple[int, int]:
    """The app report, then the app activity report, each into tables of its own."""
    traffic = run_app(spark, log, window, staging, final)
    return traffic, run_app_active(spark, active_log, window, active_staging, active_final)


def run_news(spark: SparkSession, log: DataFrame, window: ReportWindow, staging: str, final: str) -> int:
    return _replace(spark, reports.news_report(log, window), APP, window, staging, final)


def run_h5_full_backfill(log: DataFrame, active_log: DataFrame, sdk: DataFrame, days: list[str], final: str) -> int:
    """Publish every tick of whole days. Each tick has its total row, so every slice is replaced."""
    merged = tables.max_merge(backfill.h5_full_backfill(log, active_log, sdk, days), H5)
    return tables.overwrite_slices(tables.rebalanced(merged, H5), final, H5)


def _publish_days(records: DataFrame, table: MetricsTable, days: list[str], final: str) -> int:
    return tables.overwrite_days(tables.max_merge(records, table), final, table, days)


def run_h5_basic_backfill(log: DataFrame, days: list[str], final: str) -> int:
    """Publish every tick of whole days; like the next three, this empties the days' slices that have no rows."""
    return _publish_days(backfill.h5_basic_backfill(log, days), H5, days, final)


def run_app_backfill(log: DataFrame, days: list[str], final: str) -> int:
    return _publish_days(backfill.app_backfill(log, days), APP, days, final)


def run_news_backfill(log: DataFrame, days: list[str], final: str) -> int:
    return _publish_days(backfill.news_backfill(log, days), APP, days, final)


def run_app_active_backfill(active_log: DataFrame, days: list[str], final: str) -> int:
    return _publish_days(backfill.app_active_backfill(active_log, days), APP, days, final)
