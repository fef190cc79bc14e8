"""Stored logs and tables, reports at other ticks, and the rules as SQL functions."""

from pyspark.sql import functions as F

from tallyflow import schema
from tallyflow.functions import sqlfn, timing
from tallyflow.functions.timing import report_window
from tallyflow.plans import reports, runs
from tallyflow.registry.base import (
    APP_FROM_SOFT_SQL, APP_METRIC_COLUMNS, EARLIER, LOG_TYPE_SQL, NEWS_URL_SQL, NULL_CHANNEL_SQL, VISITOR_SQL, WINDOW,
    Registry, app_ctes, app_report_sql, app_rows, charset_sql, h5_full_ctes, h5_full_sql, h5_record_sql, max_merge_sql,
    normalise_sql, trim_date_sql, with_views,
)
from tallyflow.registry.reports import _basic_ctes
from tallyflow.sinks import tables
from tallyflow.sources import derived, logs

REGISTRY = Registry()
query = REGISTRY.query
DAYS = ["20240114", "20240115", "20240116"]


# ---- reports at other ticks ---------------------------------------------------------------------

def _h5_at(name: str, tick: str) -> None:
    w = report_window(tick)

    @query(f"h5_full_report_{name}", with_views(h5_full_sql(w), *h5_full_ctes(w)))
    def h5(spark, sf):
        return reports.h5_full_report(
            derived.h5_log(spark, sf), derived.h5_active_log(spark, sf), derived.sdk_list(spark, sf), w)


def _app_at(name: str, tick: str) -> None:
    w = report_window(tick)

    @query(f"app_report_{name}", with_views(app_report_sql(w), *app_ctes(app_rows(w), "rows_app", w.up)))
    def app(spark, sf):
        return reports.app_report(derived.app_log(spark, sf), w)


_h5_at("midnight", "20240116000500")
_h5_at("first_ticks", "20240115001000")
_h5_at("empty_day", "20240117120000")  # one row of zeros
_app_at("midnight", "20240116000500")
_app_at("first_ticks", "20240115001000")


# ---- logs stored by day -------------------------------------------------------------------------

def _stored_log(log, path, columns):
    """The log written to its day folders in two steps, and read by days."""
    early = F.col("dateline") < WINDOW.low + 3600
    tables.append_log_day(log.where(early), path)
    tables.append_log_day(log.where(~early), path)
    return logs.read_log(log.sparkSession, path, columns, DAYS)


@query("log_partition_insert", with_views(
    f"SELECT {', '.join(f.name for f in schema.H5_LOG)} FROM h5_log"))
def log_partition_insert(spark, sf):
    return _stored_log(derived.h5_log(spark, sf), tables.scratch_path(spark, "h5_log"), schema.H5_LOG)


@query("h5_full_report_stored", with_views(h5_full_sql(), *h5_full_ctes()))
def h5_full_report_stored(spark, sf):
    """The full report from logs in day folders."""
    log = _stored_log(derived.h5_log(spark, sf), tables.scratch_path(spark, "h5_log"), schema.H5_LOG)
    active = _stored_log(derived.h5_active_log(spark, sf), tables.scratch_path(spark, "h5_active"), schema.H5_ACTIVE_LOG)
    return reports.h5_full_report(log, active, derived.sdk_list(spark, sf), WINDOW)


@query("scan_current_database", "SELECT r_regionkey, 'default' AS db FROM region")
def scan_current_database(spark, sf):
    logs.use_database(spark, "default")
    return spark.read.parquet(f"{sf}/region.parquet").select("r_regionkey", F.current_database().alias("db"))


# ---- sinks --------------------------------------------------------------------------------------

@query("sink_truncate", with_views(h5_full_sql(), *_basic_ctes()))
def sink_truncate(spark, sf):
    """A slice stored, the table emptied, another slice stored."""
    path, log = tables.scratch_path(spark, "truncated"), derived.basic_log(spark, sf)
    tables.overwrite_slice(reports.h5_basic_report(log, EARLIER), path, tables.H5, EARLIER.dt, EARLIER.up)
    tables.truncate(spark, path, tables.H5)
    tables.append(reports.h5_basic_report(log, WINDOW), path, tables.H5)
    return tables.read_table(spark, path, tables.H5)


@query("sink_strip_quotes", with_views(
    "SELECT replace(qid, chr(39), '') AS qid, count(*) AS pv FROM (SELECT chr(39) || qid || chr(39) || 's' AS qid FROM h5_log) GROUP BY qid"))
def sink_strip_quotes(spark, sf):
    quoted = derived.h5_log(spark, sf).select(F.concat(F.lit("'"), "qid", F.lit("'s")).alias("qid"))
    return tables.strip_quotes(quoted.groupBy("qid").agg(F.count("*").alias("pv")))


@query("sink_total_row", with_views(h5_record_sql("total"), *_basic_ctes()))
def sink_total_row(spark, sf):
    """What ``show_total`` prints."""
    return tables.total_rows(reports.h5_basic_report(derived.basic_log(spark, sf), WINDOW))


_APP_TICKS = """ticks AS (
  SELECT '20240115' AS dt, {low} AS low, {low} + k * 600 AS up FROM (SELECT unnest(range(1, 145)) AS k))""".format(low=WINDOW.low)


def _at_tick(sql: str) -> str:
    """The tick's time takes the place of the fixed one."""
    return sql.replace(f"cast({WINDOW.up} AS bigint)", "cast(up AS bigint)").replace(
        f"make_timestamp({WINDOW.up} * 1000000::bigint)", "make_timestamp(up * 1000000::bigint)").replace(
        f"dateline > {WINDOW.up - 600} AND dateline <= {WINDOW.up}", "dateline > up - 600 AND dateline <= up").replace(
        "SELECT apptypeid,", "SELECT up, apptypeid,").replace("GROUP BY apptypeid", "GROUP BY up, apptypeid")


@query("publish_app_backfill", with_views(
    max_merge_sql("staged", schema.APP_KEYS, APP_METRIC_COLUMNS), _APP_TICKS, app_rows(None, "rows_day"),
    "rows_app AS (SELECT t.up, r.* FROM ticks t JOIN rows_day r ON r.dt = t.dt AND r.dateline >= t.low AND r.dateline <= t.up)",
    *[_at_tick(c) for c in app_ctes("none AS (SELECT 1)", "rows_app")], f"staged AS ({_at_tick(app_report_sql())})"))
def publish_app_backfill(spark, sf):
    """All ticks of a day in place of what was there: a report of that day, and a stale slice of no tick of it."""
    final, log = tables.scratch_path(spark, "app_days"), derived.app_log(spark, sf)
    report = reports.app_report(log, WINDOW)
    tables.append(report.union(report.withColumn("logtime", F.col("logtime") + 1)), final, tables.APP)
    runs.run_app_backfill(log, ["20240115"], final)
    return tables.read_table(spark, final, tables.APP)


# ---- scalars ------------------------------------------------------------------------------------

@query("fn_parse_format", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted, cast(floor(epoch(ts)) AS bigint) AS parsed FROM events""")
def fn_parse_format(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = timing.parse_datetime(text)
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", timing.format_datetime(parsed).alias("formatted"), F.unix_timestamp(parsed).alias("parsed"))


_SQL_FUNCTIONS = {
    "null_text": ("tf_null_text(qid)", "coalesce(qid, 'null')"),
    "special": ("tf_trim_special(concat(qid, '-', chr(39), chr(92)))", "qid || '-'"),
    "trimmed": ("tf_trim_date(qid)", trim_date_sql("qid")),
    "channel": ("tf_normalise_channel(qid)", normalise_sql("qid")),
    "channel_ok": ("tf_channel_ok(qid)", charset_sql("qid")),
    "is_int": ("tf_is_integer(substring(qid, length(qid) - 5))", "regexp_full_match(right(qid, 6), '[-+]?[0-9]*')"),
    "log_type_ok": ("tf_log_type_ok(logtype, urlto)", LOG_TYPE_SQL),
    "null_channel_ok": ("tf_null_channel_ok(qid, apptypeid)", NULL_CHANNEL_SQL),
    "news_ok": ("tf_news_url_ok(urlto)", NEWS_URL_SQL),
    "visitor": ("tf_visitor(qid, uid, clientime)", VISITOR_SQL),
    "tick": ("tf_floor_ten_minutes(dateline)", "(dateline // 600) * 600"),
    "formatted": ("tf_format_time(date_format(timestamp_seconds(dateline), 'yyyyMMddHHmmss'))",
                  "strftime(make_timestamp(dateline * 1000000), '%Y-%m-%d %H:%M:%S')"),
}


@query("sql_functions_h5", with_views(
    f"SELECT {', '.join(f'{sql} AS {name}' for name, (_, sql) in _SQL_FUNCTIONS.items())} FROM h5_log"))
def sql_functions_h5(spark, sf):
    sqlfn.register(spark)
    return derived.h5_log(spark, sf).selectExpr(*[f"{call} AS {name}" for name, (call, _) in _SQL_FUNCTIONS.items()])


@query("sql_functions_app", with_views(f"SELECT softname, softid, {APP_FROM_SOFT_SQL} AS app FROM app_active_log"))
def sql_functions_app(spark, sf):
    sqlfn.register(spark)
    return derived.app_active_log(spark, sf).selectExpr("softname", "softid", "tf_app_from_software(softname, softid) AS app")
