"""The reports, their totals, the backfill and the sinks."""

from pyspark.sql import functions as F

from tallyflow import schema
from tallyflow.functions import clean
from tallyflow.plans import backfill, reports, runs
from tallyflow.registry.base import (
    APP_METRIC_COLUMNS, EARLIER, H5_METRIC_COLUMNS, WINDOW, Registry, active_rows, active_sql, app_active_rows,
    app_ctes, app_keys, app_record_sql, app_report_sql, app_rows, basic_rows, distinct_sql, h5_full_ctes,
    h5_full_sql, h5_record_sql, h5_rows, in_window_sql, max_merge_sql, metrics_sql, news_rows, recent_sql, rollup_rows,
    with_views,
)
from tallyflow.sinks import tables
from tallyflow.sources import derived

REGISTRY = Registry()
query = REGISTRY.query
DAYS = ["20240114", "20240115", "20240116"]


def _h5_inputs(spark, sf):
    return derived.h5_log(spark, sf), derived.h5_active_log(spark, sf), derived.sdk_list(spark, sf)


# ---- H5 -------------------------------------------------------------------------------------

def _basic_ctes(w=WINDOW, tag=""):
    rows = f"rows_basic{tag}"
    return [
        basic_rows(w, rows),
        f"detail{tag} AS (SELECT qid, {metrics_sql('uid', 'ip', w.up)}, 0 AS activecnt, 0 AS incr_activecnt FROM {rows} GROUP BY qid)",
        f"total{tag} AS (SELECT 'total' AS qid, {metrics_sql('uid', 'ip', w.up)}, 0 AS activecnt, 0 AS incr_activecnt FROM {rows})",
    ]


@query("h5_basic_report", with_views(h5_full_sql(), *_basic_ctes()))
def h5_basic_report(spark, sf):
    return reports.h5_basic_report(derived.basic_log(spark, sf), WINDOW)


@query("h5_join_chain", with_views(h5_record_sql("detail"), *_basic_ctes()))
def h5_join_chain(spark, sf):
    return reports.h5_basic_joined(derived.basic_log(spark, sf), WINDOW)


@query("h5_full_report", with_views(h5_full_sql(), *h5_full_ctes()))
def h5_full_report(spark, sf):
    return reports.h5_full_report(*_h5_inputs(spark, sf), WINDOW)


@query("h5_full_join_chain", with_views(h5_record_sql("detail"), *h5_full_ctes()))
def h5_full_join_chain(spark, sf):
    return reports.h5_full_joined(*_h5_inputs(spark, sf), WINDOW)


@query("h5_total_row", with_views(h5_record_sql("total"), *h5_full_ctes()))
def h5_total_row(spark, sf):
    return reports.h5_full_report(*_h5_inputs(spark, sf), WINDOW).where(F.col("qid") == clean.TOTAL)


_MINI = "qid IN ('sharexcx', 'xiaochengxu_dftt')"
_MINI_CTES = [
    h5_rows(), active_rows(),
    f"""mini AS (
  SELECT '小程序汇总' AS qid, t.*, a.*
  FROM (SELECT {metrics_sql('uid', 'clientip')} FROM rows_h5 WHERE {_MINI} HAVING count(*) > 0) t,
       (SELECT {active_sql()} FROM rows_active WHERE {_MINI}) a)""",
]


@query("miniprogram_report", with_views(h5_record_sql("mini"), *_MINI_CTES))
def miniprogram_report(spark, sf):
    log, active, _ = _h5_inputs(spark, sf)
    return reports.mini_program_report(log, active, WINDOW)


# ---- app ------------------------------------------------------------------------------------

@query("app_report", with_views(app_report_sql(), *app_ctes(app_rows(), "rows_app")))
def app_report(spark, sf):
    return reports.app_report(derived.app_log(spark, sf), WINDOW)


@query("app_total_rows", with_views(
    app_record_sql("total", "left(apptypeid, 50)"), *app_ctes(app_rows(), "rows_app")))
def app_total_rows(spark, sf):
    report = reports.app_report(derived.app_log(spark, sf), WINDOW)
    return report.where(F.col("qid") == clean.TOTAL)


@query("news_report", with_views(app_report_sql(), *app_ctes(news_rows(), "rows_news")))
def news_report(spark, sf):
    return reports.news_report(derived.app_log(spark, sf), WINDOW)


_ACTIVE_METRICS = (
    f"0 AS pv, {distinct_sql('uid')} AS uv, 0 AS ip, 0 AS incr_pv, "
    f"{distinct_sql('uid', recent_sql())} AS incr_uv, 0 AS incr_ip"
)


@query("app_active_report", with_views(
    f"{app_record_sql('detail', 'left(apptypeid, 20)')} UNION ALL {app_record_sql('total', 'left(apptypeid, 20)')}",
    app_active_rows(), app_keys("rows_app_active", "keyed"),
    f"detail AS (SELECT apptypeid, qid, {_ACTIVE_METRICS} FROM keyed GROUP BY apptypeid, qid)",
    f"total AS (SELECT apptypeid, 'total' AS qid, {_ACTIVE_METRICS} FROM keyed GROUP BY apptypeid)"))
def app_active_report(spark, sf):
    return reports.app_active_report(derived.app_active_log(spark, sf), WINDOW)


# ---- every tick of three days -----------------------------------------------------------------

def _at_ticks(metrics: str) -> str:
    """Metrics of the day so far at each tick; the tick's time takes the place of the fixed one."""
    return metrics.replace(f"dateline > {WINDOW.up - 600} AND dateline <= {WINDOW.up}", "dateline > up - 600 AND dateline <= up")


_TICKS = f"""ticks AS (
  SELECT cast(20240114 + d AS varchar) AS dt, {derived.FIRST_MIDNIGHT} + d * 86400 AS low,
    {derived.FIRST_MIDNIGHT} + d * 86400 + k * 600 AS up
  FROM (SELECT unnest(range(0, {len(DAYS)})) AS d), (SELECT unnest(range(1, 145)) AS k))"""


def _tick_rows(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT t.up, r.* FROM ticks t JOIN {source} r ON r.dt = t.dt AND r.dateline >= t.low AND r.dateline <= t.up)"""


def _tick_record(source: str) -> str:
    return h5_record_sql(source).replace(f"cast({WINDOW.dt} AS integer)", "cast(dt AS integer)").replace(
        f"cast({WINDOW.up} AS bigint)", "cast(up AS bigint)")


@query("h5_backfill", with_views(
    f"{_tick_record('detail')} UNION ALL {_tick_record('total')}",
    _TICKS, h5_rows(None), active_rows(None), rollup_rows("rows_h5", "h5u"), rollup_rows("rows_active", "actu"),
    _tick_rows("h5u", "h5t"), _tick_rows("actu", "actt"), _tick_rows("rows_h5", "h5b"), _tick_rows("rows_active", "actb"),
    f"""detail AS (
  SELECT t.*, a.activecnt, a.incr_activecnt
  FROM (SELECT dt, up, qid, {_at_ticks(metrics_sql('uid', 'clientip'))} FROM h5t GROUP BY dt, up, qid) t
  LEFT JOIN (SELECT dt, up, qid, {_at_ticks(active_sql())} FROM actt GROUP BY dt, up, qid) a USING (dt, up, qid))""",
    f"""total AS (
  SELECT k.dt, k.up, 'total' AS qid, t.* EXCLUDE (dt, up), a.* EXCLUDE (dt, up)
  FROM ticks k
  LEFT JOIN (SELECT dt, up, {_at_ticks(metrics_sql('uid', 'clientip'))} FROM h5b GROUP BY dt, up) t USING (dt, up)
  LEFT JOIN (SELECT dt, up, {_at_ticks(active_sql())} FROM actb GROUP BY dt, up) a USING (dt, up))"""))
def h5_backfill(spark, sf):
    return backfill.h5_full_backfill(*_h5_inputs(spark, sf), DAYS)


# ---- sinks: write, then read back ---------------------------------------------------------------

@query("sink_stage_h5", with_views(h5_full_sql(), *h5_full_ctes()))
def sink_stage_h5(spark, sf):
    path = tables.scratch_path(spark, "stage_h5")
    tables.overwrite_slice(h5_full_report(spark, sf), path, tables.H5, WINDOW.dt, WINDOW.up)
    return tables.read_slice(spark, path, tables.H5, WINDOW.dt, WINDOW.up)


@query("sink_stage_app", with_views(app_report_sql(), *app_ctes(app_rows(), "rows_app")))
def sink_stage_app(spark, sf):
    path = tables.scratch_path(spark, "stage_app")
    tables.overwrite_slice(app_report(spark, sf), path, tables.APP, WINDOW.dt, WINDOW.up)
    return tables.read_slice(spark, path, tables.APP, WINDOW.dt, WINDOW.up)


@query("sink_slice_overwrite", with_views(
    f"{h5_full_sql()} UNION ALL {h5_full_sql(EARLIER, '_e')}", *_basic_ctes(), *_basic_ctes(EARLIER, "_e")))
def sink_slice_overwrite(spark, sf):
    """Two slices, one of them written twice."""
    path = tables.scratch_path(spark, "overwrite")
    log = derived.basic_log(spark, sf)
    for w in (WINDOW, EARLIER, WINDOW):
        tables.overwrite_slice(reports.h5_basic_report(log, w), path, tables.H5, w.dt, w.up)
    return tables.read_table(spark, path, tables.H5)


_H5_KEYS, _APP_KEYS = schema.H5_KEYS, schema.APP_KEYS


@query("publish_max_merge", with_views(
    max_merge_sql("staged", _H5_KEYS, H5_METRIC_COLUMNS), *h5_full_ctes(), f"staged AS ({h5_full_sql()})"))
def publish_max_merge(spark, sf):
    staging, final = tables.scratch_path(spark, "staging"), tables.scratch_path(spark, "final")
    runs.run_h5_full(spark, *_h5_inputs(spark, sf), WINDOW, staging, final)
    return tables.read_slice(spark, final, tables.H5, WINDOW.dt, WINDOW.up)


@query("publish_max_merge_app", with_views(
    max_merge_sql("staged", _APP_KEYS, APP_METRIC_COLUMNS), *app_ctes(app_rows(), "rows_app"),
    f"staged AS ({app_report_sql()})"))
def publish_max_merge_app(spark, sf):
    staging, final = tables.scratch_path(spark, "staging_app"), tables.scratch_path(spark, "final_app")
    runs.run_app(spark, derived.app_log(spark, sf), WINDOW, staging, final)
    return tables.read_slice(spark, final, tables.APP, WINDOW.dt, WINDOW.up)


@query("sink_append_merge", with_views(
    max_merge_sql("staged", _H5_KEYS, H5_METRIC_COLUMNS), *_basic_ctes(),
    *_MINI_CTES, f"staged AS ({h5_full_sql()} UNION ALL {h5_record_sql('mini')})"))
def sink_append_merge(spark, sf):
    """The basic report staged and published, then the mini-program total added and published again."""
    staging, final = tables.scratch_path(spark, "append"), tables.scratch_path(spark, "append_final")
    log, active, _ = _h5_inputs(spark, sf)
    runs.run_h5_basic(spark, derived.basic_log(spark, sf), WINDOW, staging, final)
    runs.run_mini_program(spark, log, active, WINDOW, staging, final)
    return tables.read_slice(spark, final, tables.H5, WINDOW.dt, WINDOW.up)
