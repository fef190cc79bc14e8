"""Named queries with the SQL that must give the same rows.

A query runs on the logs derived from the test tables, whole. Its SQL is written from the rules,
not from the Spark plan: ``count(distinct)`` with a null correction where the library groups twice,
unions and left joins where it spreads rows.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyflow.functions import clean
from tallyflow.functions.timing import ReportWindow, report_window
from tallyflow.sources import derived

Query = Callable[[SparkSession, str], DataFrame]

TICK = "20240115134731"
WINDOW = report_window(TICK)
EARLIER = report_window("20240115133000")


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


class Registry(dict[str, Entry]):
    def query(self, name: str, sql: str | None):
        def add(run: Query) -> Query:
            self[name] = Entry(run, sql)
            return run

        return add


# ---- SQL pieces -------------------------------------------------------------------------

def with_views(body: str, *ctes: str) -> str:
    """``body`` over the derived logs and further CTEs."""
    return "WITH " + ",\n".join([derived.sql_views(), *ctes]) + "\n" + body.strip()


def in_window_sql(w: ReportWindow = WINDOW) -> str:
    return f"dt = '{w.dt}' AND dateline >= {w.low} AND dateline <= {w.up}"


def recent_sql(up: int = WINDOW.up) -> str:
    return f"(dateline > {up - 600} AND dateline <= {up})"


def distinct_sql(column: str, where: str = "true") -> str:
    """Distinct values, a null counting as one of them."""
    return (
        f"count(DISTINCT CASE WHEN {where} THEN {column} END) "
        f"+ coalesce(max(CASE WHEN {where} AND {column} IS NULL THEN 1 ELSE 0 END), 0)"
    )


LOG_TYPE_SQL = (
    "(logtype <> 'log_toutiao_sdk_active' "
    "OR (logtype = 'log_toutiao_sdk_active' AND urlto LIKE '%http%'))"
)
_EXCLUDED = ", ".join(f"'{app}'" for app in clean.EXCLUDED_APPS)
NULL_CHANNEL_SQL = (
    f"(coalesce(qid, 'null') <> 'null' OR (upper(apptypeid) NOT IN ({_EXCLUDED}) "
    "AND left(upper(apptypeid), 4) <> 'ZJZY' AND left(upper(apptypeid), 5) <> 'GSIOS'))"
)


def charset_sql(column: str) -> str:
    return f"regexp_full_match({column}, '[a-zA-Z0-9|_-]*')"


def trim_date_sql(column: str) -> str:
    """One suffix at a time, five times."""
    one = r"(?s)^(.+)(?:[0-9]{2}|\+[0-9]|-0)(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])\z"
    for _ in range(5):
        column = rf"regexp_replace({column}, '{one}', '\1')"
    return column


def normalise_sql(column: str) -> str:
    return trim_date_sql(f"replace({column}, 'h5bt', 'h5')")


APP_FROM_SOFT_SQL = """CASE WHEN softname IN ('gsbrowser', 'ltbrowser') THEN softname
    ELSE left(coalesce(softid, 'null'), length(coalesce(softid, 'null'))
      - CASE WHEN contains(coalesce(softid, ''), 'Android') THEN 7
             WHEN contains(coalesce(softid, ''), 'IOS') THEN 3 ELSE 0 END) END"""
NEWS_URL_SQL = (
    "urlto LIKE 'http%' AND urlto NOT LIKE 'http%video%' AND urlto NOT LIKE 'http%picture%' "
    "AND urlto NOT LIKE 'http%douyin%'"
)
VISITOR_SQL = """CASE WHEN contains(lower(coalesce(qid, 'null')), 'huitt')
      AND clientime IS NOT NULL AND clientime <> 'null' THEN clientime ELSE uid END"""


def basic_rows(w: ReportWindow = WINDOW, name: str = "rows_basic") -> str:
    return f"""{name} AS (
  SELECT dateline, replace(replace(lower(coalesce(qid, 'null')), '\\', ''), '''', '') AS qid,
    coalesce(CASE WHEN qid = 'huitt' THEN clientime ELSE uid END, 'null') AS uid,
    coalesce(clientip, 'null') AS ip
  FROM basic_log WHERE {in_window_sql(w)})"""


def h5_rows(w: ReportWindow | None = WINDOW, name: str = "rows_h5") -> str:
    when = in_window_sql(w) if w else "true"
    return f"""{name} AS (
  SELECT dt, dateline, clientip, coalesce(qid, 'null') AS qid, {VISITOR_SQL} AS uid
  FROM h5_log WHERE {when} AND {LOG_TYPE_SQL} AND {NULL_CHANNEL_SQL}
    AND {charset_sql("coalesce(qid, 'null')")})"""


def active_rows(w: ReportWindow | None = WINDOW, name: str = "rows_active") -> str:
    when = in_window_sql(w) if w else "true"
    return f"""{name} AS (
  SELECT dt, dateline, cast(NULL AS varchar) AS clientip, coalesce(qid, 'null') AS qid, uid
  FROM h5_active_log WHERE {when} AND {charset_sql("coalesce(qid, 'null')")})"""


def rollup_rows(source: str, name: str) -> str:
    """Rows under their channel, the list's again as sdk_total, the mini programs' as their total."""
    return f"""{name} AS (
  SELECT * REPLACE (lower(qid) AS qid) FROM {source}
  UNION ALL SELECT * REPLACE ('sdk_total' AS qid) FROM {source}
    WHERE qid IN (SELECT h5qid FROM sdk_list WHERE h5qid IS NOT NULL)
  UNION ALL SELECT * REPLACE ('小程序汇总' AS qid) FROM {source}
    WHERE qid IN ('sharexcx', 'xiaochengxu_dftt'))"""


def app_rows(w: ReportWindow | None = WINDOW, name: str = "rows_app") -> str:
    when = in_window_sql(w) if w else "true"
    return f"""{name} AS (
  SELECT dt, dateline, clientip, coalesce(appqid, 'null') AS qid, apptypeid, clientime AS uid
  FROM app_log WHERE {when} AND clientime IS NOT NULL AND clientime <> 'null'
    AND upper(apptypeid) LIKE '%TT%' AND lower(apptypeid) <> 'huitt'
    AND {charset_sql("coalesce(appqid, 'null')")})"""


def app_active_rows(w: ReportWindow = WINDOW, name: str = "rows_app_active") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT dt, dateline, cast(NULL AS varchar) AS clientip, {normalise_sql("coalesce(qid, 'null')")} AS qid,
      {APP_FROM_SOFT_SQL} AS apptypeid, uid
    FROM app_active_log WHERE {in_window_sql(w)}) WHERE {charset_sql("qid")})"""


def news_rows(w: ReportWindow = WINDOW, name: str = "rows_news") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT dt, dateline, clientip, {normalise_sql("coalesce(appqid, 'null')")} AS qid,
      upper(coalesce(apptypeid, 'null')) AS apptypeid, clientime AS uid
    FROM app_log WHERE {in_window_sql(w)} AND {NEWS_URL_SQL}
      AND clientime IS NOT NULL AND trim(clientime) NOT IN ('null', '')
      AND lower(coalesce(apptypeid, 'null')) <> 'huitt') WHERE {charset_sql("qid")})"""


def app_keys(source: str, name: str) -> str:
    """Rows with the labels the app reports group by."""
    return f"""{name} AS (
  SELECT * REPLACE (lower({trim_date_sql('qid')}) AS qid, upper(coalesce(apptypeid, 'null')) AS apptypeid)
  FROM {source})"""


def metrics_sql(visitor: str, ip: str, up: int = WINDOW.up) -> str:
    r = recent_sql(up)
    return f"""count(*) AS pv, {distinct_sql(visitor)} AS uv, {distinct_sql(ip)} AS ip,
    count(CASE WHEN {r} THEN 1 END) AS incr_pv, {distinct_sql(visitor, r)} AS incr_uv,
    {distinct_sql(ip, r)} AS incr_ip"""


def active_sql(up: int = WINDOW.up) -> str:
    return f"{distinct_sql('uid')} AS activecnt, {distinct_sql('uid', recent_sql(up))} AS incr_activecnt"


H5_METRIC_COLUMNS = ["pv", "uv", "ip", "incr_pv", "incr_uv", "incr_ip", "activecnt", "incr_activecnt"]
APP_METRIC_COLUMNS = H5_METRIC_COLUMNS[:6]


def h5_record_sql(source: str, w: ReportWindow = WINDOW, qid: str = "left(qid, 50)") -> str:
    """Output columns of an H5 report from rows of ``qid`` and metrics; missing ones are 0."""
    metrics = ", ".join(f"cast(coalesce({c}, 0) AS bigint) AS {c}" for c in H5_METRIC_COLUMNS)
    return (
        f"SELECT cast({w.dt} AS integer) AS dt, cast({w.up} AS bigint) AS currenttime, {qid} AS qid, "
        f"{metrics} FROM {source}"
    )


def app_record_sql(source: str, app: str, w: ReportWindow = WINDOW) -> str:
    metrics = ", ".join(f"cast(coalesce({c}, 0) AS bigint) AS {c}" for c in APP_METRIC_COLUMNS)
    return (
        f"SELECT cast({w.dt} AS integer) AS dt, cast({w.up} AS bigint) AS logtime, {app} AS apptypeid, "
        f"left(qid, 50) AS qid, {metrics}, strftime(make_timestamp({w.up} * 1000000::bigint), '%Y-%m-%d %H:%M:%S') "
        f"AS currenttime FROM {source}"
    )


def h5_full_ctes(w: ReportWindow = WINDOW, tag: str = "") -> list[str]:
    """CTEs ending in ``detail`` and ``total`` of the full report."""
    return [
        h5_rows(w, f"rows_h5{tag}"),
        active_rows(w, f"rows_active{tag}"),
        rollup_rows(f"rows_h5{tag}", f"h5u{tag}"),
        rollup_rows(f"rows_active{tag}", f"actu{tag}"),
        f"""detail{tag} AS (
  SELECT t.*, a.activecnt, a.incr_activecnt
  FROM (SELECT qid, {metrics_sql('uid', 'clientip', w.up)} FROM h5u{tag} GROUP BY qid) t
  LEFT JOIN (SELECT qid, {active_sql(w.up)} FROM actu{tag} GROUP BY qid) a USING (qid))""",
        f"""total{tag} AS (
  SELECT 'total' AS qid, t.*, a.*
  FROM (SELECT {metrics_sql('uid', 'clientip', w.up)} FROM rows_h5{tag}) t,
       (SELECT {active_sql(w.up)} FROM rows_active{tag}) a)""",
    ]


def h5_full_sql(w: ReportWindow = WINDOW, tag: str = "") -> str:
    return f"{h5_record_sql(f'detail{tag}', w)} UNION ALL {h5_record_sql(f'total{tag}', w)}"


def app_ctes(rows: str, source: str, up: int = WINDOW.up) -> list[str]:
    return [
        rows,
        app_keys(source, "keyed"),
        f"detail AS (SELECT apptypeid, qid, {metrics_sql('uid', 'clientip', up)} FROM keyed GROUP BY apptypeid, qid)",
        f"total AS (SELECT apptypeid, 'total' AS qid, {metrics_sql('uid', 'clientip', up)} FROM keyed GROUP BY apptypeid)",
    ]


def app_report_sql(w: ReportWindow = WINDOW) -> str:
    return (
        f"{app_record_sql('detail', 'left(apptypeid, 20)', w)} "
        f"UNION ALL {app_record_sql('total', 'left(apptypeid, 50)', w)}"
    )


def max_merge_sql(source: str, keys: list[str], values: list[str]) -> str:
    return f"SELECT {', '.join(keys)}, {', '.join(f'max({v}) AS {v}' for v in values)} FROM {source} GROUP BY {', '.join(keys)}"
