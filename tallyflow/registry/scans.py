"""Sources, filters and scalar functions."""

from pyspark.sql import functions as F

from tallyflow.functions import clean, timing
from tallyflow.operators.rollups import channel_list
from tallyflow.registry.base import (
    APP_FROM_SOFT_SQL, LOG_TYPE_SQL, NEWS_URL_SQL, NULL_CHANNEL_SQL, WINDOW, Registry, active_rows,
    app_active_rows, app_rows, charset_sql, h5_rows, in_window_sql, news_rows, normalise_sql, recent_sql,
    trim_date_sql, VISITOR_SQL, with_views,
)
from tallyflow.sources import derived, logs

REGISTRY = Registry()
query = REGISTRY.query
NOW = WINDOW.low + 13 * 3600 + 47 * 60 + 31
SLICES = (NOW - WINDOW.low) // 600

# ---- scans ------------------------------------------------------------------------------

SLICED_ROWS = f"""sliced AS (
  SELECT cast((dateline - {WINDOW.low}) // 600 AS integer) AS slot, dateline, clientip,
    coalesce(qid, 'null') AS qid, coalesce(uid, 'null') AS uid
  FROM basic_log WHERE dt = '{WINDOW.dt}' AND dateline >= {WINDOW.low} AND dateline < {WINDOW.low + SLICES * 600})"""


def sliced(spark, sf):
    return logs.sliced_day(derived.basic_log(spark, sf), WINDOW.dt, WINDOW.low, NOW)


query("scan_sliced_day", with_views("SELECT * FROM sliced", SLICED_ROWS))(sliced)


@query("scan_day_range", with_views(f"""
SELECT dt, dateline, clientip, qid, CASE WHEN qid = 'huitt' THEN clientime ELSE uid END AS uid
FROM basic_log WHERE {in_window_sql()}"""))
def scan_day_range(spark, sf):
    return logs.day_range(derived.basic_log(spark, sf), WINDOW)


@query("scan_h5_clean", with_views("SELECT * FROM rows_h5", h5_rows()))
def scan_h5_clean(spark, sf):
    return logs.h5_clean(derived.h5_log(spark, sf), WINDOW)


@query("scan_h5_active", with_views("SELECT * FROM rows_active", active_rows()))
def scan_h5_active(spark, sf):
    return logs.h5_active(derived.h5_active_log(spark, sf), WINDOW)


@query("scan_app", with_views("SELECT * FROM rows_app", app_rows()))
def scan_app(spark, sf):
    return logs.app(derived.app_log(spark, sf), WINDOW)


@query("scan_app_active", with_views("SELECT * FROM rows_app_active", app_active_rows()))
def scan_app_active(spark, sf):
    return logs.app_active(derived.app_active_log(spark, sf), WINDOW)


@query("scan_app_news", with_views("SELECT * FROM rows_news", news_rows()))
def scan_app_news(spark, sf):
    return logs.app_news(derived.app_log(spark, sf), WINDOW)


@query("dim_sdk_list", with_views("SELECT DISTINCT h5qid FROM sdk_list WHERE h5qid IS NOT NULL"))
def dim_sdk_list(spark, sf):
    return channel_list(derived.sdk_list(spark, sf))


# ---- filters, each alone over the whole log -----------------------------------------------

def _filter(name: str, log: str, where: str, rule):
    @query(name, with_views(f"SELECT * FROM {log} WHERE {where}"))
    def run(spark, sf):
        return getattr(derived, log)(spark, sf).where(rule())


_filter("filter_last_10m", "h5_log", recent_sql(), lambda: clean.last_ten_minutes(F.col("dateline"), WINDOW.up))
_filter("filter_logtype", "h5_log", LOG_TYPE_SQL, lambda: clean.keeps_log_type(F.col("logtype"), F.col("urlto")))
_filter("filter_null_channel", "h5_log", NULL_CHANNEL_SQL, lambda: clean.keeps_null_channel(F.col("qid"), F.col("apptypeid")))
_filter("filter_charset", "h5_log", charset_sql("coalesce(qid, 'null')"),
        lambda: clean.has_channel_charset(clean.null_text(F.col("qid"))))
_filter("filter_device", "app_log", "clientime IS NOT NULL AND clientime <> 'null'", lambda: clean.has_device(F.col("clientime")))
_filter("filter_device_trim", "app_log", "clientime IS NOT NULL AND trim(clientime) NOT IN ('null', '')",
        lambda: clean.has_device_trimmed(F.col("clientime")))
_filter("filter_app_tt", "app_log", "upper(apptypeid) LIKE '%TT%' AND lower(apptypeid) <> 'huitt'",
        lambda: clean.is_tt_app(F.col("apptypeid")))
_filter("filter_app_not_huitt", "app_log", "lower(coalesce(apptypeid, 'NULL')) <> 'huitt'",
        lambda: clean.is_not_huitt(F.col("apptypeid")))
_filter("filter_news_url", "app_log", NEWS_URL_SQL, lambda: clean.is_news_url(F.col("urlto")))
_filter("filter_miniprogram", "h5_log", "qid IN ('sharexcx', 'xiaochengxu_dftt')", lambda: clean.is_mini_program(F.col("qid")))


# ---- projections --------------------------------------------------------------------------

@query("uid_override_exact", with_views(
    "SELECT qid, uid AS was, CASE WHEN qid = 'huitt' THEN clientime ELSE uid END AS uid FROM basic_log"))
def uid_override_exact(spark, sf):
    uid = clean.visitor_exact(F.col("qid"), F.col("uid"), F.col("clientime"))
    return derived.basic_log(spark, sf).select("qid", F.col("uid").alias("was"), uid.alias("uid"))


@query("uid_override_contains", with_views(f"SELECT qid, uid AS was, {VISITOR_SQL} AS uid FROM h5_log"))
def uid_override_contains(spark, sf):
    uid = clean.visitor_contains(clean.null_text(F.col("qid")), F.col("uid"), F.col("clientime"))
    return derived.h5_log(spark, sf).select("qid", F.col("uid").alias("was"), uid.alias("uid"))


@query("fn_null_text", with_views("SELECT qid AS was, coalesce(qid, 'null') AS qid FROM h5_log"))
def fn_null_text(spark, sf):
    return derived.h5_log(spark, sf).select(F.col("qid").alias("was"), clean.null_text(F.col("qid")).alias("qid"))


@query("fn_trim_special", r"""
SELECT page_id, replace(replace(html, '\', ''), '''', '') AS html,
  replace(replace('a\b''' || url || '''\', '\', ''), '''', '') AS quoted FROM pages""")
def fn_trim_special(spark, sf):
    quoted = F.concat(F.lit("a\\b'"), "url", F.lit("'\\"))
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id", clean.trim_special(F.col("html")).alias("html"), clean.trim_special(quoted).alias("quoted")
    )


# suffixes that test the rule's edges: signs, month and day bounds, more than five, nothing in front
SUFFIXES = ["", "240115", "240115240116", "991399", "+90131", "-00131", "-10131", "240100", "241231",
            "240132", "2401152401152401152401152401152401", "240115\n", "24011524011524011524011524011524011599"]


def _suffix_sql(key: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUFFIXES))
    return f"CASE {key} % {len(SUFFIXES)} {cases} END".replace("\n", "' || chr(10) || '")


_DATED_SQL = f"dated AS (SELECT id, CASE WHEN id % 3 = 0 THEN '' ELSE t END || {_suffix_sql('id')} AS s FROM log)"


def _dated(spark, sf):
    log = derived.event_log(spark, sf)
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("id") % len(SUFFIXES) + 1).cast("int"))
    head = F.when(F.col("id") % 3 == 0, "").otherwise(F.col("t"))
    return log.select("id", F.concat(head, suffix).alias("s"))


@query("fn_trim_date", with_views(f"SELECT id, s, {trim_date_sql('s')} AS trimmed FROM dated", _DATED_SQL))
def fn_trim_date(spark, sf):
    return _dated(spark, sf).select("id", "s", clean.trim_date(F.col("s")).alias("trimmed"))


@query("fn_channel_norm", with_views(
    f"SELECT qid AS was, {normalise_sql('qid')} AS qid, lower({trim_date_sql(normalise_sql('qid'))}) AS label FROM h5_log"))
def fn_channel_norm(spark, sf):
    once = clean.normalise_channel(F.col("qid"))
    return derived.h5_log(spark, sf).select(
        F.col("qid").alias("was"), once.alias("qid"), F.lower(clean.trim_date(once)).alias("label")
    )


@query("fn_app_from_soft", with_views(f"SELECT softname, softid, {APP_FROM_SOFT_SQL} AS apptypeid FROM app_active_log"))
def fn_app_from_soft(spark, sf):
    app = clean.app_from_software(F.col("softname"), F.col("softid"))
    return derived.app_active_log(spark, sf).select("softname", "softid", app.alias("apptypeid"))


@query("fn_truncate_labels", with_views(
    "SELECT left(qid, 50) AS qid, left(apptypeid, 20) AS app, left(apptypeid, 50) AS app_total FROM h5_log"))
def fn_truncate_labels(spark, sf):
    return derived.h5_log(spark, sf).select(
        clean.clip(F.col("qid"), clean.QID_WIDTH).alias("qid"),
        clean.clip(F.col("apptypeid"), clean.APP_WIDTH).alias("app"),
        clean.clip(F.col("apptypeid"), clean.APP_TOTAL_WIDTH).alias("app_total"),
    )


@query("fn_is_integer", with_views("""
SELECT id, s, regexp_full_match(s, '[-+]?[0-9]*') AS is_int FROM (
  SELECT id, CASE id % 7 WHEN 0 THEN cast(u AS varchar) WHEN 1 THEN '-' || u WHEN 2 THEN '+' WHEN 3 THEN ''
    WHEN 4 THEN t || u WHEN 5 THEN u || '-' ELSE u || chr(10) END AS s FROM log)"""))
def fn_is_integer(spark, sf):
    u = F.col("u").cast("string")
    cases = [u, F.concat(F.lit("-"), u), F.lit("+"), F.lit(""), F.concat("t", u), F.concat(u, F.lit("-")),
             F.concat(u, F.lit("\n"))]
    s = F.element_at(F.array(*cases), (F.col("id") % 7 + 1).cast("int"))
    return derived.event_log(spark, sf).select("id", s.alias("s")).select("*", clean.is_integer(F.col("s")).alias("is_int"))


@query("fn_regexp_extract", r"""
SELECT page_id, url,
  nullif(regexp_extract(url, '[a-z]+', 0), '') AS g0,
  nullif(regexp_extract(substr(url, 2), '([a-z]+)[.]', 1), '') AS g1,
  nullif(regexp_extract(substr(url, 3), '(t)([a-z]+)', 2), '') AS g2
FROM pages""")
def fn_regexp_extract(spark, sf):
    url = F.col("url")
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id",
        "url",
        clean.regex_group(url, "[a-z]+", 0).alias("g0"),
        clean.regex_group(url, "([a-z]+)[.]", 1).alias("g1"),
        clean.regex_group(url, "(t)([a-z]+)", 2).alias("g2"),
    )


@query("fn_format_time", """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS arg, strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted FROM events""")
def fn_format_time(spark, sf):
    arg = F.date_format("ts", "yyyyMMddHHmmss")
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", arg.alias("arg"), timing.format_time(arg).alias("formatted")
    )


@query("fn_floor_10m", with_views("SELECT id, dateline, (dateline // 600) * 600 AS tick FROM log"))
def fn_floor_10m(spark, sf):
    tick = timing.floor_ten_minutes(F.col("dateline"))
    return derived.event_log(spark, sf).select("id", "dateline", tick.alias("tick"))


@query("fn_report_window", with_views("""
SELECT id, dateline,
  CASE WHEN dateline % 86400 < 600 THEN strftime(make_timestamp((dateline - 86400) * 1000000), '%Y%m%d')
       ELSE strftime(make_timestamp(dateline * 1000000), '%Y%m%d') END AS dt,
  CASE WHEN dateline % 86400 < 600 THEN dateline - dateline % 86400 - 86400
       ELSE dateline - dateline % 86400 END AS low,
  dateline - dateline % 600 AS up
FROM log"""))
def fn_report_window(spark, sf):
    window = timing.report_window_columns(F.col("dateline"))
    return derived.event_log(spark, sf).select("id", "dateline", *[c.alias(n) for n, c in window.items()])
