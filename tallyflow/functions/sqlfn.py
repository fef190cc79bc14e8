"""The rules as temporary SQL functions, for users who write SQL.

They are SQL functions, not Python ones: Spark inlines their bodies into the query plan. Of the table functions,
``register_tables`` makes those that give a report's rows, or a report, for a tick. The tick is an argument, so its
day and range become literals, and reach the partitions and the file source.
"""

from pyspark.sql import SparkSession

from tallyflow.functions import clean


def _text(s: str) -> str:
    return "r'" + s + "'"


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def definitions() -> dict[str, str]:
    """Signature and body of each function."""
    return {
        "tf_null_text(s STRING) RETURNS STRING": f"coalesce(s, '{clean.NULL_TEXT}')",
        "tf_trim_special(s STRING) RETURNS STRING": r"translate(s, '\\\'', '')",
        "tf_trim_date(s STRING) RETURNS STRING": f"regexp_replace(s, {_text(clean.DATE_SUFFIX)}, '$1')",
        "tf_normalise_channel(s STRING) RETURNS STRING":
            f"regexp_replace(replace(s, 'h5bt', 'h5'), {_text(clean.DATE_SUFFIX)}, '$1')",
        "tf_channel_ok(s STRING) RETURNS BOOLEAN": f"rlike(s, {_text(clean.CHANNEL_CHARSET)})",
        "tf_is_integer(s STRING) RETURNS BOOLEAN": f"rlike(s, {_text(clean.SIGNED_INTEGER)})",
        "tf_log_type_ok(logtype STRING, urlto STRING) RETURNS BOOLEAN":
            f"logtype <> '{clean.SDK_ACTIVE_LOGTYPE}' OR "
            f"(logtype = '{clean.SDK_ACTIVE_LOGTYPE}' AND rlike(urlto, 'http'))",
        "tf_null_channel_ok(qid STRING, app STRING) RETURNS BOOLEAN":
            f"coalesce(qid, 'null') <> 'null' OR (upper(app) NOT IN ({_list(clean.EXCLUDED_APPS)}) "
            f"AND NOT rlike(upper(app), {_text(clean.EXCLUDED_APP_PREFIX)}))",
        "tf_news_url_ok(urlto STRING) RETURNS BOOLEAN":
            "urlto LIKE 'http%' AND urlto NOT LIKE 'http%video%' AND urlto NOT LIKE 'http%picture%' "
            "AND urlto NOT LIKE 'http%douyin%'",
        "tf_visitor(qid STRING, uid STRING, device STRING) RETURNS STRING":
            f"CASE WHEN contains(lower(qid), '{clean.HUITT}') AND device <> 'null' THEN device ELSE uid END",
        "tf_visitor_exact(qid STRING, uid STRING, device STRING) RETURNS STRING":
            f"CASE WHEN qid = '{clean.HUITT}' THEN device ELSE uid END",
        "tf_clip(s STRING, width INT) RETURNS STRING": "substring(s, 1, width)",
        "tf_regex_group(s STRING, pattern STRING, i INT) RETURNS STRING":
            "CASE WHEN s IS NULL OR s = '' THEN NULL WHEN pattern IS NULL OR pattern = '' THEN pattern "
            "WHEN length(s) < i THEN raise_error(concat('text is shorter than start position ', i)) "
            "WHEN i = 0 THEN CASE WHEN rlike(s, pattern) THEN regexp_extract(s, pattern, 0) END "
            "WHEN rlike(s, concat('^(?s:.{', i, ',}?)(?:', pattern, ')')) AND "
            "(regexp_extract(s, concat('^(?s:.{', i, ',}?)(?:', pattern, ')'), i) IS NULL OR "
            r"rlike(s, concat('^(?=(?s:.{', i, ',}?)(?:', pattern, '))(?s:.*?)\\', i))) "
            "THEN regexp_extract(s, concat('^(?s:.{', i, ',}?)(?:', pattern, ')'), i) END",
        "tf_midnight(tick STRING) RETURNS BIGINT":
            "unix_timestamp(date_trunc('DAY', to_timestamp(tick, 'yyyyMMddHHmmss')))",
        # in the first ten minutes after midnight, the whole day before
        "tf_window_dt(tick STRING) RETURNS STRING":
            "CASE WHEN substring(tick, 9, 3) = '000' THEN date_format(date_sub(to_timestamp(tick, 'yyyyMMddHHmmss'), 1), 'yyyyMMdd') "
            "ELSE substring(tick, 1, 8) END",
        "tf_window_low(tick STRING) RETURNS BIGINT":
            "CASE WHEN substring(tick, 9, 3) = '000' "
            "THEN unix_timestamp(CAST(date_sub(to_timestamp(tick, 'yyyyMMddHHmmss'), 1) AS TIMESTAMP)) "
            "ELSE unix_timestamp(date_trunc('DAY', to_timestamp(tick, 'yyyyMMddHHmmss'))) END",
        "tf_window_up(tick STRING) RETURNS BIGINT":
            "unix_timestamp(to_timestamp(concat(substring(tick, 1, 11), '000'), 'yyyyMMddHHmmss'))",
        "tf_app_from_software(softname STRING, softid STRING) RETURNS STRING":
            f"CASE WHEN softname IN ({_list(clean.BROWSERS)}) THEN softname "
            "ELSE substring(coalesce(softid, 'null'), 1, length(coalesce(softid, 'null')) - CASE "
            "WHEN contains(softid, 'Android') THEN 7 WHEN contains(softid, 'IOS') THEN 3 ELSE 0 END) END",
        "tf_floor_ten_minutes(epoch BIGINT) RETURNS BIGINT": 
            "epoch - minute(timestamp_seconds(epoch)) % 10 * 60 - second(timestamp_seconds(epoch))",
        "tf_format_time(s STRING) RETURNS STRING":
            "concat(substring(s, 1, 4), '-', substring(s, 5, 2), '-', substring(s, 7, 2), ' ', "
            "substring(s, 9, 2), ':', substring(s, 11, 2), ':', substring(s, 13, 2))",
    }


def register(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary functions in the session; gives their names."""
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in definitions()]


# ---- table functions ------------------------------------------------------------------------

_IN_WINDOW = "dt = tf_window_dt(tick) AND dateline BETWEEN tf_window_low(tick) AND tf_window_up(tick)"
_COUNTS = (
    "count(*), count(DISTINCT uid), count(DISTINCT clientip), count_if(recent), "
    "count(DISTINCT CASE WHEN recent THEN uid END), count(DISTINCT CASE WHEN recent THEN clientip END)"
)


def window_definition() -> tuple[str, str]:
    """Signature and query of the report window as a table of one row."""
    return "tf_report_window(tick STRING) RETURNS TABLE(dt STRING, low BIGINT, up BIGINT)", (
        "SELECT tf_window_dt(tick), tf_window_low(tick), tf_window_up(tick)")


def table_definitions(logs: dict[str, str]) -> dict[str, str]:
    """Signature and query of each table function; ``logs`` names the tables of the logs a user has."""
    out = {}
    if "basic_log" in logs:
        out["tf_basic_rows(tick STRING) RETURNS TABLE(dateline BIGINT, clientip STRING, qid STRING, uid STRING)"] = (
            "SELECT dateline, tf_null_text(clientip), tf_trim_special(lower(tf_null_text(qid))), "
            f"tf_null_text(tf_visitor_exact(qid, uid, clientime)) FROM {logs['basic_log']} WHERE {_IN_WINDOW}")
        # members are never null here, so the distinct counts are whole
        out["tf_basic_report(tick STRING) RETURNS TABLE(is_total BOOLEAN, qid STRING, pv BIGINT, uv BIGINT, ip BIGINT, "
            "incr_pv BIGINT, incr_uv BIGINT, incr_ip BIGINT)"] = (
            f"SELECT grouping(qid) = 1, CASE WHEN grouping(qid) = 1 THEN '{clean.TOTAL}' ELSE tf_clip(qid, {clean.QID_WIDTH}) END, "
            f"{_COUNTS} FROM (SELECT *, dateline > tf_window_up(tick) - 600 AS recent FROM tf_basic_rows(tick)) GROUP BY GROUPING SETS ((qid), ())")
    if "h5_log" in logs:
        out["tf_h5_rows(tick STRING) RETURNS TABLE(dateline BIGINT, clientip STRING, qid STRING, uid STRING)"] = (
            "SELECT dateline, clientip, tf_null_text(qid), tf_visitor(tf_null_text(qid), uid, clientime) "
            f"FROM {logs['h5_log']} WHERE {_IN_WINDOW} AND tf_log_type_ok(logtype, urlto) "
            "AND tf_null_channel_ok(qid, apptypeid) AND tf_channel_ok(tf_null_text(qid))")
    if "h5_active_log" in logs:
        out["tf_h5_active_rows(tick STRING) RETURNS TABLE(dateline BIGINT, qid STRING, uid STRING)"] = (
            f"SELECT dateline, tf_null_text(qid), uid FROM {logs['h5_active_log']} WHERE {_IN_WINDOW} AND tf_channel_ok(tf_null_text(qid))")
    return out


def register_tables(spark: SparkSession, logs: dict[str, str]) -> list[str]:
    """Create (or replace) all functions, the table functions over the given logs too; gives the latters' names."""
    register(spark)
    every = dict([window_definition()]) | table_definitions(logs)
    for signature, body in every.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in every]
