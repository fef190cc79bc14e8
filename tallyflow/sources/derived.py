"""Traffic logs derived from the ``events`` table, by fixed formulas.

There are no public traffic logs in the test data. These views fold thirty days of events onto
three days and give each row channel, visitor, device and app values that reach every rule: nulls,
literal ``null`` texts, date suffixes, rejected characters, long labels, rows exactly at midnight
and on slice bounds.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# given, so that a scan does not open a file to find it
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
FIRST_MIDNIGHT = 1705190400  # 2024-01-14 00:00:00 UTC

# Formulas of the derived columns over id, u (user), t (event type) and sec (the event's second,
# folded onto three days). They read the same in Spark and in the oracle.
FORMULAS = {
    "dateline": "CAST(CASE WHEN id % 211 = 0 THEN sec - sec % 86400 WHEN id % 97 = 0 THEN sec - sec % 600 "
                "ELSE sec END AS bigint)",
    "dt": "CAST(20240114 + id % 3 AS {text})",
    "clientip": "'10.' || (u % 3) || '.' || (u % 11) || '.' || (id % 17)",
    "qid": "CASE id % 41 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN 'sharexcx' "
           "WHEN 3 THEN 'xiaochengxu_dftt' WHEN 4 THEN 'HuiTT_' || t WHEN 5 THEN 'huitt' "
           "WHEN 6 THEN t || '?_t=' || (u % 3) WHEN 7 THEN t || '240115' WHEN 8 THEN t || '240115240116' "
           "WHEN 9 THEN t || '991399' WHEN 10 THEN 'h5bt' || t WHEN 11 THEN repeat('x', 50) || t "
           "WHEN 12 THEN upper(t) ELSE t || '_' || (u % 7) END",
    "uid": "CASE WHEN id % 53 = 0 THEN NULL ELSE 'u' || u END",
    "clientime": "CASE id % 29 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '  ' "
                 "ELSE 'imei' || (u % 101) END",
    "apptypeid": "CASE WHEN id % 31 = 0 THEN NULL WHEN id % 31 = 1 THEN 'DFTT' WHEN id % 31 = 2 THEN 'zjzy_a' "
                 "WHEN id % 31 = 3 THEN 'GSIOSx' WHEN id % 31 = 4 THEN 'huitt' WHEN id % 31 = 5 THEN 'XWZXTT' "
                 "WHEN id % 31 = 6 THEN 'MyVeryLongApplicationTTName' WHEN id % 31 <= 15 THEN 'jstt2' "
                 "WHEN id % 31 <= 23 THEN 'ttNews' ELSE 'wap' END",
    "logtype": "CASE id % 13 WHEN 0 THEN 'log_toutiao_sdk_active' WHEN 1 THEN NULL ELSE 'log_' || t END",
    "urlto": "CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'http://a.example/video/1' "
             "WHEN 2 THEN 'https://a.example/picture/2' WHEN 3 THEN 'http://douyin.example/3' "
             "WHEN 4 THEN 'ftp://b.example/4' ELSE 'http://news.example/' || (id % 19) END",
    "softname": "CASE id % 23 WHEN 0 THEN NULL WHEN 1 THEN 'gsbrowser' WHEN 2 THEN 'ltbrowser' "
                "ELSE 'app' || (u % 4) END",
    "softid": "CASE WHEN id % 19 = 0 THEN NULL WHEN id % 19 <= 7 THEN 'tt' || (u % 4) || 'Android' "
              "WHEN id % 19 <= 13 THEN 'tt' || (u % 4) || 'IOS' WHEN id % 19 <= 15 THEN 'ttAndroidPad' "
              "ELSE 'plain' END",
}
# the activity log has channels the traffic log does not
ACTIVE_QID = "CASE WHEN id % 37 = 0 THEN 'active_only_' || t ELSE qid END"
ACTIVE_ROWS = "t IN ('view', 'signup')"
# the channel list as an external system would hold it: unsorted, repeated, with nulls
SDK_QID = "CASE WHEN id % 5 > 0 THEN t || '_' || (u % 7) END"
SDK_ROWS = "(t = 'click' AND u % 7 = 1) OR (t = 'view' AND u % 7 = 2) OR (t = 'signup' AND u % 7 = 0)"


def _formulas(text: str) -> list[str]:
    return [f"{sql.replace('{text}', text)} AS {name}" for name, sql in FORMULAS.items()]


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived columns of every event; each log selects its own."""
    second = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
    return (
        spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
        .selectExpr(
            "event_id AS id", "user_id AS u", "event_type AS t",
            f"{FIRST_MIDNIGHT} + (event_id % 3) * 86400 + {second} % 86400 AS sec",
        )
        .selectExpr("id", "u", "t", *_formulas("string"))
    )


def basic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("dateline", "clientip", "qid", "uid", "clientime", "dt")


def h5_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(
        "dateline", "clientip", "qid", "uid", "apptypeid", "clientime", "logtype", "urlto", "dt"
    )


def h5_active_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).where(ACTIVE_ROWS).selectExpr("dateline", "uid", f"{ACTIVE_QID} AS qid", "dt")


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(
        "dateline", "clientip", F.col("qid").alias("appqid"), "apptypeid", "clientime", "urlto", "dt"
    )


def app_active_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).where(ACTIVE_ROWS).select("dateline", "uid", "qid", "softname", "softid", "dt")


def sdk_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).where(SDK_ROWS).selectExpr(f"{SDK_QID} AS h5qid")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("text string").parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("line"))


def sql_views() -> str:
    """The body of a WITH clause that defines every derived log for the oracle."""
    formulas = ",\n    ".join(_formulas("varchar"))
    return f"""
ev AS (
  SELECT event_id AS id, user_id AS u, event_type AS t,
    {FIRST_MIDNIGHT} + (event_id % 3) * 86400 + cast(floor(epoch(ts)) AS bigint) % 86400 AS sec
  FROM events),
log AS (
  SELECT id, u, t,
    {formulas}
  FROM ev),
basic_log AS (SELECT dateline, clientip, qid, uid, clientime, dt FROM log),
h5_log AS (SELECT dateline, clientip, qid, uid, apptypeid, clientime, logtype, urlto, dt FROM log),
h5_active_log AS (SELECT dateline, uid, {ACTIVE_QID} AS qid, dt FROM log WHERE {ACTIVE_ROWS}),
app_log AS (SELECT dateline, clientip, qid AS appqid, apptypeid, clientime, urlto, dt FROM log),
app_active_log AS (SELECT dateline, uid, qid, softname, softid, dt FROM log WHERE {ACTIVE_ROWS}),
sdk_list AS (SELECT {SDK_QID} AS h5qid FROM log WHERE {SDK_ROWS})""".strip()
