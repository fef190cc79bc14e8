"""Scans of the traffic logs.

Each takes the log as a DataFrame (a table or partitioned files) and gives rows of
``dt, dateline, clientip, qid, apptypeid, uid``, as far as the source has them, ready for the
metric core. ``*_rules`` is the scan without its window, for jobs over many ticks. Filters are written on the raw columns wherever the rule allows, so the day predicate prunes
partitions and the range reaches the file source.

A null channel becomes ``null`` before the charset filter, in every scan.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.functions import clean
from tallyflow.functions.timing import TICK_SECONDS, ReportWindow


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def read_log(spark: SparkSession, name: str, schema: T.StructType, days: list[str] | None = None) -> DataFrame:
    """A log by table name, or by path when the name has a slash.

    The schema keeps ``dt`` a string where it is a folder name and would be read as a number. With
    ``days``, only the folders of those days are listed; a day without a folder is an empty one, but a log that is
    not there at all is an error.
    """
    if "/" not in name:
        return spark.table(name).select([f.name for f in schema])
    if days is None:
        return spark.read.schema(schema).parquet(name)
    there = [d for d in days if _is_there(spark, f"{name}/dt={d}", schema)]
    if there:
        return spark.read.schema(schema).option("basePath", name).parquet(*[f"{name}/dt={d}" for d in there])
    spark.read.schema(schema).parquet(name)  # an error if there is no log
    return spark.createDataFrame([], schema)


def _is_there(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def in_window(log: DataFrame, window: ReportWindow) -> DataFrame:
    return log.where((F.col("dt") == window.dt) & clean.between(F.col("dateline"), window.low, window.up))


def sliced_day(log: DataFrame, dt: str, midnight: int, now: int) -> DataFrame:
    """The complete ten-minute slices of a day, each row with its ``slot``; nulls as text.

    Slices are ``[lo, hi)``; the one still running at ``now`` is left out.
    """
    complete = (now - midnight) // TICK_SECONDS
    offset = F.col("dateline") - F.lit(midnight).cast("bigint")
    return log.where(
        (F.col("dt") == dt)
        & (F.col("dateline") >= F.lit(midnight).cast("bigint"))
        & (F.col("dateline") < F.lit(midnight + complete * TICK_SECONDS).cast("bigint"))
    ).select(
        F.floor(offset / TICK_SECONDS).cast("int").alias("slot"),
        "dateline",
        "clientip",
        clean.null_text(F.col("qid")).alias("qid"),
        clean.null_text(F.col("uid")).alias("uid"),
    )


def day_range(log: DataFrame, window: ReportWindow) -> DataFrame:
    return basic_rules(in_window(log, window))


def basic_rules(log: DataFrame) -> DataFrame:
    """Basic log; the device is the visitor on the ``huitt`` channel."""
    uid = clean.visitor_exact(F.col("qid"), F.col("uid"), F.col("clientime"))
    return log.select(*_when(log), "clientip", "qid", uid.alias("uid"))


def h5_clean(log: DataFrame, window: ReportWindow) -> DataFrame:
    return h5_rules(in_window(log, window))


def h5_rules(log: DataFrame) -> DataFrame:
    """Log-type, app-exclusion and charset rules, and the device as visitor on ``huitt`` channels."""
    qid = clean.null_text(F.col("qid"))
    return log.where(
        clean.keeps_log_type(F.col("logtype"), F.col("urlto"))
        & clean.keeps_null_channel(F.col("qid"), F.col("apptypeid"))
        & clean.has_channel_charset(qid)
    ).select(
        *_when(log),
        "clientip",
        qid.alias("qid"),
        clean.visitor_contains(qid, F.col("uid"), F.col("clientime")).alias("uid"),
    )


def h5_active(log: DataFrame, window: ReportWindow) -> DataFrame:
    return h5_active_rules(in_window(log, window))


def h5_active_rules(log: DataFrame) -> DataFrame:
    qid = clean.null_text(F.col("qid"))
    return log.where(clean.has_channel_charset(qid)).select(
        *_when(log), F.lit(None).cast("string").alias("clientip"), qid.alias("qid"), "uid"
    )


def app(log: DataFrame, window: ReportWindow) -> DataFrame:
    return app_rules(in_window(log, window))


def app_rules(log: DataFrame) -> DataFrame:
    """App log: rows with a device and a TT app; the charset is checked before dates are trimmed."""
    qid = clean.null_text(F.col("appqid"))
    return log.where(
        clean.has_device(F.col("clientime"))
        & clean.is_tt_app(F.col("apptypeid"))
        & clean.has_channel_charset(qid)
    ).select(*_when(log), "clientip", qid.alias("qid"), "apptypeid", F.col("clientime").alias("uid"))


def app_active(log: DataFrame, window: ReportWindow) -> DataFrame:
    return app_active_rules(in_window(log, window))


def app_active_rules(log: DataFrame) -> DataFrame:
    """App activity: the app comes from the software fields; dates go before the charset check."""
    qid = clean.normalise_channel(clean.null_text(F.col("qid")))
    return log.select(
        *_when(log),
        F.lit(None).cast("string").alias("clientip"),
        qid.alias("qid"),
        clean.app_from_software(F.col("softname"), F.col("softid")).alias("apptypeid"),
        "uid",
    ).where(clean.has_channel_charset(F.col("qid")))


def app_news(log: DataFrame, window: ReportWindow) -> DataFrame:
    return app_news_rules(in_window(log, window))


def app_news_rules(log: DataFrame) -> DataFrame:
    """News rows of the app log: by url, with a device that is not blank."""
    qid = clean.normalise_channel(clean.null_text(F.col("appqid")))
    return log.where(
        clean.is_news_url(F.col("urlto"))
        & clean.has_device_trimmed(F.col("clientime"))
        & clean.is_not_huitt(F.col("apptypeid"))
    ).select(
        *_when(log),
        "clientip",
        qid.alias("qid"),
        F.upper(clean.null_text(F.col("apptypeid"))).alias("apptypeid"),
        F.col("clientime").alias("uid"),
    ).where(clean.has_channel_charset(F.col("qid")))


def _when(log: DataFrame) -> list[str]:
    """Columns that say when: the second, and the day and slot where the log has them."""
    return [c for c in ("dt", "slot", "dateline") if c in log.columns]
