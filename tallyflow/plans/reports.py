"""The reports: which rows, which groups, which labels.

Each report is a ``*_facts`` function, log rows spread over groups and members, and a report
function that evaluates the facts at one tick. ``plans.backfill`` evaluates the same facts at every
tick of a day.

Labels are clipped after aggregation, so two long channels may come out under one label. They stay
apart here and are merged by maximum on publishing.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import schema
from tallyflow.functions import clean
from tallyflow.functions.timing import ReportWindow, tick_text
from tallyflow.operators import counts, rollups
from tallyflow.operators.metrics import facts, joined_metrics, metrics_at
from tallyflow.sources import logs

DETAIL, TOTAL = 0, 1


@dataclass(frozen=True)
class Facts:
    """Spread rows, one frame per log, with the keys that tell their groups apart.

    ``grain`` is DETAIL for a channel or rollup and TOTAL for the total row, so a channel that is
    itself called ``total`` stays apart until it is published. ``always_total`` asks for a total
    row even where there are no log rows.
    """

    parts: list[DataFrame]
    keys: tuple[str, ...]
    always_total: bool = False


# ---- groups -----------------------------------------------------------------------------

def _group(grain: int, qid: Column, hits: Column | int = 1, app: Column | None = None) -> Column:
    fields = [F.lit(grain).cast("int").alias("grain")]
    if app is not None:
        fields.append(app.alias("apptypeid"))
    hits = hits if isinstance(hits, Column) else F.lit(hits)
    return F.struct(*fields, qid.alias("qid"), hits.cast("int").alias("hits"))


def _rollup_group(label: Column) -> Column:
    return F.when(label.isNotNull(), _group(DETAIL, label))


def _total_hits(qid: Column) -> Column:
    """A raw channel named like a rollup is left out of the total PV (but not UV and IP)."""
    return F.when(qid.isin(clean.SDK_TOTAL, clean.MINI_PROGRAM_TOTAL), 0).otherwise(1)


def _app_groups(app: Column, qid: Column) -> list[Column]:
    return [_group(DETAIL, qid, app=app), _group(TOTAL, F.lit(clean.TOTAL), app=app)]


def _has_traffic() -> Column:
    return (F.col("grain") == TOTAL) | (F.col("uv") > 0)


# ---- H5 ---------------------------------------------------------------------------------

def h5_basic_facts(rows: DataFrame) -> Facts:
    qid = clean.trim_special(F.lower(clean.null_text(F.col("qid"))))
    groups = [_group(DETAIL, qid), _group(TOTAL, F.lit(clean.TOTAL))]
    members = {"visitor": clean.null_text(F.col("uid")), "ip": clean.null_text(F.col("clientip"))}
    return Facts([facts(rows, groups, members)], ("grain", "qid"), always_total=True)


def h5_full_facts(rows: DataFrame, active: DataFrame, sdk: DataFrame) -> Facts:
    """Traffic and activity spread over channels, rollups and the total.

    Activity is a third kind of member on the same keys rather than another aggregate to join;
    channels with activity but no traffic are dropped after the grouping.
    """
    raw, qid = F.col("qid"), F.lower("qid")
    groups = [
        _group(DETAIL, qid),
        *[_rollup_group(g) for g in rollups.rollup_groups(F.col("in_sdk"), raw)],
        _group(TOTAL, F.lit(clean.TOTAL), _total_hits(qid)),
    ]
    traffic = facts(
        rollups.flag_sdk(rows, sdk), groups, {"visitor": F.col("uid"), "ip": F.col("clientip")}
    )
    activity = facts(rollups.flag_sdk(active, sdk), groups, {"active": F.col("uid")})
    return Facts([traffic, activity], ("grain", "qid"), always_total=True)


def mini_program_facts(rows: DataFrame, active: DataFrame) -> Facts:
    groups = [_group(DETAIL, F.lit(clean.MINI_PROGRAM_TOTAL))]
    traffic = facts(
        rollups.mini_program_rows(rows), groups, {"visitor": F.col("uid"), "ip": F.col("clientip")}
    )
    activity = facts(rollups.mini_program_rows(active), groups, {"active": F.col("uid")})
    return Facts([traffic, activity], ("grain", "qid"))


# ---- app --------------------------------------------------------------------------------

def app_facts(rows: DataFrame) -> Facts:
    """Per app and channel, and per app. Dates are trimmed once more than the scan did."""
    groups = _app_groups(F.upper(clean.null_text(F.col("apptypeid"))), F.lower(clean.trim_date(F.col("qid"))))
    spread = facts(rows, groups, {"visitor": F.col("uid"), "ip": F.col("clientip")})
    return Facts([spread], ("grain", "apptypeid", "qid"))


def app_active_facts(rows: DataFrame) -> Facts:
    """As ``app_facts``, visitors only; activity has no PV."""
    app, qid = F.upper(clean.null_text(F.col("apptypeid"))), F.lower(clean.trim_date(F.col("qid")))
    groups = [_group(DETAIL, qid, 0, app), _group(TOTAL, F.lit(clean.TOTAL), 0, app)]
    return Facts([facts(rows, groups, {"visitor": F.col("uid")})], ("grain", "apptypeid", "qid"))


# ---- records ----------------------------------------------------------------------------

def total_seed(spark: SparkSession) -> DataFrame:
    """The key of the H5 total row, without any member."""
    return spark.range(0, 1, 1, 1).select(F.lit(TOTAL).cast("int").alias("grain"), F.lit(clean.TOTAL).alias("qid"))


def evaluate(spread: Facts, up: int) -> DataFrame:
    seed = total_seed(spread.parts[0].sparkSession) if spread.always_total else None
    return metrics_at(spread.parts, list(spread.keys), up, seed).where(_has_traffic())


def h5_records(metrics: DataFrame, dt: Column, up: Column) -> DataFrame:
    return schema.conform(
        metrics.withColumns({
            "dt": dt, "currenttime": up, "qid": clean.clip(F.col("qid"), clean.QID_WIDTH),
        }),
        schema.H5_METRICS,
    )


def app_records(metrics: DataFrame, dt: Column, up: Column, total_width: int) -> DataFrame:
    width = F.when(F.col("grain") == TOTAL, total_width).otherwise(clean.APP_WIDTH)
    return schema.conform(
        metrics.withColumns({
            "dt": dt,
            "logtime": up,
            "currenttime": tick_text(up),
            "qid": clean.clip(F.col("qid"), clean.QID_WIDTH),
            "apptypeid": F.substring(F.col("apptypeid"), F.lit(1), width),
        }),
        schema.APP_METRICS,
    )


def _h5_report(spread: Facts, window: ReportWindow) -> DataFrame:
    return h5_records(evaluate(spread, window.up), F.lit(window.dt), F.lit(window.up))


def _app_report(spread: Facts, window: ReportWindow, total_width: int) -> DataFrame:
    return app_records(evaluate(spread, window.up), F.lit(window.dt), F.lit(window.up), total_width)


# ---- reports ----------------------------------------------------------------------------

def sliced_day_report(log: DataFrame, dt: str, midnight: int, now: int) -> DataFrame:
    """Visitors summed over the complete slices of the day per channel, and one row of distinct visitors overall."""
    return counts.sliced_uv(logs.sliced_day(log, dt, midnight, now))


def h5_basic_report(log: DataFrame, window: ReportWindow) -> DataFrame:
    """PV, UV and IP per channel with the total row; activity is 0."""
    return _h5_report(h5_basic_facts(logs.day_range(log, window)), window)


def h5_full_report(log: DataFrame, active_log: DataFrame, sdk: DataFrame, window: ReportWindow) -> DataFrame:
    """PV, UV, IP and active users per channel and rollup with the total row."""
    spread = h5_full_facts(logs.h5_clean(log, window), logs.h5_active(active_log, window), sdk)
    return _h5_report(spread, window)


def mini_program_report(log: DataFrame, active_log: DataFrame, window: ReportWindow) -> DataFrame:
    """The mini-program total alone; appended to a slice that is already staged."""
    spread = mini_program_facts(logs.h5_clean(log, window), logs.h5_active(active_log, window))
    return _h5_report(spread, window)


def app_report(log: DataFrame, window: ReportWindow) -> DataFrame:
    """PV, UV and IP per app and channel, with a total row per app."""
    return _app_report(app_facts(logs.app(log, window)), window, clean.APP_TOTAL_WIDTH)


def app_active_report(active_log: DataFrame, window: ReportWindow) -> DataFrame:
    """Active users per app and channel in the UV columns, with a total row per app; the rest is 0."""
    return _app_report(app_active_facts(logs.app_active(active_log, window)), window, clean.APP_WIDTH)


def news_report(log: DataFrame, window: ReportWindow) -> DataFrame:
    """As the app report, for news urls."""
    return _app_report(app_facts(logs.app_news(log, window)), window, clean.APP_TOTAL_WIDTH)


# ---- the join form ----------------------------------------------------------------------

def h5_basic_joined(log: DataFrame, window: ReportWindow) -> DataFrame:
    """Detail rows of the basic report as a left join; the form to check the core against."""
    rows = logs.day_range(log, window).select(
        "dateline",
        clean.trim_special(F.lower(clean.null_text(F.col("qid")))).alias("qid"),
        clean.null_text(F.col("uid")).alias("uid"),
        clean.null_text(F.col("clientip")).alias("clientip"),
    )
    joined = joined_metrics(rows, ["qid"], "uid", "clientip", window.up)
    joined = joined.withColumns({"activecnt": F.lit(0), "incr_activecnt": F.lit(0)})
    return h5_records(joined, F.lit(window.dt), F.lit(window.up))


def h5_full_joined(log: DataFrame, active_log: DataFrame, sdk: DataFrame, window: ReportWindow) -> DataFrame:
    """Detail and rollup rows of the full report as exploded rows and two left joins: three log scans."""
    grouped = lambda df: rollups.with_rollups(rollups.flag_sdk(df, sdk)).withColumn("qid", F.lower("qid"))
    rows, active = grouped(logs.h5_clean(log, window)), grouped(logs.h5_active(active_log, window))
    joined = joined_metrics(rows, ["qid"], "uid", "clientip", window.up, active)
    return h5_records(joined, F.lit(window.dt), F.lit(window.up))
