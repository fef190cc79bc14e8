"""Ticks, days and report windows.

A report runs for a tick. Its window is the day so far, ``[low, up]`` in epoch seconds, where
``up`` is the tick floored to ten minutes. In the first ten minutes after midnight the window is
the whole day before. The time zone is explicit: an argument on the driver side, the session time
zone in Column expressions.
"""

from datetime import datetime, timedelta
from typing import NamedTuple
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

TICK_SECONDS = 600


class ReportWindow(NamedTuple):
    dt: str
    low: int
    up: int


def report_window(tick: str, tz: str = "UTC") -> ReportWindow:
    """Window of the report run at ``tick`` (``yyyyMMddHHmmss``, wall clock of ``tz``)."""
    at = datetime.strptime(tick, "%Y%m%d%H%M%S").replace(tzinfo=ZoneInfo(tz))
    floored = at.replace(minute=at.minute - at.minute % 10, second=0)
    midnight = at.replace(hour=0, minute=0, second=0)
    up, low = int(floored.timestamp()), int(midnight.timestamp())
    if up == low:
        before = midnight - timedelta(days=1)  # on the wall clock, so days of 23 or 25 hours are whole
        return ReportWindow(before.strftime("%Y%m%d"), int(before.timestamp()), up)
    return ReportWindow(midnight.strftime("%Y%m%d"), low, up)


def session_report_window(spark: SparkSession, tick: str) -> ReportWindow:
    """Window in the session's time zone, which the records' times are written in."""
    return report_window(tick, spark.conf.get("spark.sql.session.timeZone"))


def report_window_columns(epoch: Column) -> dict[str, Column]:
    """``dt``, ``low`` and ``up`` of the report run at ``epoch``, one report per row."""
    up, low = floor_ten_minutes(epoch), midnight(epoch)
    whole_day = up == low
    day = F.timestamp_seconds(epoch)
    return {
        "dt": F.when(whole_day, previous_day_key(day)).otherwise(day_key(day)),
        "low": F.when(whole_day, F.unix_timestamp(F.date_sub(day, 1).cast("timestamp"))).otherwise(low),
        "up": up,
    }


def floor_ten_minutes(epoch: Column) -> Column:
    """The wall clock of the session floored to ten minutes; zones may be off by other than ten minutes."""
    at = F.timestamp_seconds(epoch)
    return epoch - F.minute(at) % 10 * 60 - F.second(at)


def midnight(epoch: Column) -> Column:
    """Epoch second of the day's start."""
    return F.unix_timestamp(F.date_trunc("DAY", F.timestamp_seconds(epoch)))


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def previous_day_key(ts: Column) -> Column:
    return F.date_format(F.date_sub(ts, 1), "yyyyMMdd")


def parse_datetime(c: Column) -> Column:
    return F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss")


def format_datetime(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def format_time(c: Column) -> Column:
    """``yyyyMMddHHmmss`` to ``yyyy-MM-dd HH:mm:ss``, by position and without validation."""
    part = lambda start, n: F.substring(c, start, n)
    return F.concat(
        part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "),
        part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2),
    )


def tick_text(epoch: Column) -> Column:
    """A tick as ``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    return format_datetime(F.timestamp_seconds(epoch))
