"""All ticks of whole days in one job, instead of one report run per ten minutes.

Rows get the tick whose last ten minutes they fall in; rows exactly at midnight get slot 0, which
counts for the day so far but belongs to no tick. A member adds to the cumulative count in the first
slot it is seen in, so the day so far is a running sum over one row per tick and group. The last
tick is midnight of the next day and covers the whole day, as the report run then does.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.timing import TICK_SECONDS
from tallyflow.plans import reports
from tallyflow.plans.reports import TOTAL, Facts
from tallyflow.sources import logs


def _midnight(days_on: int = 0) -> Column:
    """Epoch second at which the day of ``dt``, or one so many days later, starts."""
    part = lambda start, n: F.substring("dt", start, n).cast("int")
    day = F.make_date(part(1, 4), part(5, 2), part(7, 2))
    return F.unix_timestamp(F.date_add(day, days_on).cast("timestamp"))


def _day_seconds() -> Column:
    """Length of the day of ``dt``: 23 and 25 hours where clocks change."""
    return _midnight(1) - _midnight()


def slotted(log: DataFrame, days: list[str]) -> DataFrame:
    """Log rows of ``days`` with their ``slot``, once per row, before rows are spread."""
    offset = F.col("dateline") - _midnight()
    return log.where(F.col("dt").isin(days) & offset.between(0, _day_seconds())).withColumn(
        "slot", F.ceil(offset / TICK_SECONDS).cast("int")
    )


def slot_cells(spread: DataFrame, keys: list[str]) -> DataFrame:
    """Two kinds of rows per (day, keys, dim, member), from one scan and one shuffle.

    With ``is_new`` false: one per slot the member was seen in, ``n`` rows. With ``is_new`` true:
    one in the member's first slot of the day. A window over each member's slots would say the same
    but needs a second shuffle and a sort of every cell.
    """
    member = [F.col(c) for c in ("dt", *keys, "dim", "member")]
    slot = F.col("slot")
    cells = spread.groupingSets([[*member, slot], member], *member, slot).agg(
        F.sum("hits").alias("n"), F.min(slot).alias("first_slot"), F.grouping(slot).alias("is_first")
    )
    return cells.select(
        *member, F.col("first_slot").alias("slot"), "n", (F.col("is_first") == 1).alias("is_new")
    )


def tick_metrics(spread: Facts, days: list[str]) -> DataFrame:
    """Metrics per (day, tick, keys) for every tick from a group's first traffic on."""
    keys = list(spread.keys)
    cells = reduce(DataFrame.unionByName, [slot_cells(p, keys) for p in spread.parts])
    if spread.always_total:
        seed = reports.total_seed(cells.sparkSession).select(
            "*", F.explode(F.array(*[F.lit(d) for d in days])).alias("dt"), F.lit(0).alias("slot")
        )
        cells = cells.unionByName(seed, allowMissingColumns=True)

    members = {"uv": "visitor", "ip": "ip", "activecnt": "active"}
    seen = lambda d: (F.col("dim") == d) & ~F.col("is_new")
    new = lambda d: (F.col("dim") == d) & F.col("is_new")
    per_slot = cells.groupBy("dt", *keys, "slot").agg(
        F.coalesce(F.sum(F.when(seen("visitor"), F.col("n"))), F.lit(0)).alias("in_pv"),
        *[F.count_if(seen(d)).alias(f"in_{m}") for m, d in members.items()],
        *[F.count_if(new(d)).alias(f"new_{m}") for m, d in members.items()],
    )

    so_far = Window.partitionBy("dt", *keys).orderBy("slot")
    running = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = per_slot.select(
        "*",
        F.sum("in_pv").over(running).alias("pv"),
        *[F.sum(f"new_{m}").over(running).alias(m) for m in members],
        F.coalesce(F.lead("slot").over(so_far), (_day_seconds() / TICK_SECONDS).cast("int") + 1).alias("next_slot"),
    )
    # a slot's sums hold until the group's next slot; its own rows count only at its own tick
    first, last = F.greatest(F.col("slot"), F.lit(1)), F.col("next_slot") - 1
    ticks = summed.where(last >= first).select("*", F.explode(F.sequence(first, last)).alias("tick"))
    own = F.col("tick") == F.col("slot")
    return ticks.where((F.col("grain") == TOTAL) | (F.col("uv") > 0)).select(
        "dt",
        (_midnight() + F.col("tick") * TICK_SECONDS).alias("up"),
        *keys,
        "pv",
        *members,
        *[F.when(own, F.col(f"in_{m}")).otherwise(0).alias(f"incr_{m}") for m in ("pv", *members)],
    )


def h5_full_backfill(log: DataFrame, active_log: DataFrame, sdk: DataFrame, days: list[str]) -> DataFrame:
    """The full H5 report at every tick of ``days``."""
    spread = reports.h5_full_facts(
        logs.h5_rules(slotted(log, days)), logs.h5_active_rules(slotted(active_log, days)), sdk
    )
    return reports.h5_records(tick_metrics(spread, days), F.col("dt"), F.col("up"))


def h5_basic_backfill(log: DataFrame, days: list[str]) -> DataFrame:
    """The basic H5 report at every tick of ``days``."""
    metrics = tick_metrics(reports.h5_basic_facts(logs.basic_rules(slotted(log, days))), days)
    return reports.h5_records(
        metrics.withColumns({"activecnt": F.lit(0), "incr_activecnt": F.lit(0)}), F.col("dt"), F.col("up")
    )


def _app_backfill(spread: Facts, days: list[str], total_width: int) -> DataFrame:
    return reports.app_records(tick_metrics(spread, days), F.col("dt"), F.col("up"), total_width)


def app_backfill(log: DataFrame, days: list[str]) -> DataFrame:
    """The app report at every tick of ``days``."""
    return _app_backfill(reports.app_facts(logs.app_rules(slotted(log, days))), days, clean.APP_TOTAL_WIDTH)


def news_backfill(log: DataFrame, days: list[str]) -> DataFrame:
    """The news report at every tick of ``days``."""
    return _app_backfill(reports.app_facts(logs.app_news_rules(slotted(log, days))), days, clean.APP_TOTAL_WIDTH)


def app_active_backfill(active_log: DataFrame, days: list[str]) -> DataFrame:
    """The app activity report at every tick of ``days``."""
    spread = reports.app_active_facts(logs.app_active_rules(slotted(active_log, days)))
    return _app_backfill(spread, days, clean.APP_WIDTH)
