"""Reports from stored pairs: the log is spread and counted once, reports of any tick read the counts.

A log's rows become cells per (slot, group, dim, member), stored in a table of the catalog that is bucketed by
member. Traffic and activity have a table each, with the same buckets. A report groups the slots it covers by
(group, dim, member); as a member's cells are all in one bucket, that takes no shuffle, and only one partial row per
group and task is sent on. The logs are not read again, nor are rows spread again.

A member in very many rows (the null visitor) has one cell per slot and group, so a bucket does not grow with a
member's rows. Slot 0 holds the rows exactly at midnight: they count for the day so far and for no tick.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions.timing import TICK_SECONDS, ReportWindow
from tallyflow.operators.metrics import cell_metrics
from tallyflow.plans import backfill, reports
from tallyflow.plans.carried import known_member
from tallyflow.sinks import tables
from tallyflow.sources import logs

BUCKETS = 64


def create(spark: SparkSession, name: str, keys: tuple[str, ...] = ("grain", "qid"), buckets: int = BUCKETS) -> None:
    """Create a table of pairs, if it is not there."""
    typed = ", ".join(f"{c} {'int' if c == 'grain' else 'string'}" for c in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (slot int, {typed}, dim string, member string, n bigint, dt string) USING parquet "
        f"PARTITIONED BY (dt) CLUSTERED BY (member) INTO {buckets} BUCKETS")


def store(spread: DataFrame, keys: tuple[str, ...], name: str, buckets: int = BUCKETS) -> None:
    """Puts the cells of whole days, spread rows with their slot, in place of what the table has of these days."""
    own = spread.withColumn("member", known_member(F.col("member"))).groupBy("dt", "slot", *keys, "dim", "member").agg(F.sum("hits").alias("n"))
    tables.insert(own.repartition(buckets, "member"), name, replace=True)


def cells(spark: SparkSession, name: str, keys: tuple[str, ...], window: ReportWindow) -> DataFrame:
    """One row per (group, dim, member) of the day so far."""
    tick = (window.up - window.low) // TICK_SECONDS
    own, recent = spark.table(name).where((F.col("dt") == window.dt) & (F.col("slot") <= tick)), F.col("slot") == tick
    return own.groupBy(*keys, "dim", "member").agg(
        F.sum("n").alias("n"), F.sum(F.when(recent, F.col("n")).otherwise(0)).alias("n10"), F.max(recent).alias("recent"))


def store_h5(log: DataFrame, active_log: DataFrame, sdk: DataFrame, days: list[str], traffic: str, activity: str, buckets: int = BUCKETS) -> None:
    """The pairs of the full H5 report of whole days, as the channel list is now."""
    spread = reports.h5_full_facts(logs.h5_rules(backfill.slotted(log, days)), logs.h5_active_rules(backfill.slotted(active_log, days)), sdk)
    for part, name in zip(spread.parts, (traffic, activity)):
        store(part, spread.keys, name, buckets)


def h5_full_report(spark: SparkSession, traffic: str, activity: str, window: ReportWindow) -> DataFrame:
    """The full H5 report at a tick of a stored day."""
    keys = ("grain", "qid")
    parts = [cells(spark, name, keys, window) for name in (traffic, activity)]
    every = reduce(DataFrame.unionByName, parts).unionByName(reports.total_seed(spark), allowMissingColumns=True)
    metrics = every.groupBy(*keys).agg(*cell_metrics(F.col("n"), F.col("n10"), F.col("recent")))
    return reports.h5_records(metrics.where((F.col("grain") == reports.TOTAL) | (F.col("uv") > 0)), F.lit(window.dt), F.lit(window.up))
