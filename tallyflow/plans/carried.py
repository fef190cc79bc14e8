"""The day so far, carried from tick to tick instead of counted again from midnight.

A run at a tick reads only the rows since the last tick that was finished. Two tables of the catalog hold the day:

* ``<name>_members``: every (group, dim, member) seen, with the tick that saw it first. It is bucketed by the whole
  tuple, so the rows of ten minutes are dealt to its buckets and the day's members are read in place, unshuffled.
* ``<name>_counts``: the metrics of every group per tick, one partition each. It is written last, so a tick is
  finished when its partition is there.

UV, IP and active users grow by the members not seen before, PV by the rows.

**Lost runs.** The next run starts from the last finished tick, however long ago, or from midnight. **Repeated
runs**, also of an earlier tick, start from the tick before and replace their partition; what a run that died has
left in ``members`` is of ticks later than the last finished one and not looked at, and later on it is true anyway.
**Rows that come after their tick** has been run are not seen; ``forget`` the day and the next run counts it
whole. The same holds for a channel list that changes during a day. ``compact`` writes a day's members as one file
a bucket.

Members are stored as ``=`` and their text, null as the empty text, so that they can be joined by equality.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.timing import ReportWindow
from tallyflow.operators.metrics import METRICS, cells_at
from tallyflow.plans import reports
from tallyflow.plans.reports import TOTAL, Facts
from tallyflow.sinks import tables
from tallyflow.sinks.scratch import stored
from tallyflow.sources import logs

KINDS = {"visitor": "uv", "ip": "ip", "active": "activecnt"}
H5_KEYS, APP_KEYS = ("grain", "qid"), ("grain", "apptypeid", "qid")


def known_member(member: Column) -> Column:
    """A member that is never null: its text behind a sign, or nothing."""
    return F.coalesce(F.concat(F.lit("="), member.cast("string")), F.lit(""))


@dataclass(frozen=True)
class DaySoFar:
    """State of one report: the names of its tables, its keys, and the buckets of its members."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...] = H5_KEYS
    buckets: int = 64

    @property
    def members(self) -> str:
        return f"{self.name}_members"

    @property
    def counts(self) -> str:
        return f"{self.name}_counts"

    @property
    def tuple(self) -> list[str]:
        return [*self.keys, "dim", "member"]

    def create(self) -> None:
        """Create the tables, if they are not there."""
        typed = [f"{c} {'int' if c == 'grain' else 'string'}" for c in self.tuple]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.members} ({', '.join(typed)}, upto bigint, dt string) USING parquet "
            f"PARTITIONED BY (dt) CLUSTERED BY ({', '.join(self.tuple)}) INTO {self.buckets} BUCKETS")
        own = ", ".join(typed[: len(self.keys)] + [f"{m} bigint" for m in METRICS])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.counts} ({own}, dt string, upto bigint) USING parquet PARTITIONED BY (dt, upto)")

    def finished(self, dt: str) -> list[int]:
        """Ticks of a day whose counts are stored, from the catalog alone."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.counts}").where(F.col("partition").startswith(f"dt={dt}/")).collect()  # 150 a day at most
        return sorted(int(r.partition.rsplit("=", 1)[1]) for r in found)

    def step(self, window: ReportWindow) -> "Step":
        """The work of one tick, from the last finished tick before it."""
        before = [t for t in self.finished(window.dt) if t < window.up]
        return Step(self, window, before[-1] if before else None)

    def forget(self, dt: str) -> None:
        """Drop a day's state."""
        if ticks := self.finished(dt):
            slices = ", ".join(f"PARTITION (dt = '{dt}', upto = {t})" for t in ticks)
            self.spark.sql(f"ALTER TABLE {self.counts} DROP IF EXISTS {slices}")
        self.spark.sql(f"ALTER TABLE {self.members} DROP IF EXISTS PARTITION (dt = '{dt}')")

    def compact(self, dt: str) -> None:
        """Each member of a day once, one file a bucket."""
        own = self.spark.table(self.members).where(F.col("dt") == dt).groupBy(*self.tuple, "dt").agg(F.min("upto").alias("upto"))
        tables.insert(stored(own, "members").repartition(self.buckets, *self.tuple), self.members, replace=True)


@dataclass(frozen=True)
class Step:
    state: DaySoFar
    window: ReportWindow
    since: int | None

    def rows(self, log: DataFrame) -> DataFrame:
        """The log's rows that are new at this tick."""
        if self.since is None:
            return logs.in_window(log, self.window)
        after, upto = (F.lit(x).cast("bigint") for x in (self.since, self.window.up))
        return log.where((F.col("dt") == self.window.dt) & (F.col("dateline") > after) & (F.col("dateline") <= upto))

    def seen(self) -> DataFrame:
        """Members of the day up to the last finished tick, each once; no shuffle, as the buckets hold whole tuples."""
        before = self.state.spark.table(self.state.members).where((F.col("dt") == self.window.dt) & (F.col("upto") <= F.lit(self.since).cast("bigint")))
        return before.select(self.state.tuple).distinct()

    def marked(self, spread: Facts) -> DataFrame:
        """New cells, with whether the day has seen their member before."""
        own, upto = self.state.tuple, self.window.up
        cells = reduce(DataFrame.unionByName, [cells_at(p, list(self.state.keys), upto) for p in spread.parts])
        cells = cells.withColumn("member", known_member(F.col("member"))).repartition(self.state.buckets, *own)
        return cells.join(self.seen().withColumn("known", F.lit(True)), own, "left").withColumn("is_new", F.col("known").isNull()).drop("known")

    def advance(self, spread: Facts) -> DataFrame:
        """Stores the state of this tick; gives the metrics of the day so far per group."""
        state, w = self.state, self.window
        cells = stored(self.marked(spread), "cells")
        at = {"dt": F.lit(w.dt), "upto": F.lit(w.up).cast("bigint")}
        tables.insert(cells.where("is_new").select(state.tuple).withColumns(at), state.members)

        is_dim = lambda d: F.col("dim") == d
        rows = lambda c: F.coalesce(F.sum(F.when(is_dim("visitor"), F.col(c))), F.lit(0))
        new = cells.groupBy(*state.keys).agg(
            rows("n").alias("pv"),
            *[F.count_if(is_dim(d) & F.col("is_new")).alias(m) for d, m in KINDS.items()],
            rows("n10").alias("incr_pv"),
            *[F.count_if(is_dim(d) & F.col("recent")).alias(f"incr_{m}") for d, m in KINDS.items()],
        )
        old = state.spark.table(state.counts).where((F.col("dt") == w.dt) & (F.col("upto") == F.lit(self.since).cast("bigint")))
        parts = [new, old.select(*state.keys, "pv", *KINDS.values())]
        if spread.always_total:
            parts.append(reports.total_seed(state.spark))
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        counts = every.groupBy(*state.keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in METRICS])
        tables.insert(counts.withColumns(at), state.counts, replace=True)
        return self.metrics()

    def metrics(self) -> DataFrame:
        """The stored metrics of this tick."""
        w = self.window
        own = self.state.spark.table(self.state.counts).where((F.col("dt") == w.dt) & (F.col("upto") == F.lit(w.up).cast("bigint")))
        return own.where((F.col("grain") == TOTAL) | (F.col("uv") > 0)).select(*self.state.keys, *METRICS)


def h5_full_report(state: DaySoFar, log: DataFrame, active_log: DataFrame, sdk: DataFrame, window: ReportWindow) -> DataFrame:
    """The full H5 report, from the state and the rows since its last tick."""
    step = state.step(window)
    spread = reports.h5_full_facts(logs.h5_rules(step.rows(log)), logs.h5_active_rules(step.rows(active_log)), sdk)
    return reports.h5_records(step.advance(spread), F.lit(window.dt), F.lit(window.up))


def app_report(state: DaySoFar, log: DataFrame, window: ReportWindow) -> DataFrame:
    """The app report, from the state and the rows since its last tick."""
    step = state.step(window)
    metrics = step.advance(reports.app_facts(logs.app_rules(step.rows(log))))
    return reports.app_records(metrics, F.lit(window.dt), F.lit(window.up), clean.APP_TOTAL_WIDTH)
