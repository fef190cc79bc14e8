"""Metrics tables, by path or by their name in the catalog: a slice is one tick of one day, stored as one partition.

A report is staged into its slice, then published: duplicate keys of the slice are merged by
maximum and the slice of the final table is replaced. Both steps replace whole slices, so running
a report again changes nothing. All writes are distributed; no row passes through the driver.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow import schema
from tallyflow.functions import clean
from tallyflow.sinks.scratch import scratch_path, stored  # noqa: F401


@dataclass(frozen=True)
class MetricsTable:
    """Shape of a metrics table: its columns, its key and the partition columns of a slice."""

    columns: T.StructType
    keys: list[str]
    slice: list[str]

    @property
    def values(self) -> list[str]:
        return [f.name for f in self.columns if f.name not in self.keys]

    def at(self, dt: str, tick: int) -> Column:
        day, time = self.slice
        return (F.col(day) == int(dt)) & (F.col(time) == tick)

    def slice_path(self, path: str, dt: str, tick: int) -> str:
        day, time = self.slice
        return f"{path}/{day}={int(dt)}/{time}={tick}"


H5 = MetricsTable(schema.H5_METRICS, schema.H5_KEYS, schema.H5_SLICE)
APP = MetricsTable(schema.APP_METRICS, schema.APP_KEYS, schema.APP_SLICE)


def is_path(name: str) -> bool:
    """A name with a slash is a path, any other one a table of the catalog."""
    return "/" in name


def create(spark: SparkSession, name: str, table: MetricsTable) -> None:
    """Create a metrics table in the catalog, if it is not there. Its slices are partitions, so they come last."""
    own = [f for f in table.columns if f.name not in table.slice] + [table.columns[c] for c in table.slice]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(table.slice)})")


def read_table(spark: SparkSession, name: str, table: MetricsTable) -> DataFrame:
    rows = spark.read.schema(table.columns).parquet(name) if is_path(name) else spark.table(name)
    return schema.conform(rows, table.columns)


def read_slice(spark: SparkSession, name: str, table: MetricsTable, dt: str, tick: int) -> DataFrame:
    """One slice. Empty where there is none.

    Of a path its own folder is read, and no other one listed; of a table the one partition that the catalog names.
    """
    if not is_path(name):
        return schema.conform(spark.table(name).where(table.at(dt, tick)), table.columns)
    try:
        rows = spark.read.schema(table.columns).option("basePath", name).parquet(table.slice_path(name, dt, tick))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table.columns)
    return schema.conform(rows, table.columns)


def append(metrics: DataFrame, name: str, table: MetricsTable) -> None:
    """Add rows to their slices and keep what is there."""
    if is_path(name):
        metrics.write.mode("append").partitionBy(*table.slice).parquet(name)
    else:
        insert(metrics, name)


def insert(rows: DataFrame, name: str, replace: bool = False) -> None:
    """Insert into a table by the names of its columns; with ``replace``, in place of the partitions that get rows."""
    spark = rows.sparkSession
    own = rows.select(spark.table(name).columns)
    if not replace:
        own.write.insertInto(name)
        return
    # tables of the catalog take this from the session, not from the writer
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        own.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def overwrite_slices(metrics: DataFrame, name: str, table: MetricsTable) -> int:
    """Replace every slice that ``metrics`` has rows for; gives the number of rows written."""
    written = Observation()
    counted = metrics.observe(written, F.count(F.lit(1)).alias("n"))
    if is_path(name):
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*table.slice).parquet(name)
    else:
        insert(counted, name, replace=True)
    return written.get["n"]


def overwrite_slice(metrics: DataFrame, name: str, table: MetricsTable, dt: str, tick: int) -> int:
    """Replace one slice, by nothing if ``metrics`` is empty."""
    n = overwrite_slices(metrics, name, table)
    if n == 0:  # a dynamic overwrite leaves slices alone that get no rows
        _clear(metrics.sparkSession, name, table, int(dt), tick)
    return n


def _clear(spark: SparkSession, name: str, table: MetricsTable, dt: int, tick: int) -> None:
    if is_path(name):
        spark.createDataFrame([], table.columns).drop(*table.slice).write.mode("overwrite").parquet(table.slice_path(name, str(dt), tick))
    else:
        day, time = table.slice
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({day} = {dt}, {time} = {tick})")


def overwrite_days(metrics: DataFrame, name: str, table: MetricsTable, days: list[str]) -> int:
    """Replace all slices of ``days``; gives the number of rows written.

    One dynamic overwrite, then the slices of those days that have got no rows are emptied. Slices are known from
    partition values alone: a day has 150 ticks at most.
    """
    day, time = table.slice
    own = F.col(day).isin([int(d) for d in days])
    rows = stored(metrics.where(own), "days")
    n = overwrite_slices(rebalanced(rows, table), name, table)
    slices = lambda df: {(r[0], r[1]) for r in df.where(own).select(day, time).distinct().collect()}
    try:
        there = slices(read_table(rows.sparkSession, name, table))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        there = set()
    for dt, tick in sorted(there - slices(rows)):
        _clear(rows.sparkSession, name, table, dt, tick)
    return n


def rebalanced(metrics: DataFrame, table: MetricsTable) -> DataFrame:
    """Group the rows of a slice into few files; adaptive execution splits slices that are large."""
    return metrics.hint("rebalance", *table.slice)


def truncate(spark: SparkSession, name: str, table: MetricsTable) -> None:
    """Empty a table."""
    if is_path(name):
        spark.createDataFrame([], table.columns).write.mode("overwrite").parquet(name)
    else:
        spark.sql(f"TRUNCATE TABLE {name}")


def max_merge(staged: DataFrame, table: MetricsTable) -> DataFrame:
    """One row per key, with the largest value of each metric."""
    merged = staged.groupBy(*table.keys).agg(*[F.max(c).alias(c) for c in table.values])
    return schema.conform(merged, table.columns)


def publish(spark: SparkSession, staging: str, final: str, table: MetricsTable, dt: str, tick: int) -> int:
    """Merge a staged slice and put it in place of the final table's slice."""
    merged = max_merge(read_slice(spark, staging, table, dt, tick), table)
    return overwrite_slice(merged, final, table, dt, tick)


def strip_quotes(metrics: DataFrame) -> DataFrame:
    """Channels without single quotes, as an older loader stored them."""
    return metrics.withColumn("qid", F.replace("qid", F.lit("'"), F.lit("")))


def create_log(spark: SparkSession, name: str, columns: T.StructType) -> None:
    """Create a log in the catalog, partitioned by day, if it is not there."""
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({own}) USING parquet PARTITIONED BY (dt)")


def append_log_day(log: DataFrame, name: str) -> None:
    """Add log rows to their day partitions, of a path or a table."""
    if is_path(name):
        log.write.mode("append").partitionBy("dt").parquet(name)
    else:
        insert(log, name)


def total_rows(metrics: DataFrame) -> DataFrame:
    """The total row of an H5 report, the total rows of an app report."""
    return metrics.where(F.col("qid") == clean.TOTAL)


def show_total(metrics: DataFrame) -> None:
    """Print the total row."""
    total_rows(metrics).show(truncate=False)
