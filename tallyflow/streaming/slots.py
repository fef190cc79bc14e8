"""Ten-minute slots kept up to date by a stream over the log's files.

``slot_counts`` gives PV and UV per slot and channel, once, when the watermark has passed the slot's end: a
first aggregate keeps one state row per (slot, channel, visitor), a second one counts them. ``first_visits``
gives the first row of each (slot, channel, visitor) as soon as it arrives. Both need state for the slots that
are still open only, spread by the whole tuple, so a hot channel is not one task's state.

**Late rows.** The watermark is the latest ``dateline`` seen by the end of the batch before, less ``delay``. A
row whose slot had ended by then is dropped from ``slot_counts``, one older than the watermark from
``first_visits``; ``late_groups`` tells how many state keys that were. A slot the watermark has not passed when
the log ends is not given; the next run continues from the checkpoint.

**Restarts.** Files read, state and watermark are in the checkpoint. ``publish`` replaces the slices of its
batch, and a slot is in one batch only, so a batch that runs again after a crash changes nothing.

Slots are ``[lo, hi)`` and cut on epoch seconds; in zones off by other than whole ten minutes they are not those
of the wall clock. For large state, set ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB
provider.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyflow import schema
from tallyflow.functions import clean
from tallyflow.functions.timing import TICK_SECONDS
from tallyflow.sinks import tables

SLOT = f"{TICK_SECONDS} seconds"
#: at least the length of a slot, or a visitor's second row in a slot might count again
DELAY = SLOT

#: PV and UV of a slot, stored by day and by the second at which the slot ends
SLOTS = tables.MetricsTable(schema.SLOT_COUNTS, ["dt", "upto", "qid"], ["dt", "upto"])


def read_stream(spark: SparkSession, path: str, columns: T.StructType, files: int | None = None) -> DataFrame:
    """New files of a log in day folders, in order of their arrival, at most ``files`` a batch."""
    reader = spark.readStream.schema(columns)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def _visits(log: DataFrame, delay: str) -> DataFrame:
    """Rows with their time, as the sliced day reads them: null channels and visitors are texts."""
    return log.select(
        F.timestamp_seconds("dateline").alias("at"),
        "dt",
        clean.null_text(F.col("qid")).alias("qid"),
        clean.null_text(F.col("uid")).alias("uid"),
    ).withWatermark("at", delay)


def slot_counts(log: DataFrame, delay: str = DELAY) -> DataFrame:
    """(dt, upto, qid, pv, uv) per slot that has ended; ``upto`` is its end."""
    visitors = _visits(log, delay).groupBy(F.window("at", SLOT).alias("slot"), "dt", "qid", "uid").agg(F.count("*").alias("n"))
    counts = visitors.groupBy(F.window("slot", SLOT).alias("whole"), "dt", "qid").agg(F.sum("n").alias("pv"), F.count("*").alias("uv"))
    return schema.conform(counts.withColumn("upto", F.unix_timestamp("whole.end")), schema.SLOT_COUNTS)


def first_visits(log: DataFrame, delay: str = DELAY) -> DataFrame:
    """(dt, upto, qid, uid): the first row of each visitor on a channel in a slot."""
    visits = _visits(log, delay).withColumn("upto", F.unix_timestamp(F.window("at", SLOT)["end"]))
    return visits.dropDuplicatesWithinWatermark(["upto", "dt", "qid", "uid"]).select("dt", "upto", "qid", "uid")


def put_batch(counts: DataFrame, target: str) -> int:
    """Puts the slots of one batch in place of what the target, a path or a table, has of them."""
    return tables.overwrite_slices(counts, target, SLOTS)


def publish(counts: DataFrame, target: str, checkpoint: str) -> DataStreamWriter:
    """A stream that stores slots by ``put_batch``; start it with a trigger."""
    return counts.writeStream.outputMode("append").foreachBatch(lambda batch, _: put_batch(batch, target) and None).option("checkpointLocation", checkpoint)


def store(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream that appends rows to day folders, each exactly once."""
    return rows.writeStream.outputMode("append").partitionBy("dt").format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Reads all files there are and stops; errors of the stream are raised."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def late_groups(query: StreamingQuery) -> int:
    """State keys of dropped rows, over the batches whose progress Spark still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
