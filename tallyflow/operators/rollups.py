"""Membership in the SDK channel list, and groups that overlap with the channels."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.sinks.scratch import stored

# what a channel list may measure to be sent to every executor
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 16 << 20
#: a channel is hot with more than one in so many of the listed rows
HOT = 1000
#: 8 MB of filter; ten bits a channel and three hashes let 2 % of the other rows pass
MAX_BLOOM_BITS = 1 << 26
BLOOM_HASHES = 3


def channel_list(sdk: DataFrame) -> DataFrame:
    """Distinct non-null channels of the list, in column ``h5qid``."""
    return sdk.select("h5qid").where(F.col("h5qid").isNotNull()).distinct()


def fits_broadcast(
    channels: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure the list on the executors; two numbers come back."""
    rows, size = channels.agg(F.count("*"), F.sum(F.octet_length("h5qid"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def _counted(rows: DataFrame, channels: DataFrame) -> DataFrame:
    """(h5qid, n, listed) per channel of the log: one scan of that column, combined on the map side."""
    counts = rows.groupBy(F.col("qid").alias("h5qid")).agg(F.count("*").alias("n"))
    listed = channels.select("h5qid", F.lit(True).alias("listed")).hint("shuffle_hash")
    return counts.join(listed, "h5qid", "left").select("h5qid", "n", F.coalesce("listed", F.lit(False)).alias("listed"))


@dataclass(frozen=True)
class Filtered:
    """How rows meet a list of which too many channels occur in the log: hot channels, with whether they are listed, and a filter for the rest."""

    hot: DataFrame
    bits: DataFrame
    size: int


def _plan(rows: DataFrame, channels: DataFrame, list_rows: int, matched_rows: int) -> DataFrame | Filtered:
    """The list if it is small, else its channels that occur in ``rows`` if those are, both to be broadcast; else a filter."""
    if fits_broadcast(channels, list_rows):
        return F.broadcast(channels)
    counted = stored(_counted(rows, channels), "channels")
    matched = counted.where("listed").select("h5qid")
    if fits_broadcast(matched, matched_rows):
        return F.broadcast(matched)
    total, count = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if("listed")).first()
    hot = counted.where(F.col("n") * HOT > F.lit(total)).select("h5qid", "listed")
    return Filtered(F.broadcast(hot), *bloom_filter(matched, count))


# ---- Bloom filter ---------------------------------------------------------------------------

def _positions(channel: Column, size: int) -> list[Column]:
    return [F.pmod(F.xxhash64(channel, F.lit(k)), F.lit(size).cast("bigint")) for k in range(BLOOM_HASHES)]


def bloom_filter(channels: DataFrame, count: int, max_bits: int = MAX_BLOOM_BITS) -> tuple[DataFrame, int]:
    """One row with the filter's words as an array, and its number of bits: ten or more per channel, up to ``max_bits``.

    The words of all channels are OR-ed on the map side; the array has ``max_bits`` / 64 entries at most, however
    long the list is. A filter that is too small for its list lets more rows pass and drops none.
    """
    size = min(max_bits, max(1 << 12, 1 << (10 * max(count, 1)).bit_length()))
    place = F.explode(F.array(*_positions(F.col("h5qid"), size)))
    words = channels.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("w"))
    every = channels.sparkSession.range(size // 64).join(words, "id", "left").select(F.struct("id", F.coalesce("w", F.lit(0).cast("bigint")).alias("w")).alias("s"))
    return every.agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["w"]).alias("words")), size


def might_be_listed(qid: Column, bits: DataFrame, size: int) -> Column:
    """False if the filter says that the channel is not on the list; a null channel is not."""
    words = bits.scalar()
    own = [F.expr("true")]
    for p in _positions(qid, size):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        own.append(F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return F.coalesce(reduce(Column.__and__, own), F.lit(False))


def candidates(rows: DataFrame, plan: Filtered) -> DataFrame:
    """The rows that are shuffled to meet the list: neither on a hot channel nor ruled out by the filter."""
    return _without_hot(rows, plan).where(might_be_listed(F.col("qid"), plan.bits, plan.size))


def _without_hot(rows: DataFrame, plan: Filtered) -> DataFrame:
    return rows.join(plan.hot, rows["qid"] == plan.hot["h5qid"], "left_anti")


def _hot(rows: DataFrame, plan: Filtered) -> DataFrame:
    """Rows on hot channels, flagged."""
    return rows.join(plan.hot, rows["qid"] == plan.hot["h5qid"]).drop("h5qid").withColumnRenamed("listed", "in_sdk")


# ---- membership -----------------------------------------------------------------------------

def flag_sdk(
    rows: DataFrame, sdk: DataFrame, list_rows: int = MAX_BROADCAST_ROWS, matched_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Add boolean ``in_sdk``: the channel, as written, is on the list.

    A list of measured small size is broadcast, else the channels of it that the log has, so the log is
    not shuffled. If those are too many as well, channels with more than one in ``HOT`` of the log's rows,
    fewer than ``HOT``, are broadcast; of the other rows only those that pass a Bloom filter are shuffled, and no
    channel among these is hot. That scans the log once per part. Duplicates on the list do not multiply rows.
    """
    channels = channel_list(sdk)
    plan = _plan(rows, channels, list_rows, matched_rows)
    if isinstance(plan, DataFrame):
        return rows.join(plan, rows["qid"] == plan["h5qid"], "left").withColumn("in_sdk", F.col("h5qid").isNotNull()).drop("h5qid")
    listed, maybe = channels.hint("shuffle_hash"), candidates(rows, plan)
    met = maybe.join(listed, maybe["qid"] == listed["h5qid"], "left").withColumn("in_sdk", F.col("h5qid").isNotNull()).drop("h5qid")
    ruled_out = _without_hot(rows, plan).where(~might_be_listed(F.col("qid"), plan.bits, plan.size)).withColumn("in_sdk", F.lit(False))
    return _hot(rows, plan).unionByName(met).unionByName(ruled_out)


def sdk_rows(
    rows: DataFrame, sdk: DataFrame, list_rows: int = MAX_BROADCAST_ROWS, matched_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Only the rows whose channel is on the list; the plans are those of ``flag_sdk``."""
    channels = channel_list(sdk)
    plan = _plan(rows, channels, list_rows, matched_rows)
    if isinstance(plan, DataFrame):
        return rows.join(plan, rows["qid"] == plan["h5qid"], "left_semi")
    listed, maybe = channels.hint("shuffle_hash"), candidates(rows, plan)
    hot = _hot(rows, plan).where("in_sdk").drop("in_sdk")
    return hot.unionByName(maybe.join(listed, maybe["qid"] == listed["h5qid"], "left_semi"))


def mini_program_rows(rows: DataFrame) -> DataFrame:
    return rows.where(clean.is_mini_program(F.col("qid")))


def relabel(rows: DataFrame, label: str) -> DataFrame:
    """Move rows to a rollup group."""
    return rows.withColumn("qid", F.lit(label))


def rollup_groups(in_sdk: Column, qid: Column) -> list[Column]:
    """The groups a row belongs to besides its own channel; null where it does not."""
    return [
        F.when(in_sdk, F.lit(clean.SDK_TOTAL)),
        F.when(clean.is_mini_program(qid), F.lit(clean.MINI_PROGRAM_TOTAL)),
    ]


def with_rollups(flagged: DataFrame) -> DataFrame:
    """One output row per group of each row: its channel, and the rollups it is part of.

    One pass over the rows; same result as ``union_rollups``.
    """
    groups = F.array(F.col("qid"), *rollup_groups(F.col("in_sdk"), F.col("qid")))
    return flagged.withColumn("qid", F.explode(groups)).where(F.col("qid").isNotNull()).drop("in_sdk")


def union_rollups(rows: DataFrame, sdk: DataFrame) -> DataFrame:
    """The rows, the list's rows as ``sdk_total`` and the mini-program rows as their total."""
    return (
        rows.unionByName(relabel(sdk_rows(rows, sdk), clean.SDK_TOTAL))
        .unionByName(relabel(mini_program_rows(rows), clean.MINI_PROGRAM_TOTAL))
    )
