"""Distinct pairs and the counts built on them.

A null visitor (or ip) is one visitor: it is an ordinary grouping key here, where
``count(DISTINCT c)`` would drop it.

Every count goes through ``distinct_pairs``. Spark combines the pairs on the map side and shuffles
by the whole (member, keys) tuple, so a channel holding a third of all rows is spread over all
reducers; the second grouping then moves one partial row per key and task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_pairs(df: DataFrame, member: str, keys: list[str]) -> DataFrame:
    """Distinct (member, keys) with the number of rows behind each, in column ``n``."""
    return df.groupBy(member, *keys).agg(F.count("*").alias("n"))


def members_by(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Members per key: UV or IP, from distinct pairs."""
    return pairs.groupBy(*keys).agg(F.count("*").alias(name))


def rows_by(pairs: DataFrame, keys: list[str], name: str = "pv") -> DataFrame:
    """Rows per key: PV, from distinct pairs."""
    return pairs.groupBy(*keys).agg(F.sum("n").alias(name))


def distinct_by(df: DataFrame, keys: list[str], member: str, name: str) -> DataFrame:
    """UV or IP per key straight from the rows."""
    return members_by(distinct_pairs(df, member, keys), keys, name)


def page_views_by(df: DataFrame, keys: list[str], name: str = "pv") -> DataFrame:
    """PV per key straight from the rows; no pairs needed."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def total_members(df: DataFrame, member: str, name: str) -> DataFrame:
    """Members over all keys, one row (0 on empty input)."""
    return df.groupBy(member).agg(F.count("*").alias("n")).agg(F.count("*").alias(name))


def total_rows(df: DataFrame, name: str = "pv") -> DataFrame:
    """Row count, one row (0 on empty input)."""
    return df.agg(F.count("*").alias(name))


def salted_members_by(pairs: DataFrame, keys: list[str], member: str, name: str, salts: int = 9) -> DataFrame:
    """``members_by`` in two explicit phases over a salt of the member.

    The salt is a hash, not a random number, so a retried task gives the same rows. Spark's own
    partial aggregation already bounds what reaches one reducer; this form is for engines or
    settings where that is off.
    """
    salt = F.pmod(F.xxhash64(member), F.lit(salts))
    return (
        pairs.groupBy(salt.alias("salt"), *keys)
        .agg(F.count("*").alias("part"))
        .groupBy(*keys)
        .agg(F.sum("part").alias(name))
    )


def top_channels(counts: DataFrame, by: str, k: int = 10) -> DataFrame:
    """The ``k`` largest channels, ties by name."""
    return counts.orderBy(F.desc(by), F.asc("qid")).limit(k)


def word_count(lines: DataFrame, line: Column) -> DataFrame:
    """Words split on single blanks. Trailing empty words do not count, inner ones do.

    A line of blanks has no words; an empty line has one, the empty word.
    """
    trimmed = F.rtrim(line)
    return (
        lines.where((trimmed != "") | (line == ""))
        .select(F.explode(F.split(trimmed, " ")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


# ---- sliced day -------------------------------------------------------------------------

def sliced_pairs(rows: DataFrame) -> DataFrame:
    """Distinct (slot, uid, qid): a visitor appears once in each ten-minute slice they came in."""
    return rows.select("slot", "uid", "qid").distinct()


def sliced_uv_by_channel(rows: DataFrame) -> DataFrame:
    """Visitors summed over the slices, per channel."""
    return sliced_pairs(rows).groupBy("qid").agg(F.count("*").alias("uv"))


def sliced_uv(rows: DataFrame) -> DataFrame:
    """(is_total, qid, uv): the two below in one scan; the total row has a null qid and is always there."""
    group = lambda total, slot, qid: F.struct(
        F.lit(total).alias("is_total"), slot.cast("long").alias("slot"), qid.cast("string").alias("qid"))
    groups = F.array(group(False, F.col("slot"), F.col("qid")), group(True, F.lit(None), F.lit(None)))
    seen = rows.select("uid", F.explode(groups).alias("g")).select("g.*", "uid").distinct().withColumn("n", F.lit(1))
    none = rows.sparkSession.range(1).select(F.lit(True).alias("is_total"), F.lit(0).alias("n"))
    every = seen.unionByName(none, allowMissingColumns=True)
    return every.groupBy("is_total", "qid").agg(F.sum("n").alias("uv"))


def sliced_total_uv(rows: DataFrame) -> DataFrame:
    """Distinct visitors over all slices and channels."""
    return total_members(rows, "uid", "uv")
