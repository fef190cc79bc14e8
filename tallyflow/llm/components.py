"""Connected components of links; nothing is collected.

Each part of at most ``PART`` links on average is contracted on its own to a forest of stars. If there are
several parts, large-star and small-star steps join them up, each step a few shuffles of what is left.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.sinks.scratch import stored

PART = 1_000_000
PAIR = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest index each of n things is connected to."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        for x in (a, b, low[a], low[b]):
            np.minimum.at(new, x, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _contract(batches):
    """Links of one part, as pairs of each id and the lowest it is connected to here."""
    u, v = [], []
    for b in batches:
        u.append(b.column("u").to_numpy())
        v.append(b.column("v").to_numpy())
    if u:
        ids, at = np.unique(np.concatenate([*u, *v]), return_inverse=True)
        n = len(at) // 2
        low = forest(len(ids), at[:n], at[n:])
        some = np.flatnonzero(low < np.arange(len(ids)))
        yield record(to_arrow_schema(PAIR), ids[some], ids[low[some]])


def _lowest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the lowest v of its u, or u where that is lower."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return pairs.join(low, pairs.u == low.k).select("u", "v", "m")


def components(links: DataFrame, a: str, b: str, label: str = "components", part: int = PART) -> DataFrame:
    """(id, root) for each id in a link with another: root is the lowest id it is connected to.

    ``links`` is a stored table. Links with a null or equal ends count for nothing. No links give no rows.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u > v")
    parts = max(1, -(-pairs.count() // part))
    pairs = stored(map_arrow(pairs.coalesce(parts), _contract, PAIR), label)
    before = None
    while parts > 1:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = pairs.union(pairs.select("v", "u"))
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small = _lowest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m")))
        pairs = stored(small.where("u > v").distinct(), label)
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("root")).union(pairs.select("v", "v").distinct())
