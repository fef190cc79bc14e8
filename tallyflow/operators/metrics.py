"""The metric core shared by all reports.

A report is two steps over one scan.

``facts`` gives each log row one row per (group it counts in) x (thing it counts for): its channel,
the rollups it is part of and the total; the visitor and the ip. ``metrics_at`` then groups twice:

1. by (group, dim, member), where a member is a visitor or an ip: row counts and "seen in the last
   ten minutes". Combined on the map side, shuffled by the full tuple, so neither a hot channel nor
   a hot visitor meets in one task.
2. by group: PV = sum of row counts, UV / IP = number of members, ``incr_*`` = the recent part.
   Each task sends one partial row per group.

PV, UV, IP, their ten-minute twins, every rollup and the total thus cost one scan and two shuffles,
with no joins and no per-metric pass. Distinct counts written as ``count(DISTINCT ...)`` would make
Catalyst expand every row once per distinct, five-fold here, before the total rows are counted in.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import clean

METRICS = ["pv", "uv", "ip", "incr_pv", "incr_uv", "incr_ip", "activecnt", "incr_activecnt"]


def facts(rows: DataFrame, groups: list[Column], members: dict[str, Column]) -> DataFrame:
    """Spread rows over their groups and members.

    ``groups`` are struct columns of one common type, null where the row is not part of the group;
    each has a ``hits`` field, the rows it adds to PV. ``members`` maps a dim (``visitor``, ``ip``,
    ``active``) to the column holding the member; members may be null.
    """
    kept = [c for c in ("dt", "slot", "dateline") if c in rows.columns]
    spread = rows.select(
        *kept,
        *[c.alias(dim) for dim, c in members.items()],
        F.explode(F.array(*groups)).alias("g"),
    ).where(F.col("g").isNotNull()).select(*kept, "g.*", *members)
    ids = [c for c in spread.columns if c not in members]
    return spread.unpivot(ids, list(members), "dim", "member")


def cells_at(spread: DataFrame, keys: list[str], up: int) -> DataFrame:
    """Step 1: one row per (keys, dim, member) with its counts at the tick ``up``."""
    recent = clean.last_ten_minutes(F.col("dateline"), up)
    return spread.groupBy(*keys, "dim", "member").agg(
        F.sum("hits").alias("n"),
        F.sum(F.when(recent, F.col("hits")).otherwise(0)).alias("n10"),
        F.max(recent).alias("recent"),
    )


def metrics_at(parts: list[DataFrame], keys: list[str], up: int, seed: DataFrame | None = None) -> DataFrame:
    """All metrics per ``keys`` for the tick ``up``.

    ``parts`` are spread rows of different dims: the traffic and the activity log. They meet as
    cells, not as rows, so each one's scan, spread and partial aggregation compile into one stage.
    ``seed`` has rows of ``keys`` that must come out even if no log row is in them.
    """
    cells = reduce(DataFrame.unionByName, [cells_at(p, keys, up) for p in parts])
    if seed is not None:
        cells = cells.unionByName(seed, allowMissingColumns=True)
    return cells.groupBy(*keys).agg(*cell_metrics(F.col("n"), F.col("n10"), F.col("recent")))


def cell_metrics(n: Column, n10: Column, recent: Column) -> list[Column]:
    dim = F.col("dim")
    count_of = lambda d: F.count(F.when(dim == d, 1))
    recent_of = lambda d: F.count(F.when((dim == d) & recent, 1))
    sum_of = lambda c: F.coalesce(F.sum(F.when(dim == "visitor", c)), F.lit(0))
    return [
        sum_of(n).alias("pv"),
        count_of("visitor").alias("uv"),
        count_of("ip").alias("ip"),
        sum_of(n10).alias("incr_pv"),
        recent_of("visitor").alias("incr_uv"),
        recent_of("ip").alias("incr_ip"),
        count_of("active").alias("activecnt"),
        recent_of("active").alias("incr_activecnt"),
    ]


# ---- other plans for the same numbers -----------------------------------------------------

def one_pass_metrics(rows: DataFrame, keys: list[str], visitor: str, ip: str, up: int) -> DataFrame:
    """PV / UV / IP and their ten-minute twins as conditional aggregates; no totals.

    The shortest way to write it. Catalyst expands each row once per distinct count.
    """
    recent = clean.last_ten_minutes(F.col("dateline"), up)
    v, i = F.struct(visitor), F.struct(ip)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("pv"),
        F.count_distinct(v).alias("uv"),
        F.count_distinct(i).alias("ip"),
        F.count_if(recent).alias("incr_pv"),
        F.count_distinct(F.when(recent, v)).alias("incr_uv"),
        F.count_distinct(F.when(recent, i)).alias("incr_ip"),
    )


def member_metrics(rows: DataFrame, keys: list[str], member: str, up: int, names: dict[str, str]) -> DataFrame:
    """Per key some of: ``rows``, ``recent_rows``, ``members``, ``recent_members``, named by ``names``; one scan."""
    recent = clean.last_ten_minutes(F.col("dateline"), up)
    pairs = rows.groupBy(member, *keys).agg(F.count("*").alias("n"), F.count_if(recent).alias("n10"))
    counts = {
        "rows": F.sum("n"),
        "recent_rows": F.sum("n10"),
        "members": F.count("*"),
        "recent_members": F.count_if(F.col("n10") > 0),
    }
    return pairs.groupBy(*keys).agg(*[counts[what].alias(name) for what, name in names.items()])


def joined_metrics(
    rows: DataFrame, keys: list[str], visitor: str, ip: str, up: int, active: DataFrame | None = None
) -> DataFrame:
    """The same as left joins on the PV side, one aggregate per kind of member.

    ``active`` holds activity rows with the same keys and a ``uid`` and adds another join. The form
    the others are checked against; it scans the log once for visitors and once for addresses.
    """
    traffic = {"rows": "pv", "members": "uv", "recent_rows": "incr_pv", "recent_members": "incr_uv"}
    out = member_metrics(rows, keys, visitor, up, traffic)
    out = out.join(member_metrics(rows, keys, ip, up, {"members": "ip", "recent_members": "incr_ip"}), keys, "left")
    if active is not None:
        names = {"members": "activecnt", "recent_members": "incr_activecnt"}
        out = out.join(member_metrics(active, keys, "uid", up, names), keys, "left")
    return out.na.fill(0)
