"""Line dedup by site-relative frequency, in DataFrame functions only.

A line of a host is boilerplate if the distinct pages of the host that have it are more than ``RATIO`` of all
distinct pages of the host, and at least ``LEAST_PAGES``. Exact copies of a page count once, so a page that is
copied often does not become boilerplate. Boilerplate lines are dropped wherever they stand in the host's
pages. Lines are compared by 96 bits of hash.

The counts are combined before each shuffle and keyed by host, line and page, so a hot host or line is spread.
A host has at most lines per page / ``RATIO`` boilerplate lines. They are sent to every task if there are at
most ``FEW`` over all hosts; more are joined by host and salt. Texts are not shuffled in the first case.

Null texts stay null and have no lines. A null host is one host. Blank lines are never boilerplate. A text
all of whose lines go is empty; its row stays. Repeated ids are rows of their own. Other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.sinks.scratch import stored

RATIO = 0.02
LEAST_PAGES = 3
FEW = 500_000
SALTS = 32


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("k1"), F.hash(line).alias("k2"))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): the keys of each host's boilerplate lines."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).where("text is not null")
    page = F.struct(F.xxhash64("text").alias("p1"), F.hash("text").alias("p2")).alias("page")
    lines = pages.select("host", page, F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).where(F.trim("line") != "")
    counts = lines.select("host", "page", _key(F.col("line")).alias("line")).distinct().groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    totals = pages.select("host", page).distinct().groupBy("host").agg(F.count("*").alias("total")).withColumnRenamed("host", "h")
    common = counts.join(totals, F.col("host").eqNullSafe(F.col("h"))).where(F.col("pages") > ratio * F.col("total"))
    return common.groupBy("host").agg(F.collect_set("line").alias("lines"))


def clean(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``docs`` without boilerplate lines, with n_lines and n_dropped behind the other columns."""
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    sets = stored(boilerplate(docs, host_col, text_col, ratio, least_pages), "boilerplate").select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    if (sets.agg(F.sum(F.size("__lines"))).first()[0] or 0) <= FEW:
        joined = docs.join(F.broadcast(sets), docs[host_col].eqNullSafe(sets["__host"]), "left")
    else:
        salt = F.pmod(F.xxhash64(text_col), F.lit(SALTS))
        dealt = sets.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = docs.join(dealt, docs[host_col].eqNullSafe(dealt["__host"]) & (salt == dealt["__salt"]), "left")
    every = F.split(joined[text_col], "\n")
    left = F.when(F.col("__lines").isNull(), every).otherwise(F.filter(every, lambda x: ~F.array_contains("__lines", _key(x))))
    found = joined.withColumn("__every", F.coalesce(F.size(every), F.lit(0))).withColumn("__left", left)
    text = F.when(F.size("__left") == F.col("__every"), F.col(text_col)).otherwise(F.array_join("__left", "\n"))
    count = lambda c: F.when(F.col(text_col).isNull(), 0).otherwise(c).cast("bigint")
    n_lines, n_dropped = count(F.col("__every")).alias("n_lines"), count(F.col("__every") - F.size("__left")).alias("n_dropped")
    return found.select(*[text.alias(c) if c == text_col else F.col(c) for c in names], n_lines, n_dropped)


#: the same rows in SQL
SQL = f"""
with lines as (
  select doc_id, source, text, pos, line from (
    select doc_id, source, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
    from documents where text is not null)),
counts as (select source, line, count(distinct md5(text)) as pages from lines where trim(line, ' ') <> '' group by source, line),
totals as (select source, count(distinct md5(text)) as total from documents where text is not null group by source),
bad as (
  select c.source, c.line from counts c join totals t on c.source is not distinct from t.source
  where c.pages >= {LEAST_PAGES} and c.pages > {RATIO}::double * t.total),
marked as (
  select l.*, b.line is not null as dropped from lines l left join bad b on l.source is not distinct from b.source and l.line = b.line),
cut as (
  select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
    coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '') as text
  from marked group by doc_id)
select d.doc_id, c.text, coalesce(c.n_lines, 0) as n_lines, coalesce(c.n_dropped, 0) as n_dropped from documents d left join cut c using (doc_id)
"""
