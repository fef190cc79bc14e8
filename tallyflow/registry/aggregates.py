"""Distinct pairs, counts, rollups, membership and the small pieces around them."""

from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.operators import counts, rollups
from tallyflow.registry.base import (
    WINDOW, Registry, active_rows, app_active_rows, app_keys, app_rows, distinct_sql, h5_rows, rollup_rows,
    with_views,
)
from tallyflow.registry.scans import SLICED_ROWS, sliced
from tallyflow.sources import derived, logs

REGISTRY = Registry()
query = REGISTRY.query


def h5(spark, sf):
    rows = logs.h5_clean(derived.h5_log(spark, sf), WINDOW)
    return rows.withColumn("qid", F.lower("qid"))


def app(spark, sf):
    return _app_labels(logs.app(derived.app_log(spark, sf), WINDOW))


def _app_labels(rows):
    return rows.withColumns({
        "qid": F.lower(clean.trim_date(F.col("qid"))), "apptypeid": F.upper(clean.null_text(F.col("apptypeid"))),
    })


H5 = [h5_rows(), "h5 AS (SELECT * REPLACE (lower(qid) AS qid) FROM rows_h5)"]
APP = [app_rows(), app_keys("rows_app", "app")]


def _family(source, name: str, ctes: list[str], keys: list[str], member: str, tag: str, metric: str):
    """The distinct pairs of a source and the members per key built on them."""
    by = ", ".join(keys)
    suffix = {"qid": "qid", "apptypeid, qid": "app_qid"}[by]

    @query(f"distinct_{tag}_{suffix}", with_views(
        f"SELECT {member}, {by}, count(*) AS n FROM {name} GROUP BY {member}, {by}", *ctes))
    def pairs(spark, sf):
        return counts.distinct_pairs(source(spark, sf), member, keys)

    @query(f"{metric}_by_{suffix}", with_views(
        f"SELECT {by}, {distinct_sql(member)} AS {metric} FROM {name} GROUP BY {by}", *ctes))
    def members(spark, sf):
        return counts.distinct_by(source(spark, sf), keys, member, metric)


_family(h5, "h5", H5, ["qid"], "uid", "uid", "uv")
_family(h5, "h5", H5, ["qid"], "clientip", "ip", "ip")
_family(app, "app", APP, ["apptypeid", "qid"], "uid", "uid", "uv")
_family(app, "app", APP, ["apptypeid", "qid"], "clientip", "ip", "ip")


@query("pv_by_qid", with_views("SELECT qid, count(*) AS pv FROM h5 GROUP BY qid", *H5))
def pv_by_qid(spark, sf):
    return counts.page_views_by(h5(spark, sf), ["qid"])


@query("pv_by_app_qid", with_views("SELECT apptypeid, qid, count(*) AS pv FROM app GROUP BY apptypeid, qid", *APP))
def pv_by_app_qid(spark, sf):
    pairs = counts.distinct_pairs(app(spark, sf), "uid", ["apptypeid", "qid"])
    return counts.rows_by(pairs, ["apptypeid", "qid"])


@query("total_uv", with_views(f"SELECT {distinct_sql('uid')} AS uv FROM h5", *H5))
def total_uv(spark, sf):
    return counts.total_members(h5(spark, sf), "uid", "uv")


@query("total_ip", with_views(f"SELECT {distinct_sql('clientip')} AS ip FROM h5", *H5))
def total_ip(spark, sf):
    return counts.total_members(h5(spark, sf), "clientip", "ip")


@query("total_pv", with_views("SELECT count(*) AS pv FROM h5", *H5))
def total_pv(spark, sf):
    return counts.total_rows(h5(spark, sf))


@query("uv_by_app", with_views(f"SELECT apptypeid, {distinct_sql('uid')} AS uv FROM app GROUP BY apptypeid", *APP))
def uv_by_app(spark, sf):
    return counts.distinct_by(app(spark, sf), ["apptypeid"], "uid", "uv")


@query("ip_by_app", with_views(f"SELECT apptypeid, {distinct_sql('clientip')} AS ip FROM app GROUP BY apptypeid", *APP))
def ip_by_app(spark, sf):
    return counts.distinct_by(app(spark, sf), ["apptypeid"], "clientip", "ip")


@query("pv_by_app", with_views("SELECT apptypeid, count(*) AS pv FROM app GROUP BY apptypeid", *APP))
def pv_by_app(spark, sf):
    return counts.page_views_by(app(spark, sf), ["apptypeid"])


@query("agg_salted", with_views(f"SELECT qid, {distinct_sql('uid')} AS uv FROM h5 GROUP BY qid", *H5))
def agg_salted(spark, sf):
    pairs = counts.distinct_pairs(h5(spark, sf), "uid", ["qid"])
    return counts.salted_members_by(pairs, ["qid"], "uid", "uv")


@query("active_by_qid", with_views(
    f"SELECT lower(qid) AS qid, {distinct_sql('uid')} AS activecnt FROM rows_active GROUP BY lower(qid)", active_rows()))
def active_by_qid(spark, sf):
    rows = logs.h5_active(derived.h5_active_log(spark, sf), WINDOW).withColumn("qid", F.lower("qid"))
    return counts.distinct_by(rows, ["qid"], "uid", "activecnt")


@query("active_by_app_qid", with_views(
    f"SELECT apptypeid, qid, {distinct_sql('uid')} AS activecnt FROM keyed GROUP BY apptypeid, qid",
    app_active_rows(), app_keys("rows_app_active", "keyed")))
def active_by_app_qid(spark, sf):
    rows = _app_labels(logs.app_active(derived.app_active_log(spark, sf), WINDOW))
    return counts.distinct_by(rows, ["apptypeid", "qid"], "uid", "activecnt")


# ---- sliced day ---------------------------------------------------------------------------

@query("sliced_uv_by_qid", with_views(
    "SELECT qid, count(*) AS uv FROM (SELECT DISTINCT slot, uid, qid FROM sliced) GROUP BY qid", SLICED_ROWS))
def sliced_uv_by_qid(spark, sf):
    return counts.sliced_uv_by_channel(sliced(spark, sf))


@query("sliced_total_uv", with_views("SELECT count(DISTINCT uid) AS uv FROM sliced", SLICED_ROWS))
def sliced_total_uv(spark, sf):
    return counts.sliced_total_uv(sliced(spark, sf))


@query("topk_channels", with_views("SELECT qid, count(*) AS pv FROM h5 GROUP BY qid ORDER BY pv DESC, qid LIMIT 10", *H5))
def topk_channels(spark, sf):
    return counts.top_channels(counts.page_views_by(h5(spark, sf), ["qid"]), "pv")


@query("sliced_day_report", with_views("""
SELECT false AS is_total, qid, count(*) AS uv FROM (SELECT DISTINCT slot, uid, qid FROM sliced) GROUP BY qid
UNION ALL SELECT true, NULL, count(DISTINCT uid) FROM sliced""", SLICED_ROWS))
def sliced_day_report(spark, sf):
    return counts.sliced_uv(sliced(spark, sf))


@query("topk_sliced_uv", with_views(
    "SELECT qid, count(*) AS uv FROM (SELECT DISTINCT slot, uid, qid FROM sliced) GROUP BY qid "
    "ORDER BY uv DESC, qid LIMIT 10", SLICED_ROWS))
def topk_sliced_uv(spark, sf):
    return counts.top_channels(counts.sliced_uv_by_channel(sliced(spark, sf)), "uv")


@query("word_count", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents WHERE text = '' OR rtrim(text, ' ') <> '')
GROUP BY word""")
def word_count(spark, sf):
    return counts.word_count(derived.lines(spark, sf), F.col("line"))


# ---- rollups --------------------------------------------------------------------------------

_SDK = "(SELECT h5qid FROM sdk_list WHERE h5qid IS NOT NULL)"


def _clean_h5(spark, sf):
    return logs.h5_clean(derived.h5_log(spark, sf), WINDOW)


@query("semi_sdk", with_views(f"SELECT * FROM rows_h5 WHERE qid IN {_SDK}", h5_rows()))
def semi_sdk(spark, sf):
    return rollups.sdk_rows(_clean_h5(spark, sf), derived.sdk_list(spark, sf))


@query("semi_sdk_large_list", with_views(f"SELECT * FROM rows_h5 WHERE qid IN {_SDK}", h5_rows()))
def semi_sdk_large_list(spark, sf):
    """A list that counts as too large: only its channels that occur in the log are broadcast."""
    return rollups.sdk_rows(_clean_h5(spark, sf), derived.sdk_list(spark, sf), list_rows=0)


@query("semi_sdk_many_matches", with_views(f"SELECT * FROM rows_h5 WHERE qid IN {_SDK}", h5_rows()))
def semi_sdk_many_matches(spark, sf):
    """Too many channels of the list occur in the log as well: hot ones are broadcast, rows that pass a Bloom filter shuffled."""
    return rollups.sdk_rows(_clean_h5(spark, sf), derived.sdk_list(spark, sf), list_rows=0, matched_rows=0)


@query("rollup_sdk", with_views(
    f"SELECT * REPLACE ('sdk_total' AS qid) FROM rows_h5 WHERE qid IN {_SDK}", h5_rows()))
def rollup_sdk(spark, sf):
    return rollups.relabel(rollups.sdk_rows(_clean_h5(spark, sf), derived.sdk_list(spark, sf)), clean.SDK_TOTAL)


@query("rollup_miniprogram", with_views(
    "SELECT * REPLACE ('小程序汇总' AS qid) FROM rows_h5 WHERE qid IN ('sharexcx', 'xiaochengxu_dftt')", h5_rows()))
def rollup_miniprogram(spark, sf):
    return rollups.relabel(rollups.mini_program_rows(_clean_h5(spark, sf)), clean.MINI_PROGRAM_TOTAL)


@query("rollup_union", with_views("SELECT * FROM unioned", h5_rows(), rollup_rows("rows_h5", "unioned")))
def rollup_union(spark, sf):
    flagged = rollups.flag_sdk(_clean_h5(spark, sf), derived.sdk_list(spark, sf))
    return rollups.with_rollups(flagged).withColumn("qid", F.lower("qid"))
