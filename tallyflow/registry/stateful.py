"""Streams, tables of the catalog, carried days, stored pairs and sketches, table functions."""

from pyspark.sql import functions as F

from tallyflow import schema
from tallyflow.functions import sqlfn
from tallyflow.functions.timing import report_window
from tallyflow.operators import sketches
from tallyflow.plans import carried, pairs, reports, runs
from tallyflow.registry.base import (
    APP_METRIC_COLUMNS, EARLIER, H5_METRIC_COLUMNS, TICK, WINDOW, Registry, app_ctes, app_report_sql, app_rows, distinct_sql, h5_full_ctes,
    h5_full_sql, h5_rows, in_window_sql, max_merge_sql, with_views,
)
from tallyflow.registry.reports import DAYS, _basic_ctes
from tallyflow.registry.scans import SLICED_ROWS
from tallyflow.sinks import tables
from tallyflow.sinks.scratch import scratch_path, scratch_table
from tallyflow.sources import derived, logs
from tallyflow.streaming import slots

REGISTRY = Registry()
query = REGISTRY.query


def _h5_inputs(spark, sf):
    return derived.h5_log(spark, sf), derived.h5_active_log(spark, sf), derived.sdk_list(spark, sf)


# ---- streams --------------------------------------------------------------------------------

def _day_by_day(spark, sf, start):
    """The basic log arrives day by day; after each day the stream runs on from its checkpoint. ``start`` makes its writer."""
    path, log = scratch_path(spark, "arriving"), derived.basic_log(spark, sf)
    for day in DAYS:
        tables.append_log_day(log.where(F.col("dt") == day), path)
        slots.run_available(start(slots.read_stream(spark, path, schema.BASIC_LOG)))


@query("stream_slot_counts", with_views("""
SELECT dt, low + 600 AS upto, qid, count(*) AS pv, count(DISTINCT uid) AS uv
FROM (SELECT dt, dateline - dateline % 600 AS low, coalesce(qid, 'null') AS qid, coalesce(uid, 'null') AS uid FROM basic_log)
WHERE low + 600 <= (SELECT max(dateline) FROM basic_log) - 600
GROUP BY dt, low, qid"""))
def stream_slot_counts(spark, sf):
    """PV and UV of every slot the watermark has passed, published batch by batch."""
    target, checkpoint = scratch_path(spark, "slots"), scratch_path(spark, "slots-checkpoint")
    _day_by_day(spark, sf, lambda log: slots.publish(slots.slot_counts(log), target, checkpoint))
    return tables.read_table(spark, target, slots.SLOTS)


@query("stream_sliced_uv", with_views(
    "SELECT qid, count(*) AS uv FROM (SELECT DISTINCT slot, uid, qid FROM sliced) GROUP BY qid", SLICED_ROWS))
def stream_sliced_uv(spark, sf):
    """Visitors summed over the complete slices of the day, from the first visits that a stream has stored."""
    target, checkpoint = scratch_path(spark, "visits"), scratch_path(spark, "visits-checkpoint")
    _day_by_day(spark, sf, lambda log: slots.store(slots.first_visits(log), target, checkpoint))
    seen = spark.read.schema("upto bigint, qid string, uid string, dt string").parquet(target)
    return seen.where((F.col("dt") == WINDOW.dt) & (F.col("upto") <= WINDOW.up)).groupBy("qid").agg(F.count("*").alias("uv"))


# ---- tables of the catalog ------------------------------------------------------------------

def _metrics_tables(spark, table, *labels):
    names = [scratch_table(spark, label) for label in labels]
    for name in names:
        tables.create(spark, name, table)
    return names


@query("catalog_publish", with_views(
    max_merge_sql("staged", schema.H5_KEYS, H5_METRIC_COLUMNS), *h5_full_ctes(), *h5_full_ctes(EARLIER, "_e"),
    f"staged AS ({h5_full_sql()} UNION ALL {h5_full_sql(EARLIER, '_e')})"))
def catalog_publish(spark, sf):
    """Two ticks staged and published in tables of the catalog, one of them twice."""
    staging, final = _metrics_tables(spark, tables.H5, "staging_h5", "final_h5")
    for w in (WINDOW, EARLIER, WINDOW):
        runs.run_h5_full(spark, *_h5_inputs(spark, sf), w, staging, final)
    return tables.read_table(spark, final, tables.H5)


@query("catalog_publish_app", with_views(
    max_merge_sql("staged", schema.APP_KEYS, APP_METRIC_COLUMNS), *app_ctes(app_rows(), "rows_app"), f"staged AS ({app_report_sql()})"))
def catalog_publish_app(spark, sf):
    staging, final = _metrics_tables(spark, tables.APP, "staging_app", "final_app")
    runs.run_app(spark, derived.app_log(spark, sf), WINDOW, staging, final)
    return tables.read_slice(spark, final, tables.APP, WINDOW.dt, WINDOW.up)


@query("catalog_truncate", with_views(h5_full_sql(), *_basic_ctes()))
def catalog_truncate(spark, sf):
    """A slice stored, the table truncated, another slice stored."""
    (name,), log = _metrics_tables(spark, tables.H5, "truncated"), derived.basic_log(spark, sf)
    tables.append(reports.h5_basic_report(log, EARLIER), name, tables.H5)
    tables.truncate(spark, name, tables.H5)
    tables.append(reports.h5_basic_report(log, WINDOW), name, tables.H5)
    return tables.read_table(spark, name, tables.H5)


def _log_table(spark, log, columns, label):
    """A log in the catalog, inserted into its day partitions in two steps."""
    name, early = scratch_table(spark, label), F.col("dateline") % 86400 < 3600
    tables.create_log(spark, name, columns)
    tables.append_log_day(log.where(early), name)
    tables.append_log_day(log.where(~early), name)
    return name


@query("catalog_log_insert", with_views(f"SELECT {', '.join(f.name for f in schema.H5_LOG)} FROM h5_log"))
def catalog_log_insert(spark, sf):
    return logs.read_log(spark, _log_table(spark, derived.h5_log(spark, sf), schema.H5_LOG, "h5_log"), schema.H5_LOG)


@query("scan_other_database", with_views(f"SELECT dateline, coalesce(clientip, 'null') AS ip, 'tallyflow_other' AS db FROM basic_log WHERE {in_window_sql()}"))
def scan_other_database(spark, sf):
    """The log of another database, by its plain name after a switch to that."""
    before = spark.catalog.currentDatabase()
    spark.sql("CREATE DATABASE IF NOT EXISTS tallyflow_other")
    logs.use_database(spark, "tallyflow_other")
    try:
        name = _log_table(spark, derived.basic_log(spark, sf), schema.BASIC_LOG, "log")
        assert not spark.catalog.tableExists(f"{before}.{name}")
        rows = logs.in_window(logs.read_log(spark, name, schema.BASIC_LOG), WINDOW)
        db = F.lit(spark.catalog.currentDatabase()).alias("db")
        return rows.select("dateline", F.coalesce("clientip", F.lit("null")).alias("ip"), db)
    finally:
        logs.use_database(spark, before)


@query("sink_replace_quoted", with_views(
    "SELECT dt, currenttime, replace(qid, chr(39), '') AS qid, pv, uv, ip, incr_pv, incr_uv, incr_ip, activecnt, incr_activecnt "
    f"FROM ({h5_full_sql()}) UNION ALL {h5_full_sql(EARLIER, '_e')}", *_basic_ctes(), *_basic_ctes(EARLIER, "_e")))
def sink_replace_quoted(spark, sf):
    """The older loader as a run: quotes stripped, the slice deleted, then inserted; a second time in place of the first."""
    (name,), log = _metrics_tables(spark, tables.H5, "older"), derived.basic_log(spark, sf)
    for w in (WINDOW, EARLIER, WINDOW):
        quoted = reports.h5_basic_report(log, w).withColumn("qid", F.concat(F.lit("'"), "qid", F.lit("'")))
        runs.run_older_loader(quoted, name, w)
    return tables.read_table(spark, name, tables.H5)


# ---- the day so far, carried ----------------------------------------------------------------

@query("h5_carried_report", with_views(h5_full_sql(), *h5_full_ctes()))
def h5_carried_report(spark, sf):
    """The tick's report after four earlier ticks of the day; one between them was lost, one was run twice."""
    state = carried.DaySoFar(spark, scratch_table(spark, "h5_day"), buckets=8)
    state.create()
    for tick in ("20240115001000", "20240115090000", "20240115133000", "20240115133000"):
        carried.h5_full_report(state, *_h5_inputs(spark, sf), report_window(tick))
    return carried.h5_full_report(state, *_h5_inputs(spark, sf), WINDOW)


@query("app_carried_report", with_views(app_report_sql(), *app_ctes(app_rows(), "rows_app")))
def app_carried_report(spark, sf):
    state = carried.DaySoFar(spark, scratch_table(spark, "app_day"), carried.APP_KEYS, buckets=8)
    state.create()
    carried.app_report(state, derived.app_log(spark, sf), report_window("20240115120000"))
    state.compact("20240115")
    return carried.app_report(state, derived.app_log(spark, sf), WINDOW)


# ---- stored pairs and sketches --------------------------------------------------------------

@query("h5_report_from_pairs", with_views(h5_full_sql(), *h5_full_ctes()))
def h5_report_from_pairs(spark, sf):
    names = [scratch_table(spark, n) for n in ("traffic_pairs", "activity_pairs")]
    for name in names:
        pairs.create(spark, name, buckets=8)
    pairs.store_h5(*_h5_inputs(spark, sf), DAYS, *names, buckets=8)
    return pairs.h5_full_report(spark, *names, WINDOW)


_SKETCHED = f"""SELECT qid, count(*) AS pv, {distinct_sql('uid')} AS uv, {distinct_sql('clientip')} AS ip
FROM rows_h5 WHERE dateline > {WINDOW.low + 36000} AND dateline <= {WINDOW.up} GROUP BY qid"""


@query("uv_from_sketches", with_views(_SKETCHED, h5_rows()))
def uv_from_sketches(spark, sf):
    """Channels from ten o'clock to the tick, from stored sketches of three days. Exact up to some 2,000 members a channel."""
    from tallyflow.plans.backfill import slotted

    rows, path = logs.h5_rules(slotted(derived.h5_log(spark, sf), DAYS)), scratch_path(spark, "sketches")
    own = sketches.slot_sketches(rows, ["qid"], {"visitor": F.col("uid"), "ip": F.col("clientip")})
    own.write.partitionBy("dt").parquet(path)
    stored = spark.read.schema(own.schema).parquet(path)
    some = stored.where((F.col("dt") == WINDOW.dt) & F.col("slot").between(61, (WINDOW.up - WINDOW.low) // 600))
    return sketches.range_counts(some, ["qid"], {"visitor": "uv", "ip": "ip"}, "visitor")


# ---- SQL ------------------------------------------------------------------------------------

def _registered(spark, sf):
    names = {n: _log_table(spark, getattr(derived, n)(spark, sf), c, n) for n, c in (
        ("basic_log", schema.BASIC_LOG), ("h5_log", schema.H5_LOG), ("h5_active_log", schema.H5_ACTIVE_LOG))}
    sqlfn.register_tables(spark, names)
    return names


@query("sql_h5_rows", with_views("SELECT dateline, clientip, qid, uid FROM rows_h5", h5_rows()))
def sql_h5_rows(spark, sf):
    _registered(spark, sf)
    return spark.sql(f"SELECT * FROM tf_h5_rows('{TICK}')")


@query("sql_basic_report", with_views(
    "SELECT qid, pv, uv, ip, incr_pv, incr_uv, incr_ip, false AS is_total FROM (SELECT * REPLACE (left(qid, 50) AS qid) FROM detail) "
    "UNION ALL SELECT qid, pv, uv, ip, incr_pv, incr_uv, incr_ip, true FROM total", *_basic_ctes()))
def sql_basic_report(spark, sf):
    _registered(spark, sf)
    return spark.sql(f"SELECT * FROM tf_basic_report('{TICK}')")


@query("sql_report_windows", """
SELECT event_id, strftime(CASE WHEN hour(ts) = 0 AND minute(ts) < 10 THEN ts - INTERVAL 1 DAY ELSE ts END, '%Y%m%d') AS dt,
  cast(floor(epoch(date_trunc('day', CASE WHEN hour(ts) = 0 AND minute(ts) < 10 THEN ts - INTERVAL 1 DAY ELSE ts END))) AS bigint) AS low,
  cast(floor(epoch(ts)) AS bigint) // 600 * 600 AS up FROM events""")
def sql_report_windows(spark, sf):
    """The window of every event's time, by a lateral join with the table function."""
    sqlfn.register_tables(spark, {})
    spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("tick")).createOrReplaceTempView("tallyflow_ticks")
    return spark.sql("SELECT event_id, w.dt, w.low, w.up FROM tallyflow_ticks, LATERAL tf_report_window(tick) w")


_RULES = {
    "exact": ("tf_visitor_exact(qid, uid, clientime)", "CASE WHEN qid = 'huitt' THEN clientime ELSE uid END"),
    "clipped": ("tf_clip(qid, 9)", "left(qid, 9)"),
    "kind": (r"tf_regex_group(qid, '([a-z]+)_(x)?([0-9])', 3)", "CASE WHEN regexp_matches(substr(qid, 4), '[a-z]_[0-9]') THEN regexp_extract(substr(qid, 4), '[a-z]_([0-9])', 1) END"),
    "absent": (r"tf_regex_group(qid, '([a-z]+)_(x)?([0-9])', 2)", "cast(NULL AS varchar)"),
}


@query("sql_functions_more", with_views(f"SELECT {', '.join(f'{sql} AS {name}' for name, (_, sql) in _RULES.items())} FROM h5_log"))
def sql_functions_more(spark, sf):
    sqlfn.register(spark)
    return derived.h5_log(spark, sf).selectExpr(*[f"{call} AS {name}" for name, (call, _) in _RULES.items()])
