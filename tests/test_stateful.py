"""Streams and their restarts, tables of the catalog, carried days, stored pairs, sketches, table functions."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallyflow import schema
from tallyflow.functions import sqlfn
from tallyflow.functions.timing import report_window
from tallyflow.operators import sketches
from tallyflow.plans import carried, pairs, reports, runs
from tallyflow.registry.base import WINDOW
from tallyflow.sinks import tables
from tallyflow.sources import derived, logs
from tallyflow.streaming import slots
from tests import model
from tests.oracle import SF_DIR

DAY = model.DAY


def name(label):
    return f"{label}_{uuid.uuid4().hex}"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def h5(spark):
    return [getattr(derived, n)(spark, SF_DIR).cache() for n in ("h5_log", "h5_active_log", "sdk_list")]


# ---- streams ------------------------------------------------------------------------------------

def basic_rows(spark, seen):
    """Log rows of (minute of the day, channel, visitor)."""
    data = [(DAY + int(60 * m), "ip", q, u, None, "20240115") for m, q, u in seen]
    return spark.createDataFrame(data, schema.BASIC_LOG).coalesce(1)


def by_hand(seen, until):
    """PV and UV per slot that ends up to minute ``until``."""
    out = {}
    for m, q, u in seen:
        end = (m // 10 + 1) * 10
        if end <= until:
            n, users = out.setdefault((end, q or "null"), (0, set()))
            out[end, q or "null"] = n + 1, users | {u or "null"}
    return sorted(("20240115", DAY + 60 * end, q, n, len(users)) for (end, q), (n, users) in out.items())


FIRST = [(1, "a", "x"), (2, "a", "x"), (9, "a", "y"), (3, None, None), (4, None, "null"), (10, "a", "x"), (31, "b", "z")]
SECOND = [(5, "a", "late"), (22, "c", "v"), (25, "c", "v"), (33, "b", "z"), (58, "b", "z")]
THIRD = [(90, "a", "x")]


def test_slots_over_restarts_and_late_rows(spark, tmp_path):
    log, target, checkpoint = (f"{tmp_path}/{n}" for n in ("log", "slots", "check"))

    def arrive(seen):
        tables.append_log_day(basic_rows(spark, seen), log)
        query = slots.run_available(slots.publish(slots.slot_counts(slots.read_stream(spark, log, schema.BASIC_LOG)), target, checkpoint))
        return query, rows(tables.read_table(spark, target, slots.SLOTS))

    query, got = arrive(FIRST)  # watermark 00:21
    assert got == by_hand(FIRST, 21) and slots.late_groups(query) == 0
    query, got = arrive(SECOND)  # the first row's slot has ended: late; watermark 00:48
    assert got == by_hand(FIRST + SECOND[1:], 48) and slots.late_groups(query) == 1
    _, got = arrive(THIRD)
    want = by_hand(FIRST + SECOND[1:] + THIRD, 80)
    assert got == want and ("20240115", DAY + 600, "null", 2, 1) in want
    query = slots.run_available(slots.publish(slots.slot_counts(slots.read_stream(spark, log, schema.BASIC_LOG)), target, checkpoint))
    assert rows(tables.read_table(spark, target, slots.SLOTS)) == want  # nothing new: nothing changes


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    """The stream dies after its batch was stored; the restart runs the same batch id again."""
    log, target, checkpoint = (f"{tmp_path}/{n}" for n in ("log", "slots", "check"))
    tables.append_log_day(basic_rows(spark, FIRST + SECOND), log)
    counts = slots.slot_counts(slots.read_stream(spark, log, schema.BASIC_LOG))
    ran = []

    def put_and_die(batch, batch_id):
        n = slots.put_batch(batch, target)
        ran.append((batch_id, n))
        if n:
            raise RuntimeError("lost after the write")

    dying = counts.writeStream.foreachBatch(put_and_die).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost after the write"):
        dying.awaitTermination()
    first = rows(tables.read_table(spark, target, slots.SLOTS))
    again = []
    query = counts.writeStream.foreachBatch(lambda b, i: again.append((i, slots.put_batch(b, target)))).option("checkpointLocation", checkpoint)
    slots.run_available(query)
    assert ran[-1] in again and ran[-1][1] > 0  # the same batch, with the same rows
    assert rows(tables.read_table(spark, target, slots.SLOTS)) == first == by_hand(FIRST + SECOND, 48)


def test_published_stream_is_the_batch_report(spark, tmp_path):
    """Slots in a table of the catalog, summed over the complete slices, are the sliced day."""
    log, target = f"{tmp_path}/log", name("slots")
    tables.create(spark, target, slots.SLOTS)
    tables.append_log_day(derived.basic_log(spark, SF_DIR).where("dt = '20240115'").coalesce(2), log)
    slots.run_available(slots.publish(slots.slot_counts(slots.read_stream(spark, log, schema.BASIC_LOG)), target, f"{tmp_path}/check"))
    now = DAY + 13 * 3600
    found = tables.read_table(spark, target, slots.SLOTS).where(F.col("upto") <= now).groupBy("qid").agg(F.sum("uv").alias("uv"))
    want = reports.sliced_day_report(derived.basic_log(spark, SF_DIR), "20240115", DAY, now).where("not is_total").select("qid", "uv")
    assert rows(found) == rows(want)


def test_first_visits_are_stored_once(spark, tmp_path):
    log, out = f"{tmp_path}/log", f"{tmp_path}/visits"
    start = lambda: slots.store(slots.first_visits(slots.read_stream(spark, log, schema.BASIC_LOG)), out, f"{tmp_path}/check")
    for seen in (FIRST[:3], FIRST[3:] + FIRST[:1], THIRD):  # a row of the first batch again, before its slot has ended
        tables.append_log_day(basic_rows(spark, seen), log)
        slots.run_available(start())
    slots.run_available(start())
    got = rows(spark.read.schema("upto bigint, qid string, uid string, dt string").parquet(out).select("upto", "qid", "uid"))
    want = {(DAY + 60 * (m // 10 + 1) * 10, q or "null", u or "null") for m, q, u in FIRST + THIRD}
    assert got == sorted(want, key=str)


# ---- tables of the catalog ----------------------------------------------------------------------

def test_catalog_slices(spark, h5):
    staging, final = name("staging"), name("final")
    for n in (staging, final):
        tables.create(spark, n, tables.H5)
        tables.create(spark, n, tables.H5)  # once is enough
    other = report_window("20240115120000")
    for w in (WINDOW, other, WINDOW):
        runs.run_h5_full(spark, *h5, w, staging, final)
    for w in (WINDOW, other):
        want = tables.max_merge(reports.h5_full_report(*h5, w), tables.H5)
        assert rows(tables.read_slice(spark, final, tables.H5, w.dt, w.up)) == rows(want)
    plan = plan_of(tables.read_slice(spark, final, tables.H5, WINDOW.dt, WINDOW.up))
    assert "PartitionFilters: [isnotnull(dt#" in plan and "InMemoryFileIndex(1 paths)" in plan  # one partition is listed
    # an empty report empties its slice and no other
    assert tables.overwrite_slice(reports.h5_full_report(*h5, other).limit(0), final, tables.H5, other.dt, other.up) == 0
    assert tables.read_slice(spark, final, tables.H5, other.dt, other.up).isEmpty()
    assert not tables.read_slice(spark, final, tables.H5, WINDOW.dt, WINDOW.up).isEmpty()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"  # the session's own again
    tables.truncate(spark, final, tables.H5)
    assert tables.read_table(spark, final, tables.H5).isEmpty()


@pytest.mark.parametrize("kind", ["path", "table"])
def test_days_are_replaced_by_one_write(spark, tmp_path, kind):
    log = derived.basic_log(spark, SF_DIR)
    final = f"{tmp_path}/days" if kind == "path" else name("days")
    if kind == "table":
        tables.create(spark, final, tables.H5)
    report = reports.h5_basic_report(log, WINDOW)
    stale = report.withColumn("currenttime", F.col("currenttime") + 1)  # no tick of any day
    tables.append(stale.union(stale.withColumn("dt", F.lit(20240113))), final, tables.H5)
    n = runs.run_h5_basic_backfill(log, ["20240115", "20240116"], final)
    got = tables.read_table(spark, final, tables.H5).cache()
    assert got.where("dt <> 20240113").count() == n and got.where("dt = 20240113").count() == stale.count()
    assert got.where("dt <> 20240113 and currenttime % 600 <> 0").isEmpty()
    one = tables.max_merge(report, tables.H5)
    assert rows(got.where(tables.H5.at(WINDOW.dt, WINDOW.up))) == rows(one)
    got.unpersist()


def test_log_days_of_a_table_are_pruned(spark, h5):
    log, days = name("log"), ["20240114", "20240116"]
    tables.create_log(spark, log, schema.H5_LOG)
    for d in days:
        tables.append_log_day(h5[0].where(F.col("dt") == d), log)
    tables.append_log_day(h5[0].where("dt = '20240116'"), log)
    assert spark.table(log).groupBy("dt").count().orderBy("dt").collect() == [
        ("20240114", h5[0].where("dt = '20240114'").count()), ("20240116", 2 * h5[0].where("dt = '20240116'").count())]
    plan = plan_of(logs.in_window(logs.read_log(spark, log, schema.H5_LOG), report_window("20240114120000")))
    assert "PartitionFilters: [isnotnull(dt#" in plan and "InMemoryFileIndex(1 paths)" in plan


# ---- the day so far, carried ----------------------------------------------------------------------

TICKS = ["20240115000500", "20240115001000", "20240115002000", "20240115090000", "20240115091000", "20240115092000", "20240116000300", "20240116001000"]


def carried_state(spark, keys=carried.H5_KEYS):
    state = carried.DaySoFar(spark, name("day"), keys, 4)
    state.create()
    return state


def test_every_carried_tick_is_the_full_report(spark, h5):
    """Ticks in order, with a lost stretch, a repeated run, an earlier tick again, and the change of day."""
    state = carried_state(spark)
    for tick in [*TICKS[:5], TICKS[4], TICKS[2], *TICKS[5:]]:
        w = report_window(tick)
        assert rows(carried.h5_full_report(state, *h5, w)) == rows(reports.h5_full_report(*h5, w)), tick
    assert state.finished("20240115") == [report_window(t).up for t in TICKS[1:7]]


def test_a_run_that_died_leaves_no_trace(spark, h5):
    """Members were stored, counts were not: the next ticks are right, and so is the same tick again."""
    state, at = carried_state(spark), [report_window(t) for t in TICKS[3:6]]
    carried.h5_full_report(state, *h5, at[0])
    step = state.step(at[1])
    spread = reports.h5_full_facts(logs.h5_rules(step.rows(h5[0])), logs.h5_active_rules(step.rows(h5[1])), h5[2])
    new = step.marked(spread).where("is_new").select(state.tuple).withColumns({"dt": F.lit(at[1].dt), "upto": F.lit(at[1].up).cast("bigint")})
    tables.insert(new, state.members)
    assert not new.isEmpty() and state.finished("20240115") == [at[0].up]
    for w in (at[2], at[1], at[2]):
        assert rows(carried.h5_full_report(state, *h5, w)) == rows(reports.h5_full_report(*h5, w))
    before = state.spark.table(state.members).count()
    state.compact("20240115")
    members = state.spark.table(state.members)
    assert members.count() == members.select(state.tuple).distinct().count() < before
    last = report_window("20240115100000")
    assert rows(carried.h5_full_report(state, *h5, last)) == rows(reports.h5_full_report(*h5, last))
    state.forget("20240115")
    assert state.finished("20240115") == [] and state.spark.table(state.members).isEmpty()
    assert rows(carried.h5_full_report(state, *h5, last)) == rows(reports.h5_full_report(*h5, last))


def test_carried_ticks_read_ten_minutes_and_shuffle_no_state(spark, h5):
    state, plain = carried_state(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    carried.h5_full_report(state, *h5, report_window("20240115090000"))
    read = []
    for tick in ("20240115091000", "20240115092000", "20240115093000"):
        step = state.step(report_window(tick))
        read.append(step.rows(h5[0]).count())
        carried.h5_full_report(state, *h5, report_window(tick))
    assert max(read) < 4 * max(1, min(read)) and sum(read) < 0.2 * logs.in_window(h5[0], report_window("20240115093000")).count()
    log = name("log")
    tables.create_log(spark, log, schema.H5_LOG)
    tables.append_log_day(h5[0], log)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        step = state.step(report_window("20240115094000"))
        own = reports.h5_full_facts(logs.h5_rules(step.rows(spark.table(log))), logs.h5_active_rules(step.rows(h5[1])), h5[2])
        plan = plan_of(step.marked(own))
        assert f"GreaterThan(dateline,{step.since})" in plan
        side = plan[: plan.index(state.members)].splitlines()[-6:] + plan[plan.index(state.members) :].splitlines()[:1]
        assert not any("Exchange" in x for x in side) and "Bucketed: true" in "".join(side)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)


def test_carried_app_report(spark):
    log, state = derived.app_log(spark, SF_DIR), carried_state(spark, carried.APP_KEYS)
    for tick in ("20240115060000", "20240115061000", "20240115200000"):
        w = report_window(tick)
        assert rows(carried.app_report(state, log, w)) == rows(reports.app_report(log, w))


# ---- stored pairs and sketches --------------------------------------------------------------------

def test_reports_from_pairs_take_one_shuffle_less(spark, h5):
    names = [name("traffic"), name("activity")]
    for n in names:
        pairs.create(spark, n, buckets=4)
    for _ in range(2):  # stored again, in place
        pairs.store_h5(*h5, ["20240114", "20240115"], *names, buckets=4)
    for tick in ("20240115001000", "20240115134000", "20240116000000", "20240114235959", "20240115000000"):
        w = report_window(tick)
        assert rows(pairs.h5_full_report(spark, *names, w)) == rows(reports.h5_full_report(*h5, w)), tick
    plan = plan_of(pairs.h5_full_report(spark, *names, WINDOW))
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange hashpartitioning") == 1  # groups only
    assert "member" not in plan[plan.index("Exchange hashpartitioning") :].splitlines()[0]
    plain = [getattr(derived, n)(spark, SF_DIR) for n in ("h5_log", "h5_active_log", "sdk_list")]
    assert plan_of(reports.h5_full_report(*plain, WINDOW)).split("BroadcastExchange")[0].count("Exchange hashpartitioning") >= 2


def test_sketches_of_any_range(spark):
    """Exact while sketches are lists; beyond that within three standard errors, also after merging many slots."""
    many = spark.range(400_000).select(
        F.lit("20240115").alias("dt"), (F.col("id") % 144).cast("int").alias("slot"), F.concat(F.lit("q"), F.col("id") % 3).alias("qid"),
        F.when(F.col("id") % 1000 == 0, None).otherwise(F.col("id") % 70_001).alias("uid"), (F.col("id") % 900).alias("ip"))
    own = sketches.slot_sketches(many, ["qid"], {"visitor": F.col("uid"), "ip": F.col("ip")}).cache()
    for lo, hi in ((0, 143), (7, 7), (20, 100)):
        some = F.col("slot").between(lo, hi)
        got = {r.qid: r for r in sketches.range_counts(own.where(some), ["qid"], {"visitor": "uv", "ip": "ips"}, "visitor").collect()}
        for r in many.where(some).groupBy("qid").agg(F.count("*").alias("pv"), F.count_distinct(F.struct("uid")).alias("uv"), F.count_distinct("ip").alias("ips")).collect():
            assert (got[r.qid].pv, got[r.qid].ips) == (r.pv, r.ips)
            assert abs(got[r.qid].uv - r.uv) <= (3 * sketches.relative_error() * r.uv if r.uv > 2048 else 0)
    assert own.agg(F.max(F.length("sketch"))).first()[0] <= 2 ** sketches.LG + 64
    (none,) = sketches.range_counts(own.limit(0), [], {"visitor": "uv"}, "visitor").collect()
    assert tuple(none) == (0, 0)
    own.unpersist()


# ---- table functions ------------------------------------------------------------------------------

def test_table_functions_push_the_window_down(spark, h5):
    names = {n: name(n) for n in ("basic_log", "h5_log", "h5_active_log")}
    for n, c in (("basic_log", schema.BASIC_LOG), ("h5_log", schema.H5_LOG), ("h5_active_log", schema.H5_ACTIVE_LOG)):
        tables.create_log(spark, names[n], c)
        tables.append_log_day(getattr(derived, n)(spark, SF_DIR), names[n])
    assert sqlfn.register_tables(spark, names) == ["tf_report_window", "tf_basic_rows", "tf_basic_report", "tf_h5_rows", "tf_h5_active_rows"]
    for tick in ("20240115134731", "20240116000512", "20240115001000"):
        w = report_window(tick)
        assert tuple(spark.sql(f"SELECT * FROM tf_report_window('{tick}')").first()) == tuple(w)
        got = spark.sql(f"SELECT * FROM tf_h5_rows('{tick}')")
        assert rows(got) == rows(logs.h5_clean(h5[0], w).select("dateline", "clientip", "qid", "uid"))
        plan = plan_of(got)
        assert f"(dt#" in plan and f"= {w.dt})" in plan.split("PartitionFilters")[1] and f"GreaterThanOrEqual(dateline,{w.low})" in plan
        want = logs.h5_active(h5[1], w).select("dateline", "qid", "uid")
        assert rows(spark.sql(f"SELECT * FROM tf_h5_active_rows('{tick}')")) == rows(want)


def test_regex_group_without_a_part_in_the_match(spark):
    from tallyflow.functions import clean

    sqlfn.register(spark)
    df = spark.createDataFrame([("xa1",), ("xab1",), ("xa",), ("",), (None,), ("xb",)], "s string")
    for pattern, index, want in ((r"a(b)?(\d)?", 1, [None, "b", None, None, None, None]), (r"a(b)?(\d*)", 2, [None, None, None, None, None, None])):
        text = df if index == 1 else df.where("s is null or s = ''")
        both = text.select(clean.regex_group(F.col("s"), pattern, index).alias("c"), F.expr(f"tf_regex_group(s, '{pattern.replace(chr(92), chr(92) * 2)}', {index})").alias("f"))
        got = both.collect()
        assert [r.c for r in got] == [r.f for r in got] == want[: len(got)]
    empty = spark.createDataFrame([("xa",)], "s string").select(clean.regex_group(F.col("s"), r"a(\d*)", 1).alias("c")).first()
    assert empty.c == ""  # an empty group did take part


