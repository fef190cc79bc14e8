import pytest
from pyspark.sql import functions as F

from tallyflow import schema
from tallyflow.functions.timing import report_window
from tallyflow.operators import counts, metrics, rollups
from tallyflow.plans import backfill, reports
from tallyflow.registry.base import WINDOW
from tallyflow.sinks import tables
from tallyflow.sources import derived, logs
from tests import model
from tests.oracle import SF_DIR

TICKS = ["20240115134000", "20240115001000", "20240115000000", "20240116000300", "20240115235959", "20240120120000"]


def frame(spark, rows, types, rename=()):
    rename = dict(rename)
    names = [f.name for f in types]
    data = [tuple(r[rename.get(n, n)] for n in names) for r in rows]
    return spark.createDataFrame(data, types)


@pytest.fixture(scope="module")
def random_log(spark):
    rows, active = model.random_logs(11)
    return {
        "rows": rows,
        "active": active,
        "app_rows": [r | {"appqid": r["qid"]} for r in rows],
        "h5": frame(spark, rows, schema.H5_LOG).cache(),
        "h5_active": frame(spark, active, schema.H5_ACTIVE_LOG).cache(),
        "app": frame(spark, rows, schema.APP_LOG, [("appqid", "qid")]).cache(),
        "basic": frame(spark, rows, schema.BASIC_LOG).cache(),
        "sdk": spark.createDataFrame([(s,) for s in model.SDK], schema.SDK_LIST),
    }


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


H5_ROW = ["qid", *metrics.METRICS]
APP_ROW = ["apptypeid", "qid", *model.METRICS]


def collected(df, columns):
    return sorted(tuple(r) for r in df.select(columns).collect())


@pytest.mark.parametrize("tick", TICKS)
def test_h5_full_report(random_log, tick):
    w = report_window(tick)
    df = reports.h5_full_report(random_log["h5"], random_log["h5_active"], random_log["sdk"], w)
    assert df.schema.simpleString() == schema.H5_METRICS.simpleString()
    assert collected(df, H5_ROW) == model.h5_full(random_log["rows"], random_log["active"], model.SDK, w)
    assert {tuple(r) for r in df.select("dt", "currenttime").collect()} == {(int(w.dt), w.up)}


@pytest.mark.parametrize("tick", TICKS)
def test_app_and_news_reports(random_log, tick):
    w = report_window(tick)
    app = reports.app_report(random_log["app"], w)
    assert app.schema.simpleString() == schema.APP_METRICS.simpleString()
    assert collected(app, APP_ROW) == model.app_report(model.app_rows(random_log["app_rows"], w), w)
    news = reports.news_report(random_log["app"], w)
    assert collected(news, APP_ROW) == model.app_report(model.news_rows(random_log["app_rows"], w), w)


def test_large_channel_list_gives_the_same(spark, random_log):
    rows = logs.h5_clean(random_log["h5"], WINDOW)
    sdk = random_log["sdk"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (rollups.sdk_rows, rollups.flag_sdk):
            small, large, shuffled = join(rows, sdk), join(rows, sdk, list_rows=0), join(rows, sdk, list_rows=0, matched_rows=0)
            assert "BroadcastHashJoin" in plan_of(small) and "BroadcastHashJoin" in plan_of(large)
            # only rows that pass the filter are shuffled; the hot channels alone are broadcast
            assert "ShuffledHashJoin" in plan_of(shuffled) and "getbit" in plan_of(shuffled) and "Subquery" in plan_of(shuffled)
            assert small.columns == large.columns == shuffled.columns and small.count() > 0
            for other in (large, shuffled):
                assert small.exceptAll(other).isEmpty() and other.exceptAll(small).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bloom_filter_drops_no_listed_channel(spark):
    channels = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("h5qid"))
    others = spark.range(20_000).select(F.concat(F.lit("d"), "id").alias("qid"))
    for max_bits, most in ((rollups.MAX_BLOOM_BITS, 0.05), (1 << 12, 1.0)):
        bits, size = rollups.bloom_filter(channels, 3000, max_bits)
        might = rollups.might_be_listed(F.col("qid"), bits, size)
        assert channels.select(F.col("h5qid").alias("qid")).where(might).count() == 3000
        assert others.where(might).count() <= most * 20_000
        assert len(bits.first().words) == size // 64 <= max_bits // 64
    none = spark.createDataFrame([(None,)], "qid string")
    assert none.where(might).isEmpty() and none.where(~might).count() == 1


def test_filtered_list_shuffles_no_hot_channel_and_few_other_rows(spark):
    """Half of the rows are on a listed channel, a third on another one; of the rest one in ten is listed."""
    rows = spark.range(0, 60_000, 1, 4).selectExpr(
        "1 AS dateline", "CASE WHEN id % 6 < 3 THEN 'hot' WHEN id % 6 < 5 THEN 'cold' WHEN id % 60 = 5 THEN concat('c', id % 2000) "
        "ELSE concat('x', id) END AS qid", "concat('u', id) AS uid")
    sdk = spark.range(2000).selectExpr("concat('c', id) AS h5qid").union(spark.createDataFrame([("hot",), ("hot",), (None,)], "h5qid string"))
    plan = rollups._plan(rows, rollups.channel_list(sdk), 0, 0)
    assert isinstance(plan, rollups.Filtered)
    assert sorted(map(tuple, plan.hot.collect())) == [("cold", False), ("hot", True)]
    sent = rollups.candidates(rows, plan)
    assert sent.where("qid in ('hot', 'cold')").isEmpty()
    assert 1000 <= sent.count() < 1500  # of 60,000
    flagged = rollups.flag_sdk(rows, sdk, 0, 0)
    assert flagged.count() == 60_000 and flagged.where("in_sdk").count() == 31_000 == rollups.sdk_rows(rows, sdk, 0, 0).count()
    assert flagged.where("in_sdk <> (qid = 'hot' or qid like 'c%' and qid <> 'cold')").isEmpty()


def test_broadcast_limits(spark):
    channels = rollups.channel_list(spark.range(1000).selectExpr("concat('c', id % 500) AS h5qid"))
    assert rollups.fits_broadcast(channels)
    assert not rollups.fits_broadcast(channels, max_rows=499)
    assert not rollups.fits_broadcast(channels, max_bytes=100)
    assert rollups.fits_broadcast(channels.limit(0))


def test_spread_groups_equal_union(random_log):
    rows = logs.h5_clean(random_log["h5"], WINDOW)
    spread = rollups.with_rollups(rollups.flag_sdk(rows, random_log["sdk"]))
    union = rollups.union_rollups(rows, random_log["sdk"]).select(spread.columns)
    assert spread.exceptAll(union).isEmpty() and union.exceptAll(spread).isEmpty()


def test_three_plans_agree(random_log):
    w = report_window("20240115134000")
    rows = logs.h5_clean(random_log["h5"], w).withColumn("qid", F.lower("qid"))
    one_pass = metrics.one_pass_metrics(rows, ["qid"], "uid", "clientip", w.up)
    joined = metrics.joined_metrics(rows, ["qid"], "uid", "clientip", w.up)
    columns = ["qid", *model.METRICS]
    assert collected(one_pass, columns) == collected(joined, columns)
    full = reports.h5_full_report(random_log["h5"], random_log["h5_active"], random_log["sdk"], w)
    chain = reports.h5_full_joined(random_log["h5"], random_log["h5_active"], random_log["sdk"], w)
    total = [r for r in collected(full, H5_ROW) if r[0] == "total"]
    # the chain has no total row; a channel called total is in both
    left = collected(full, H5_ROW)
    for r in collected(chain, H5_ROW):
        left.remove(r)
    assert len(left) == 1 and left[0] in total


def test_salted_equals_plain(random_log):
    pairs = counts.distinct_pairs(random_log["h5"], "uid", ["qid"])
    salted = counts.salted_members_by(pairs, ["qid"], "uid", "uv")
    plain = counts.members_by(pairs, ["qid"], "uv")
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_basic_report_merges_null_with_its_text(random_log):
    w = report_window("20240115134000")
    rows = [r for r in random_log["rows"] if model.inside(r, w)]
    text = lambda v: "null" if v is None else v
    by = lambda r: [(text(r["qid"]).lower(), 1)]
    fixed = [r | {"uid": text(r["clientime"] if r["qid"] == "huitt" else r["uid"]), "clientip": text(r["clientip"])} for r in rows]
    want = [(q[:50], *[m[k] for k in model.METRICS]) for q, m in model.count(by, fixed, w.up).items()]
    want += [("total", *[m[k] for k in model.METRICS]) for m in model.count(lambda r: [("t", 1)], fixed, w.up).values()]
    got = collected(reports.h5_basic_report(random_log["basic"], w), ["qid", *model.METRICS])
    assert got == sorted(want)


def test_sliced_day(random_log):
    now = model.DAY + 13 * 3600 + 47 * 60
    text = lambda v: "null" if v is None else v
    end = model.DAY + (now - model.DAY) // 600 * 600
    rows = [r for r in random_log["rows"] if r["dt"] == model.DT and model.DAY <= r["dateline"] < end]
    seen = {((r["dateline"] - model.DAY) // 600, text(r["uid"]), text(r["qid"])) for r in rows}
    want = {}
    for _, _, q in seen:
        want[q] = want.get(q, 0) + 1
    report = reports.sliced_day_report(random_log["basic"], model.DT, model.DAY, now).cache()
    assert dict(collected(report.where("not is_total"), ["qid", "uv"])) == want
    assert [r.uv for r in report.where("is_total").collect()] == [len({u for _, u, _ in seen})]
    nothing = reports.sliced_day_report(random_log["basic"].limit(0), model.DT, model.DAY, now)
    assert collected(nothing, ["is_total", "qid", "uv"]) == [(True, None, 0)]


def test_join_forms_scan_each_log_once_per_member(spark):
    """The full form reads the traffic log twice and the activity log once, besides the channel list."""
    logs_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation")
    sdk = spark.createDataFrame([("click_1",)], "h5qid string")
    full = reports.h5_full_joined(derived.h5_log(spark, SF_DIR), derived.h5_active_log(spark, SF_DIR), sdk, WINDOW)
    assert logs_of(full) == 3
    assert logs_of(reports.h5_basic_joined(derived.basic_log(spark, SF_DIR), WINDOW)) == 2


# ---- empty windows ----------------------------------------------------------------------------

def test_idle_window(random_log):
    empty = report_window("20240120120000")
    full = reports.h5_full_report(random_log["h5"], random_log["h5_active"], random_log["sdk"], empty)
    assert collected(full, H5_ROW) == [("total", 0, 0, 0, 0, 0, 0, 0, 0)]
    assert collected(reports.h5_basic_report(random_log["basic"], empty), H5_ROW) == [("total", 0, 0, 0, 0, 0, 0, 0, 0)]
    assert reports.mini_program_report(random_log["h5"], random_log["h5_active"], empty).isEmpty()
    assert reports.app_report(random_log["app"], empty).isEmpty()
    assert counts.total_members(random_log["h5"].limit(0), "uid", "uv").first().uv == 0
    assert counts.total_rows(random_log["h5"].limit(0)).first().pv == 0


# ---- backfill -----------------------------------------------------------------------------------

def test_backfill_equals_every_single_report(random_log):
    """All 144 ticks of the day, midnight of the next day included."""
    got = {}
    for r in backfill.h5_full_backfill(
        random_log["h5"], random_log["h5_active"], random_log["sdk"], [model.DT]
    ).collect():
        assert r.dt == int(model.DT)
        got.setdefault(r.currenttime, []).append(tuple(r[c] for c in H5_ROW))
    assert len(got) == 144
    for k in range(1, 145):
        up = model.DAY + k * 600
        w = report_window("20240116000000") if k == 144 else report_window(f"20240115{k // 6:02d}{k % 6}000")
        assert w.up == up
        assert sorted(got[up]) == model.h5_full(random_log["rows"], random_log["active"], model.SDK, w), k


@pytest.mark.parametrize("name", ["basic", "app", "news", "app_active"])
def test_other_backfills_equal_single_reports(spark, random_log, name):
    filled, single, log = {
        "basic": (backfill.h5_basic_backfill, reports.h5_basic_report, random_log["basic"]),
        "app": (backfill.app_backfill, reports.app_report, random_log["app"]),
        "news": (backfill.news_backfill, reports.news_report, random_log["app"]),
        "app_active": (backfill.app_active_backfill, reports.app_active_report, derived.app_active_log(spark, SF_DIR)),
    }[name]
    every = filled(log, [model.DT, "20240116"]).cache()
    for tick in ("20240115134000", "20240115001000", "20240116000000", "20240116120000"):
        w = report_window(tick)
        want = single(log, w)
        at = every.where((F.col(every.columns[1]) == w.up) & (F.col("dt") == int(w.dt)))
        assert at.exceptAll(want).isEmpty() and want.exceptAll(at).isEmpty(), tick
    # a group appears from its first traffic on, so early ticks may be empty
    assert every.count() > 1000
    every.unpersist()


@pytest.mark.parametrize(("dt", "after", "hours"), [("20241103", "20241104", 25), ("20240310", "20240311", 23), ("20240601", "20240602", 24)])
def test_days_of_any_length(spark, random_log, dt, after, hours):
    """On days on which clocks change, every row counts, ticks end at midnight, and the report of the whole day is whole."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        w = report_window(f"{after}000000", "America/New_York")
        assert (w.dt, w.up - w.low) == (dt, hours * 3600)
        columns = [F.col(f.name) if f.name in ("dt", "dateline", "uid") else F.lit("x").cast(f.dataType).alias(f.name) for f in random_log["basic"].schema]
        rows = spark.range(hours * 6).select(F.lit(dt).alias("dt"), (F.col("id") * 600 + w.low + 1).alias("dateline"), F.col("id").cast("string").alias("uid"))
        log = rows.select(columns)
        want = reports.h5_basic_report(log, w)
        every = backfill.h5_basic_backfill(log, [dt])
        time = F.col(every.columns[1])
        ticks = [r[0] for r in every.where(F.col("qid") == "total").select(time).orderBy(time).collect()]
        assert ticks == [w.low + 600 * k for k in range(1, hours * 6 + 1)]
        last = every.where(time == w.up)
        assert last.exceptAll(want).isEmpty() and want.exceptAll(last).isEmpty()
        assert want.where(F.col("qid") == "total").first()["pv"] == hours * 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# ---- publishing -----------------------------------------------------------------------------------

def test_publish_twice_changes_nothing(spark, random_log, tmp_path):
    from tallyflow.plans import runs

    staging, final = str(tmp_path / "staging"), str(tmp_path / "final")
    args = (spark, random_log["h5"], random_log["h5_active"], random_log["sdk"])
    w = report_window("20240115134000")
    other = report_window("20240115133000")
    runs.run_h5_full(*args, other, staging, final)
    n = runs.run_h5_full(*args, w, staging, final)
    first = collected(tables.read_table(spark, final, tables.H5), ["dt", "currenttime", *H5_ROW])
    assert runs.run_h5_full(*args, w, staging, final) == n
    assert collected(tables.read_table(spark, final, tables.H5), ["dt", "currenttime", *H5_ROW]) == first
    # keys are unique after the merge, and the merge took maxima
    assert len({r[:3] for r in first}) == len(first)
    staged = tables.read_slice(spark, staging, tables.H5, w.dt, w.up)
    assert staged.count() > n  # long labels and a channel called total met
    runs.run_mini_program(spark, random_log["h5"], random_log["h5_active"], w, staging, final)
    assert collected(tables.read_table(spark, final, tables.H5), ["dt", "currenttime", *H5_ROW]) == first


def test_empty_report_clears_its_slice(spark, random_log, tmp_path):
    from tallyflow.plans import runs

    staging, final = str(tmp_path / "staging"), str(tmp_path / "final")
    w = report_window("20240115134000")
    assert runs.run_app(spark, random_log["app"], w, staging, final) > 0
    assert runs.run_app(spark, random_log["app"].limit(0), w, staging, final) == 0
    assert tables.read_slice(spark, final, tables.APP, w.dt, w.up).isEmpty()
    tables.truncate(spark, staging, tables.APP)
    assert tables.read_table(spark, staging, tables.APP).isEmpty()


def test_backfill_publishes_what_single_runs_publish(spark, random_log, tmp_path):
    from tallyflow.plans import runs

    inputs = random_log["h5"], random_log["h5_active"], random_log["sdk"]
    filled, staging, final = (str(tmp_path / n) for n in ("filled", "staging", "final"))
    n = runs.run_h5_full_backfill(*inputs, [model.DT], filled)
    back = tables.read_table(spark, filled, tables.H5)
    assert back.count() == n and back.select("currenttime").distinct().count() == 144
    for tick in ("20240115134000", "20240116000000"):
        w = report_window(tick)
        runs.run_h5_full(spark, *inputs, w, staging, final)
        single = tables.read_slice(spark, final, tables.H5, w.dt, w.up)
        at = tables.read_slice(spark, filled, tables.H5, w.dt, w.up)
        assert at.exceptAll(single).isEmpty() and single.exceptAll(at).isEmpty()


def test_small_sinks(spark, random_log, tmp_path):
    path = str(tmp_path / "log")
    tables.append_log_day(random_log["h5"], path)
    tables.append_log_day(random_log["h5"], path)
    again = logs.read_log(spark, path, schema.H5_LOG)
    assert again.count() == 2 * random_log["h5"].count()
    assert again.schema["dt"].dataType.simpleString() == "string"
    quoted = spark.createDataFrame([("a'b'",)], "qid string")
    assert tables.strip_quotes(quoted).first().qid == "ab"
    tables.show_total(reports.h5_basic_report(random_log["basic"], WINDOW))


def test_scratch_path_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert tables.scratch_path(spark, "x").startswith(shared)


# ---- plans ------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The logs as tables on files, partitioned by day."""
    base = tmp_path_factory.mktemp("logs")
    out = {}
    for name, types in (("h5_log", schema.H5_LOG), ("h5_active_log", schema.H5_ACTIVE_LOG), ("app_log", schema.APP_LOG)):
        tables.append_log_day(getattr(derived, name)(spark, SF_DIR), f"{base}/{name}")
        out[name] = logs.read_log(spark, f"{base}/{name}", types)
    return out


def test_report_on_stored_logs_prunes_and_pushes_down(spark, stored):
    sdk = derived.sdk_list(spark, SF_DIR)
    df = reports.h5_full_report(stored["h5_log"], stored["h5_active_log"], sdk, WINDOW)
    want = reports.h5_full_report(derived.h5_log(spark, SF_DIR), derived.h5_active_log(spark, SF_DIR), sdk, WINDOW)
    assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
    plan = plan_of(df)
    assert plan.count("PartitionFilters: [isnotnull(dt#") == 2
    assert f"GreaterThanOrEqual(dateline,{WINDOW.low})" in plan and f"LessThanOrEqual(dateline,{WINDOW.up})" in plan
    assert "ReadSchema: struct<dateline:bigint,uid:string,qid:string>" in plan  # the activity log's three columns
    # one scan per log, the list on each side, no sort, no shuffled join, no Python
    assert plan.count("/h5_log]") == 1 and plan.count("/h5_active_log]") == 1
    for node in ("SortMergeJoin", "ShuffledHashJoin", "Python", "Cartesian", "NestedLoop"):
        assert node not in plan
    # rows are combined before the first shuffle and again before the second
    assert plan.count("hashpartitioning(grain") == 3


def test_app_report_is_two_shuffles_over_one_scan(stored):
    plan = plan_of(reports.app_report(stored["app_log"], WINDOW))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_no_python_workers_anywhere(spark):
    from tallyflow import registry

    for name in ("scan_app_news", "fn_trim_date", "fn_regexp_extract", "h5_backfill", "word_count", "agg_salted"):
        assert "Python" not in plan_of(registry.ALL[name].run(spark, SF_DIR)), name
