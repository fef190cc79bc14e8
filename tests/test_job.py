"""The job that a scheduler starts, on stored logs, against the reports it runs."""

import pytest
from pyspark.sql import functions as F

from tallyflow import job, schema
from tallyflow.functions.timing import session_report_window
from tallyflow.plans import reports, runs
from tallyflow.sinks import tables
from tallyflow.sources import derived
from tests.oracle import SF_DIR

TICK = "20240115134731"


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("job"))
    for name in ("basic_log", "h5_log", "h5_active_log", "app_log", "app_active_log"):
        getattr(derived, name)(spark, SF_DIR).write.partitionBy("dt").parquet(f"{top}/{name}")
    derived.sdk_list(spark, SF_DIR).write.parquet(f"{top}/sdk")
    return top


def rows(df):
    return sorted(map(tuple, df.collect()))


def published(spark, top, name, table, report):
    w = session_report_window(spark, TICK)
    got = rows(tables.read_slice(spark, f"{top}/out/{name}", table, w.dt, w.up))
    assert got == rows(tables.max_merge(report, table)) and got
    return len(got)


def test_app_with_activity(spark, stores):
    args = ["app", TICK, "--log", f"{stores}/app_log", "--active", f"{stores}/app_active_log", "--out", f"{stores}/out"]
    w = session_report_window(spark, TICK)
    counts = job.main(args, spark)
    assert job.main(args, spark) == counts
    traffic = published(spark, stores, "app", tables.APP, reports.app_report(derived.app_log(spark, SF_DIR), w))
    active = published(spark, stores, "app_active", tables.APP, reports.app_active_report(derived.app_active_log(spark, SF_DIR), w))
    assert counts == (traffic, active)


def test_h5_then_mini_program(spark, stores):
    w = session_report_window(spark, TICK)
    common = [TICK, "--log", f"{stores}/h5_log", "--active", f"{stores}/h5_active_log", "--out", f"{stores}/out"]
    log, active, sdk = derived.h5_log(spark, SF_DIR), derived.h5_active_log(spark, SF_DIR), derived.sdk_list(spark, SF_DIR)
    full = reports.h5_full_report(log, active, sdk, w)
    job.main(["h5", *common, "--sdk", f"{stores}/sdk"], spark)
    published(spark, stores, "h5", tables.H5, full)
    job.main(["mini-program", *common], spark)
    published(spark, stores, "h5", tables.H5, full.unionByName(reports.mini_program_report(log, active, w)))


def test_missing_arguments_and_inputs_fail(spark, stores):
    for args in (["h5", TICK, "--log", "x", "--active", "y", "--out", "z"], ["app", TICK, "--log", "x", "--out", "z"], ["other", TICK]):
        with pytest.raises(SystemExit) as e:
            job.main(args, spark)
        assert e.value.code
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.main(["news", TICK, "--log", f"{stores}/none", "--out", f"{stores}/out"], spark)


@pytest.mark.parametrize("name", ["h5_basic", "news", "app_active"])
def test_published_backfill_replaces_whole_days(spark, stores, name):
    """Every slice is the single run's, and slices without rows are emptied; other days stay."""
    table = tables.H5 if name == "h5_basic" else tables.APP
    log = getattr(derived, {"h5_basic": "basic_log", "news": "app_log", "app_active": "app_active_log"}[name])(spark, SF_DIR)
    report = getattr(reports, f"{name}_report")
    final, day, time = f"{stores}/days_{name}", *table.slice
    w = session_report_window(spark, TICK)
    stale = report(log, w)
    tables.append(stale.withColumn(time, F.col(time) + 1).union(stale.withColumn(day, F.lit(20240113))), final, table)
    getattr(runs, f"run_{name}_backfill")(log, ["20240115", "20240117"], final)
    got = tables.read_table(spark, final, table)
    assert got.where(F.col(day) == 20240113).count() == stale.count()
    assert got.where(F.col(day) == 20240115).where(F.col(time) % 600 != 0).count() == 0
    for tick in ("20240115000500", TICK, "20240116000500"):
        w = session_report_window(spark, tick)
        one = rows(tables.max_merge(report(log, w), table)) if w.dt == "20240115" else []
        assert rows(got.where(table.at(w.dt, w.up))) == one
