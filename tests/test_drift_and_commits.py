"""A ping table whose files drifted, and the two-table commit."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from crashlens.operators.summary import summary_columns
from crashlens.params import fixture_params
from crashlens.plans.job import run_report_job
from crashlens.sources import commits
from crashlens.sources.drifting import file_layouts, read_drifting, read_drifting_pings
from crashlens.sources.fixtures import fixture_pings
from crashlens.sources.pings import PING_SCHEMA, RAW_COLUMNS
from tests.conftest import SF01, d

DAY = "submission_date_s3"
BASE = ("'c1' AS client_id, 'release' AS normalized_channel, 'Firefox' AS app_name, 5L AS subsession_length, 0L AS crash_submit_success_main, "
        "0L AS crashes_detected_content, 0L AS shutdown_kill, 1L AS crashes_detected_gmplugin, 0L AS crashes_detected_plugin, "
        "18000 AS profile_creation_date, true AS e10s_enabled, '0042' AS sample_id")


def _table(spark):
    where = tempfile.mkdtemp(prefix="crashlens-drift-") + "/t s"
    one = spark.sql(f"SELECT {BASE}")
    layouts = {
        "20240101": one.withColumn("extra", F.lit(1)),
        "20240102": one.drop("crashes_detected_gmplugin", "shutdown_kill").withColumn("e10s_enabled", F.lit(0)),
        "20240103": one.withColumn("subsession_length", F.lit("7")).unionByName(one.withColumn("subsession_length", F.lit("many"))),
        "20240104": one.withColumn("profile_creation_date", F.lit(18001.0)).withColumn("client_id", F.lit(7)),
        "20240105": one,
    }
    for day, rows in layouts.items():
        rows.withColumn(DAY, F.lit(day)).coalesce(1).write.mode("append").partitionBy(DAY, "sample_id").parquet(where)
    return where


def test_files_of_five_layouts_are_one_table(spark):
    where = _table(spark)
    assert file_layouts(spark, where, PING_SCHEMA.names).count() == 5
    pings = read_drifting_pings(spark, where)
    assert pings.columns == list(RAW_COLUMNS.values())
    rows = {(r.sd, r.ssl): r for r in pings.collect()}
    assert set(rows) == {("20240101", 5), ("20240102", 5), ("20240103", 7), ("20240103", None), ("20240104", 5), ("20240105", 5)}
    late = rows["20240102", 5]
    assert (late.cdgmp, late.sk, late.e10s, late.sid) == (None, None, False, "0042")
    assert (rows["20240104", 5].pcd, rows["20240104", 5].cid, rows["20240101", 5].e10s) == (18001, "7", True)


def test_one_scan_for_each_layout_and_filters_reach_it(spark):
    where = _table(spark)
    plan = read_drifting_pings(spark, where).where("sd = '20240103' AND channel = 'release'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4  # 1 January and 5 January have the wanted columns alike
    assert plan.count("PartitionFilters: [isnotnull(submission_date_s3") == 4 and plan.count("EqualTo(normalized_channel,release)") == 4


def test_no_files_and_bad_files(spark):
    empty = tempfile.mkdtemp(prefix="crashlens-drift-")
    assert read_drifting(spark, empty, PING_SCHEMA).collect() == []
    with open(os.path.join(empty, "x.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        read_drifting(spark, empty, PING_SCHEMA).count()
    with pytest.raises(Exception):
        read_drifting(spark, empty + "-none", PING_SCHEMA)


def _tables(spark, day, n, hours=(1, 2)):
    keys = ["date", "wau"]
    summary = spark.createDataFrame([(day, float(n), d(day))], "date string, wau double, end_date date")
    hist = spark.createDataFrame([(h, n, d(day)) for h in hours], "hours int, count long, end_date date")
    return keys, summary, hist


def _seen(spark, out):
    there = commits.snapshot(spark, out)
    return ({r.date: r.wau for r in there.summaries(["date", "wau"]).collect()},
            sorted((str(r.end_date), r.hours, r["count"]) for r in there.histograms().collect()))


@pytest.mark.parametrize("step", ["write_histograms", "write_summaries", "commit"])
def test_a_failure_at_any_step_shows_the_earlier_run_whole(spark, monkeypatch, step):
    out = tempfile.mkdtemp(prefix="crashlens-commit-")
    assert _seen(spark, out) == ({}, [])
    _, s, h = _tables(spark, "2024-01-08", 1)
    commits.publish(s, h, out)
    before = _seen(spark, out)
    assert before == ({"2024-01-08": 1.0}, [("2024-01-08", 1, 1), ("2024-01-08", 2, 1)])
    _, s, h = _tables(spark, "2024-01-08", 5, hours=(3,))

    def broken(*a):
        raise OSError("no space left")

    monkeypatch.setattr(commits, step, broken)
    with pytest.raises(OSError):
        commits.publish(s, h, out)
    assert _seen(spark, out) == before
    monkeypatch.undo()
    commits.publish(s, h, out)
    assert _seen(spark, out) == ({"2024-01-08": 5.0}, [("2024-01-08", 3, 5)])


def test_a_snapshot_stays_and_old_versions_expire(spark):
    out = tempfile.mkdtemp(prefix="crashlens-commit-")
    for day in ("2024-01-08", "2024-01-09"):
        _, s, h = _tables(spark, day, 1)
        commits.publish(s, h, out)
    then = commits.snapshot(spark, out)
    keys, s, h = _tables(spark, "2024-01-08", 2, hours=())
    commits.publish(s, h, out)
    assert {r.date: r.wau for r in then.summaries(keys).collect()} == {"2024-01-08": 1.0, "2024-01-09": 1.0}
    assert _seen(spark, out) == ({"2024-01-08": 2.0, "2024-01-09": 1.0}, [("2024-01-09", 1, 1), ("2024-01-09", 2, 1)])
    going_on = commits.new_version()
    commits.write_summaries(s, out, going_on)
    assert commits.expire(spark, out) == 1 and commits.expire(spark, out) == 0
    assert os.path.isdir(f"{out}/summary/version={going_on}")
    assert _seen(spark, out)[0] == {"2024-01-08": 2.0, "2024-01-09": 1.0}


def test_the_job_commits_both_tables_at_once(spark, monkeypatch):
    out, p = tempfile.mkdtemp(prefix="crashlens-commit-"), fixture_params()
    pings = fixture_pings(spark, SF01)

    def broken(*a):
        raise OSError("no space left")

    monkeypatch.setattr(commits, "commit", broken)
    with pytest.raises(OSError):
        run_report_job(spark, pings, out, p, buckets=4, versioned=True)
    assert commits.snapshot(spark, out).versions == {}
    monkeypatch.undo()
    assert run_report_job(spark, pings, out, p, buckets=4, versioned=True).reports == 17
    there = commits.snapshot(spark, out)
    assert there.summaries(summary_columns(p)).count() == 17 and there.histograms().select("end_date").distinct().count() == 17
    assert run_report_job(spark, pings, out, p, buckets=4, versioned=True).reports == 0
    assert dt.date(2024, 1, 30) in there.versions
