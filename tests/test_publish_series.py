import datetime as dt
import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from crashlens.operators.series import release_markers, summary_series
from crashlens.operators.summary import summary_columns
from crashlens.params import fixture_params
from crashlens.plans.job import run_report_job
from crashlens.sources.fixtures import fixture_pings
from crashlens.sources.dated_files import last_dated, read_dated, write_dated
from crashlens.sources.published import (export_merged, last_published_date, lookup_weeks, publish_histograms, published_partitions,
                                         read_histograms, read_summaries, week_histogram)
from tests.conftest import SF001, SF01, d


def test_job_publish_incremental(spark):
    out = tempfile.mkdtemp(prefix="crashlens-test-out-")
    p = fixture_params(today=d("2024-01-20"))
    assert last_published_date(spark, out) is None
    first = run_report_job(spark, fixture_pings(spark, SF01), out, p, buckets=4)
    assert (first.first_report, first.last_report) == (d("2024-01-08"), d("2024-01-19"))
    assert last_published_date(spark, out) == d("2024-01-19")
    # next run continues after the last published report
    second = run_report_job(spark, fixture_pings(spark, SF01), out, fixture_params(), buckets=4)
    assert second.first_report == d("2024-01-22")  # the 20th is a Saturday
    keys = summary_columns(fixture_params())
    merged = read_summaries(spark, out, keys)
    dates = [r.date for r in merged.collect()]
    assert len(dates) == 17 and dates == sorted(dates)
    # each run's reports equal a full run with the same parameters (``today`` also bounds
    # the creation-date filter, so runs on different days see different profiles)
    a = {r.date: r for r in merged.collect()}
    for params, lo, hi in ((p, "2024-01-08", "2024-01-19"), (fixture_params(), "2024-01-20", "2024-01-30")):
        full_out = tempfile.mkdtemp(prefix="crashlens-test-full-")
        run_report_job(spark, fixture_pings(spark, SF01), full_out, params.with_(default_last_report=d("2024-01-07")),
                       buckets=4)
        b = {r.date: r for r in read_summaries(spark, full_out, keys).collect() if lo <= r.date <= hi}
        assert b and b == {k: v for k, v in a.items() if lo <= k <= hi}
    h = week_histogram(spark, out, d("2024-01-29")).collect()
    assert sum(r["count"] for r in h) == 49
    assert week_histogram(spark, out, d("2024-01-13")).count() == 0   # weekend: "missing data"
    exp = os.path.join(out, "merged")
    export_merged(merged, exp)
    parts = [f for f in os.listdir(exp) if f.endswith(".json")]
    assert len(parts) == 1
    lines = open(os.path.join(exp, parts[0])).read().splitlines()
    assert len(lines) == 17 and set(json.loads(lines[0])) == set(keys)


def test_dated_files(spark):
    """Files of the original naming: written by others, and by this library."""
    folder = tempfile.mkdtemp(prefix="crashlens-dated-")
    schema = StructType([StructField("date", StringType()), StructField("proportion_wau_crashes_1", DoubleType())])
    for start, end, v in (("20170101", "20170107", 0.1), ("20170102", "20170108", 0.2)):
        with open(os.path.join(folder, f"weekly-{start}-{end}.json"), "w") as f:
            f.write(json.dumps([{"date": f"{end[:4]}-{end[4:6]}-{end[6:]}", "proportion_wau_crashes_1": v, "more": 1}]) + "\n")
    for other in ("weekly-latest.json", "hours-20170103-20170109.json"):
        with open(os.path.join(folder, other), "w") as f:
            f.write("not a report")
    rows = lambda **kw: sorted((r.end_date, r.proportion_wau_crashes_1) for r in read_dated(spark, folder, "weekly", schema, **kw).collect())
    both = [(d("2017-01-07"), 0.1), (d("2017-01-08"), 0.2)]
    assert rows() == both and rows(latest=True) == both[1:] and rows(last=d("2017-01-07")) == both[:1] and rows(first=d("2017-02-01")) == []
    assert last_dated(spark, folder, "weekly") == d("2017-01-08") and last_dated(spark, folder + "/none", "weekly") is None
    more = spark.createDataFrame([("2017-01-09", None, d("2017-01-09")), ("2017-01-08", 0.3, d("2017-01-08"))],
                                 "date string, proportion_wau_crashes_1 double, end_date date")
    assert write_dated(more, folder, "weekly") == 2  # the week that is there is replaced
    assert rows() == [both[0], (d("2017-01-08"), 0.3), (d("2017-01-09"), None)]
    assert open(os.path.join(folder, "weekly-20170103-20170109.json")).read() == '[{"date":"2017-01-09","proportion_wau_crashes_1":null}]\n'
    assert sorted(os.listdir(folder))[0] != ".staging" and not [x for x in os.listdir(folder) if x.startswith(".staging")]
    plan = read_dated(spark, folder, "weekly", schema, latest=True)._jdf.queryExecution().executedPlan().toString()
    assert "(1 paths)" in plan


def test_lookup_and_pending_read_the_listing(spark):
    out = tempfile.mkdtemp(prefix="crashlens-lookup-")
    assert [(r.status, r.hours) for r in lookup_weeks(spark, out, [d("2024-01-08")]).collect()] == [("missing", None)]
    assert published_partitions(spark, out).collect() == []
    hist = spark.createDataFrame([(1, 5, d("2024-01-08")), (2, 6, d("2024-01-08")), (1, 7, d("2024-01-09"))], "hours int, count long, end_date date")
    publish_histograms(hist, out)
    got = lookup_weeks(spark, out, [d("2024-01-08"), d("2024-01-13")])
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[2] or 0)) == [(d("2024-01-08"), "published", 1, 5), (d("2024-01-08"), "published", 2, 6), (d("2024-01-13"), "missing", None, None)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-09" not in plan
    read = read_histograms(spark, out).where(F.col("end_date").isin([d("2024-01-08"), d("2024-01-13")]))
    assert len(read.select("_metadata.file_path").distinct().collect()) >= 1 and "end_date=2024-01-09" not in str(read.select("_metadata.file_path").distinct().collect())


def test_series_and_markers(spark):
    from crashlens.plans.report import build_reports

    r = build_reports(spark, fixture_pings(spark, SF001), fixture_params())
    s = summary_series(r.summary, e10s_kind="plugin")
    charts = {row.chart for row in s.select("chart").distinct().collect()}
    assert len(charts) == 9
    assert s.filter(F.col("series") == "crash_rate_plugin_e10s_enabled").count() == r.summary.count()
    rel = spark.createDataFrame(
        [(d("2023-12-19"), "major", "121.0"), (d("2023-01-01"), "major", "108.0"), (d("2024-01-09"), "stability", "121.0.1"),
         (d("2024-01-10"), "dev", "123.0b1")], "date date, category string, version string")
    m = release_markers(rel, dt.date(2024, 1, 31), "major").collect()
    assert sorted(x.label for x in m) == ["121.0", "Shutdown kills removed (click me)"]


def test_job_with_no_data_in_window(spark):
    """Reports after the data ends: the job completes and publishes nothing (no division
    errors, no empty-group failures), so the next run retries the same window."""
    out = tempfile.mkdtemp(prefix="crashlens-test-empty-")
    p = fixture_params(today=d("2024-03-01"), default_last_report=d("2024-02-10"))
    res = run_report_job(spark, fixture_pings(spark, SF001), out, p, buckets=4)
    assert (res.first_report, res.last_report) == (d("2024-02-11"), d("2024-02-29"))
    assert last_published_date(spark, out) is None
    assert read_summaries(spark, out, summary_columns(p)) is None


def _run(spark, out, **kw):
    from crashlens.sources.fixtures import fixture_pings

    return run_report_job(spark, fixture_pings(spark, SF01), out, fixture_params(**kw), buckets=4)


def _dates(spark, out, what):
    return sorted(p.split("=")[1] for p in os.listdir(f"{out}/{what}") if p.startswith("end_date="))


def test_a_failure_between_the_writes_is_made_good(spark, monkeypatch):
    import crashlens.plans.job as job

    out = tempfile.mkdtemp(prefix="crashlens-fail-")

    def broken(*a):
        raise OSError("no space left")

    monkeypatch.setattr(job, "publish_summaries", broken)
    with pytest.raises(OSError):
        _run(spark, out)
    monkeypatch.undo()
    assert _run(spark, out).reports == 17
    assert len(_dates(spark, out, "summary")) == len(_dates(spark, out, "hours")) == 17
    assert _run(spark, out).reports == 0


def test_a_gap_is_filled(spark):
    out = tempfile.mkdtemp(prefix="crashlens-gap-")
    assert _run(spark, out).reports == 17
    whole = {r.date: r for r in read_summaries(spark, out, summary_columns(fixture_params())).collect()}
    for day in ("2024-01-10", "2024-01-22"):
        os.rename(f"{out}/summary/end_date={day}", f"{out}-{day}")
    assert _run(spark, out).reports == 2
    again = {r.date: r for r in read_summaries(spark, out, summary_columns(fixture_params())).collect()}
    assert again == whole


def test_no_table_is_left_behind(spark):
    from crashlens.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    left = lambda: {p for p in os.listdir(f"{base}/crashlens") if p.startswith("profile_day")} if os.path.isdir(f"{base}/crashlens") else set()
    before = left()
    _run(spark, tempfile.mkdtemp(prefix="crashlens-left-"))
    assert left() == before


def test_scan_has_a_given_schema(spark):
    from crashlens.sources.pings import read_raw_pings

    where = tempfile.mkdtemp(prefix="crashlens-scan-") + "/t"
    spark.sql("""SELECT 'c' AS client_id, 'release' AS normalized_channel, 'Firefox' AS app_name, 5L AS subsession_length, 0L AS crash_submit_success_main,
                 0L AS crashes_detected_content, 0L AS crashes_detected_gmplugin, 0L AS crashes_detected_plugin, 18000 AS profile_creation_date,
                 true AS e10s_enabled, '20240101' AS submission_date_s3, '42' AS sample_id""").write.partitionBy("submission_date_s3", "sample_id").parquet(where)
    df = read_raw_pings(spark, where)
    row = df.first()
    assert (row.sd, row.sid, row.sk) == ("20240101", "42", None)
    plan = df.filter("sd >= '20240101' AND sid = '42' AND channel = 'release'").select("cid")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "PushedFilters: [IsNotNull(normalized_channel)" in plan
    assert "ReadSchema: struct<client_id:string,normalized_channel:string>" in plan
