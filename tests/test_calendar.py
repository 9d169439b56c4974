
from pyspark.sql import functions as F

from crashlens.operators.calendar import (end_dates_covering, next_report_day, previous_report_day,
                                          report_calendar, report_window)
from crashlens.params import ReportParams, fixture_params
from tests.conftest import d, pd_rows


def test_window_from_params():
    w = report_window(fixture_params())
    assert (w.first, w.last, w.scan_from) == (d("2024-01-08"), d("2024-01-30"), d("2024-01-02"))
    w2 = report_window(fixture_params(), last_published=d("2024-01-20"))
    assert w2.first == d("2024-01-21")
    assert report_window(ReportParams(today=d("2016-09-10"))).first == d("2016-09-02")


def test_end_dates_covering(spark):
    w = report_window(fixture_params())
    df = spark.createDataFrame([(d("2024-01-10"),), (d("2024-01-01"),), (d("2024-01-30"),)], "day date")
    got = {r.day: r.e for r in df.select("day", end_dates_covering(F.col("day"), w).alias("e")).collect()}
    # a Wednesday feeds Wed, Thu, Fri, Mon, Tue reports
    assert got[d("2024-01-10")] == [d("2024-01-10"), d("2024-01-11"), d("2024-01-12"), d("2024-01-15"), d("2024-01-16")]
    assert got[d("2024-01-01")] == []  # before the first report's window
    assert got[d("2024-01-30")] == [d("2024-01-30")]  # reports stop at yesterday


def test_neighbours(spark):
    days = ["2024-01-08", "2024-01-09", "2024-01-12", "2024-01-13", "2024-01-14"]
    df = spark.createDataFrame([(d(x),) for x in days], "d date")
    got = df.select("d", previous_report_day(F.col("d")).alias("p"), next_report_day(F.col("d")).alias("n")).collect()
    m = {r.d.isoformat(): (r.p.isoformat(), r.n.isoformat()) for r in got}
    assert m["2024-01-08"] == ("2024-01-05", "2024-01-09")  # Monday
    assert m["2024-01-09"] == ("2024-01-08", "2024-01-10")
    assert m["2024-01-12"] == ("2024-01-11", "2024-01-15")  # Friday
    assert m["2024-01-13"] == ("2024-01-12", "2024-01-15")  # Saturday
    assert m["2024-01-14"] == ("2024-01-12", "2024-01-22")  # Sunday: the site's week starts on Sunday


def test_calendar_only_reports_with_data(spark):
    pd = pd_rows(spark, [(1, "2024-01-20", True, 19700, 10, 0, 0, 0)])
    cal = report_calendar(pd, report_window(fixture_params())).collect()
    assert [r.date for r in cal] == ["2024-01-22", "2024-01-23", "2024-01-24", "2024-01-25", "2024-01-26"]
    assert cal[0].start_sd == "20240116" and cal[0].weekday == 0
