"""Edge cases, invariants, and all-reports-at-once == report-by-report."""

import pytest
from pyspark.sql import functions as F

from crashlens.operators.calendar import ReportWindow, report_window
from crashlens.operators.weekly import weekly_metrics
from crashlens.params import fixture_params
from crashlens.plans.report import build_reports
from crashlens.sources.fixtures import fixture_pings
from tests.conftest import SF01, d, epoch, pd_rows

ONE = ReportWindow(first=d("2024-01-05"), last=d("2024-01-05"), weekdays=tuple(range(7)), days=7)


def test_zero_hours_and_missing_e10s_group(spark):
    p = fixture_params()
    rows = [
        (1, "2024-01-05", True, 19700, 0, 1, 0, 0),      # crashed, no use: rate NULL, not in WAU
        (2, "2024-01-04", True, 19700, 3600, 1, 0, 2),   # 1 main, 2 plugin crashes per hour
    ]
    m = weekly_metrics(pd_rows(spark, rows), ONE, p).first()
    assert (m.wau, m.crashed_1, m.crashed_2) == (1, 1, 0)
    assert m.main_per_hour == pytest.approx(1.0) and m.plugin_per_hour == pytest.approx(2.0)
    assert (m.e10s_on_crashed, m.e10s_off_crashed) == (2, 0)   # A6 has no ssl > 0 rule (D7)
    assert m.main_per_hour_off is None                        # D9: absent group -> NULL


def test_new_profiles_use_row_pcd(spark):
    p = fixture_params()
    inside, before = epoch("2024-01-02"), epoch("2023-12-01")
    rows = [
        (1, "2024-01-05", True, inside, 60, 1, 1, 0),
        (2, "2024-01-05", True, before, 60, 1, 0, 0),
        (3, "2024-01-05", True, inside, 0, 1, 0, 0),     # new but not active
    ]
    m = weekly_metrics(pd_rows(spark, rows), ONE, p).first()
    assert (m.new_profiles, m.new_crashed_1, m.new_crashed_2) == (1, 1, 1)


def test_invariants_and_week_by_week(spark):
    p = fixture_params()
    r = build_reports(spark, fixture_pings(spark, SF01), p)
    m = r.metrics.collect()
    assert len(m) == 17
    for x in m:
        assert x.crashed_2 <= x.crashed_1 <= x.wau
        assert x.new_crashed_2 <= x.new_crashed_1 <= x.new_profiles <= x.wau
        assert x.first_time_crashers + x.repeat_crashers >= x.crashed_1 - 0  # J1 has no ssl>0 rule (D7)
    hist = r.histogram.groupBy("end_date").agg(F.sum("count").alias("n"))
    rep = {x.end_date: x.repeat_crashers for x in m}
    for h in hist.collect():
        assert h.n == rep[h.end_date]          # histogram total = repeat crashers
    # all reports in one pass == one report at a time
    pd = r.profile_day
    all_at_once = {x.end_date: x.asDict() for x in r.weekly.collect()}
    win = report_window(p)
    for e in (d("2024-01-08"), d("2024-01-19"), d("2024-01-30")):
        one = ReportWindow(first=e, last=e, weekdays=win.weekdays, days=win.days)
        got = weekly_metrics(pd, one, p).first().asDict()
        want = all_at_once[e]
        assert set(got) == set(want)
        for k, v in want.items():
            assert got[k] == (pytest.approx(v, rel=1e-12) if isinstance(v, float) else v), k


def test_fixture_week_values(spark):
    """FIXTURES.md: week ending 2024-01-15 and 2024-01-29 at sf0.01."""
    r = build_reports(spark, fixture_pings(spark, SF01), fixture_params())
    m = {x.end_date.isoformat(): x for x in r.metrics.collect()}
    a, b = m["2024-01-15"], m["2024-01-29"]
    assert (a.wau, a.crashed_1, a.crashed_2, a.new_profiles, a.cohort_profiles) == (126, 45, 15, 25, 30)
    assert (a.repeat_crashers, a.first_time_crashers) == (31, 26)
    assert a.median_hours_between_crashes == pytest.approx(21.9025)
    assert (b.wau, b.crashed_1, b.crashed_2, b.new_profiles, b.cohort_profiles) == (126, 45, 12, 8, 28)
    assert (b.repeat_crashers, b.first_time_crashers) == (49, 5)
    assert b.median_hours_between_crashes == pytest.approx(46.6147, abs=1e-4)


def test_empty_denominators_sf0001(spark):
    """FIXTURES.md: at sf0.001 the week ending 2024-01-29 has no new profile and no
    crashed profile with e10s off (D9: NULL ratio, count 0, no error)."""
    from tests.conftest import SF001

    r = build_reports(spark, fixture_pings(spark, SF001), fixture_params())
    s = {x.date: x for x in r.summary.collect()}["2024-01-29"]
    m = {x.end_date.isoformat(): x for x in r.metrics.collect()}["2024-01-29"]
    assert m.new_profiles == 0 and s.proportion_new_crashes_1 is None and s.proportion_new_crashes_2 is None
    assert m.e10s_off_crashed == 0 and s.proportion_e10s_disabled == 0.0


def test_report_weekdays_parameter(spark):
    """The report days are a parameter (e.g. Monday, Wednesday, Friday)."""
    p = fixture_params(report_weekdays=(0, 2, 4))
    r = build_reports(spark, fixture_pings(spark, SF01), p)
    days = sorted(x.end_date for x in r.weekly.collect())
    assert days and all(x.weekday() in (0, 2, 4) for x in days)
    full = {x.end_date: x.wau for x in build_reports(spark, fixture_pings(spark, SF01), fixture_params()).weekly.collect()}
    assert all(full[x.end_date] == x.wau for x in r.weekly.collect())


def test_console_report(spark):
    from crashlens.operators.summary import console_report

    r = build_reports(spark, fixture_pings(spark, SF01), fixture_params())
    lines = {(x.end_date.isoformat(), x.line): x.text for x in console_report(r.metrics, fixture_params()).collect()}
    assert lines[("2024-01-15", 0)] == "Active profiles: 12,600"
    assert lines[("2024-01-15", 1)] == "Profiles with 1+ crashes: 4,500 (35.71% of active)"
    assert lines[("2024-01-15", 6)] == "First crash on record: 2,600 (57.78% of crashed)"
    assert lines[("2024-01-08", 9)] == "Cohort crashed within two weeks: 0 (n/a)"   # no cohort yet (D9)


def test_random_against_brute_force(spark):
    import datetime as dt
    import random

    rng = random.Random(5)
    base = dt.date(2024, 1, 1)
    rows = {}
    for _ in range(400):
        cid = rng.randrange(30)
        day = base + dt.timedelta(days=rng.randrange(25))
        e10s = rng.random() < 0.5
        pcd = epoch("2024-01-01") + rng.randrange(-5, 25)
        rows[(cid, day, e10s)] = (cid, day.isoformat(), e10s, pcd, rng.choice([0, 0, 60, 3600, 7200]),
                                  rng.choice([0, 0, 1, 2]), rng.choice([-1, 0, 0, 1]), rng.choice([0, 1]))
    rows = list(rows.values())
    p = fixture_params()
    win = ReportWindow(first=d("2024-01-08"), last=d("2024-01-25"), weekdays=(0, 1, 2, 3, 4), days=7)
    got = {x.end_date: x for x in weekly_metrics(pd_rows(spark, rows), win, p).collect()}

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    def rate(c, s):
        return None if s == 0 else c / (s / 60 / 60)

    for off in range(18):
        end = win.first + dt.timedelta(days=off)
        if end.weekday() > 4:
            continue
        lo, hi = (end - dt.timedelta(days=6)).isoformat(), end.isoformat()
        wk = [r for r in rows if lo <= r[1] <= hi]
        if not wk:
            assert end not in got
            continue
        e_lo, e_hi = epoch(lo), epoch(hi)
        cids = {r[0] for r in wk}
        act = {c: [r for r in wk if r[0] == c and r[4] > 0] for c in cids}
        new = {c: [r for r in act[c] if e_lo <= r[3] <= e_hi] for c in cids}
        g = got[end]
        assert g.wau == sum(1 for c in cids if act[c])
        for n in (1, 2):
            assert g[f"crashed_{n}"] == sum(1 for c in cids if act[c] and sum(r[5] + r[6] for r in act[c]) >= n)
            assert g[f"new_crashed_{n}"] == sum(1 for c in cids if new[c] and sum(r[5] + r[6] for r in new[c]) >= n)
        assert g.new_profiles == sum(1 for c in cids if new[c])
        for flag, tag in ((True, "on"), (False, "off")):
            grp = {c: [r for r in wk if r[0] == c and r[2] == flag] for c in cids}
            assert g[f"e10s_{tag}_crashed"] == sum(1 for c in cids if grp[c] and sum(r[5] + r[6] for r in grp[c]) > 0)
            want = mean([rate(sum(r[5] for r in grp[c]), sum(r[4] for r in grp[c])) for c in cids if grp[c]])
            assert (g[f"main_per_hour_{tag}"] is None and want is None) or g[f"main_per_hour_{tag}"] == pytest.approx(want)
        for kind, i in (("main", 5), ("content", 6), ("plugin", 7)):
            want = mean([rate(sum(r[i] for r in wk if r[0] == c), sum(r[4] for r in wk if r[0] == c)) for c in cids])
            assert (g[f"{kind}_per_hour"] is None and want is None) or g[f"{kind}_per_hour"] == pytest.approx(want)
