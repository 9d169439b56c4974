"""Hand-made cases and a brute-force newest-first walk."""

import datetime as dt
import random

import pytest

from crashlens.operators.calendar import ReportWindow
from crashlens.operators.history import crash_stats, history_metrics, hours_histogram, longitudinal
from crashlens.operators.calendar import report_window
from crashlens.params import fixture_params
from tests.conftest import d, pd_rows

WIN = ReportWindow(first=d("2024-01-08"), last=d("2024-01-30"), weekdays=(0, 1, 2, 3, 4), days=7)
ALL_DAYS = ReportWindow(first=d("2024-01-01"), last=d("2024-02-29"), weekdays=tuple(range(7)), days=7)


def _stats(spark, rows, end, bounded=True, win=ALL_DAYS):
    st = crash_stats(pd_rows(spark, rows), win, bounded=bounded).filter(f"end_date = date'{end}'")
    return {r.cid: (r.has_multiple_crashes, None if r.hours is None else round(r.hours, 9)) for r in st.collect()}


def test_hand_made_cases(spark):
    P = 19700
    rows = [
        # one crash ever
        (1, "2024-01-05", True, P, 600, 1, 0, 0),
        # two crashes on one row
        (2, "2024-01-05", True, P, 600, 2, 0, 0),
        # gap: newest crash row counts, the older one does not
        (3, "2024-01-05", True, P, 3600, 1, 0, 0),
        (3, "2024-01-04", True, P, 7200, 0, 0, 0),
        (3, "2024-01-02", True, P, 600, 0, 1, 0),
        # negative content crashes: only 01-04 is a crash row
        (5, "2024-01-05", True, P, 600, 0, -1, 0),
        (5, "2024-01-04", True, P, 600, 1, 0, 0),
        # plugin crashes never count
        (6, "2024-01-05", True, P, 600, 0, 0, 5),
    ]
    got = _stats(spark, rows, "2024-01-05")
    assert got[1] == (False, None)
    assert got[2] == (True, 0.0)
    assert got[3] == (True, round((3600 + 7200) / 3600, 9))
    assert got[5] == (False, None)
    assert 6 not in got


def test_same_day_both_e10s_states(spark):
    # One crash in each e10s state on one day is not "same day = 0 hours":
    # the row that sorts newest (higher ssl on ties) starts the gap, which is its own ssl
    rows = [(4, "2024-01-05", True, 19700, 3600, 1, 0, 0), (4, "2024-01-05", False, 19700, 1800, 1, 0, 0)]
    assert _stats(spark, rows, "2024-01-05") == {4: (True, 1.0)}


def test_later_crash_bounded_vs_full_history(spark):
    rows = [(7, "2024-01-05", True, 19700, 600, 1, 0, 0), (7, "2024-01-20", True, 19700, 900, 1, 0, 0)]
    assert _stats(spark, rows, "2024-01-07", bounded=True) == {7: (False, None)}
    assert _stats(spark, rows, "2024-01-07", bounded=False) == {7: (True, 900 / 3600)}


def _walk(rows):
    """The plain newest-first walk over (sd, cdc, cssm, cdpgmp, ssl) tuples."""
    rows = sorted(rows, reverse=True)
    first = None
    for i, (sd, cdc, cssm, cdpgmp, ssl) in enumerate(rows):
        c = cssm + cdc
        if c <= 0:
            continue
        if first is None:
            first = i
            if c > 1:
                return True, 0.0
        else:
            return True, sum(r[4] for r in rows[first:i]) / 60 / 60
    return False, None


def _random_rows(seed, n_profiles=40, n_rows=600):
    rng = random.Random(seed)
    base = dt.date(2024, 1, 1)
    rows = {}
    for _ in range(n_rows):
        cid = rng.randrange(n_profiles)
        day = base + dt.timedelta(days=rng.randrange(30))
        e10s = rng.random() < 0.5
        key = (cid, day, e10s)
        rows[key] = (
            cid, day.isoformat(), e10s, 19700 + rng.randrange(-10, 10), rng.choice([0, 0, 60, 3600, rng.randrange(86400)]),
            rng.choice([0, 0, 0, 1, 2]), rng.choice([-1, 0, 0, 0, 1]), rng.choice([0, 1]),
        )
    return list(rows.values())


@pytest.mark.parametrize("seed", [7, 11, 23])
@pytest.mark.parametrize("bounded", [True, False])
def test_random_against_walk(spark, bounded, seed):
    rows = _random_rows(seed)
    got = {(r.end_date, r.cid): (r.has_multiple_crashes, r.hours)
           for r in crash_stats(pd_rows(spark, rows), WIN, bounded=bounded).collect()}
    expected = {}
    for e_off in range((WIN.last - WIN.first).days + 1):
        end = WIN.first + dt.timedelta(days=e_off)
        if end.weekday() > 4:
            continue
        start = end - dt.timedelta(days=6)
        by_cid = {}
        for cid, day, e10s, pcd, ssl, cssm, cdc, cdpgmp in rows:
            by_cid.setdefault(cid, []).append((day, cdc, cssm, cdpgmp, ssl))
        for cid, hist in by_cid.items():
            if not any(start.isoformat() <= h[0] <= end.isoformat() and h[1] + h[2] > 0 for h in hist):
                continue
            seen = [h for h in hist if h[0] <= end.isoformat()] if bounded else hist
            expected[(end, cid)] = _walk([(h[0].replace("-", ""),) + h[1:] for h in seen])
    assert set(got) == set(expected)
    for k, (multi, hours) in expected.items():
        g_multi, g_hours = got[k]
        assert g_multi == multi, k
        assert (g_hours is None and hours is None) or abs(g_hours - hours) < 1e-9, (k, g_hours, hours)


def test_metrics_and_histogram(spark):
    rows = [
        (1, "2024-01-05", True, 19700, 3600, 1, 0, 0), (1, "2024-01-04", True, 19700, 5400, 1, 0, 0),
        (2, "2024-01-05", True, 19700, 600, 2, 0, 0),
        (3, "2024-01-05", True, 19700, 600, 1, 0, 0),
    ]
    st = crash_stats(pd_rows(spark, rows), ALL_DAYS).filter("end_date = date'2024-01-05'")
    m = history_metrics(st).first()
    assert (m.first_time_crashers, m.repeat_crashers) == (1, 2)
    assert m.median_hours_between_crashes == pytest.approx(0.5)      # hours 0 and 1
    assert m.geom_hours_between_crashes == pytest.approx(2 ** 0.5 - 1)
    h = {r.hours: r["count"] for r in hours_histogram(st).collect()}
    assert h == {0: 1, 1: 1}


def test_longitudinal_sorted(spark):
    rows = [(1, "2024-01-05", True, 19701, 10, 0, 0, 0), (1, "2024-01-02", False, 19700, 20, 1, 0, 0)]
    r = longitudinal(pd_rows(spark, rows), report_window(fixture_params())).first()
    assert r.pcd == 19700 and [h.sd for h in r.history] == ["20240102", "20240105"]


def test_candidate_profiles(spark):
    from pyspark.sql import functions as F

    from crashlens.operators.profiles import profiles_with_rows

    rows = _random_rows(5)
    pd = pd_rows(spark, rows).repartition("cid")
    cond = F.col("cssm") > 1
    wanted = {r[0] for r in rows if r[5] > 1}
    expected = sorted(r for r in rows if r[0] in wanted)
    got = sorted((r.cid, r.day.isoformat(), r.e10s, r.pcd, r.ssl, r.cssm, r.cdc, r.cdpgmp) for r in profiles_with_rows(pd, cond).collect())
    assert got == expected


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ROW = st.tuples(
    st.integers(0, 3),                       # cid
    st.integers(0, 20),                      # day offset in January
    st.booleans(),                           # e10s
    st.sampled_from([0, 60, 3600, 5000]),    # ssl
    st.sampled_from([0, 0, 1, 2]),           # cssm
    st.sampled_from([-1, 0, 0, 1]),          # cdc
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw=st.lists(_ROW, min_size=1, max_size=40), bounded=st.booleans())
def test_property_against_walk(spark, raw, bounded):
    rows = {}
    for cid, off, e10s, ssl, cssm, cdc in raw:   # one row per (cid, day, e10s), as the rollup gives
        day = (dt.date(2024, 1, 1) + dt.timedelta(days=off)).isoformat()
        rows[(cid, day, e10s)] = (cid, day, e10s, 19700, ssl, cssm, cdc, 0)
    rows = list(rows.values())
    win = ReportWindow(first=d("2024-01-08"), last=d("2024-01-19"), weekdays=(0, 1, 2, 3, 4), days=7)
    got = {(r.end_date, r.cid): (r.has_multiple_crashes, r.hours)
           for r in crash_stats(pd_rows(spark, rows), win, bounded=bounded).collect()}
    expected = {}
    for off in range(12):
        end = win.first + dt.timedelta(days=off)
        if end.weekday() > 4:
            continue
        start = end - dt.timedelta(days=6)
        for cid in {r[0] for r in rows}:
            hist = [(r[1].replace("-", ""), r[6], r[5], r[7], r[4]) for r in rows if r[0] == cid]
            if not any(start.strftime("%Y%m%d") <= h[0] <= end.strftime("%Y%m%d") and h[1] + h[2] > 0 for h in hist):
                continue
            seen = [h for h in hist if h[0] <= end.strftime("%Y%m%d")] if bounded else hist
            expected[(end, cid)] = _walk(seen)
    assert set(got) == set(expected)
    for k, (multi, hours) in expected.items():
        assert got[k][0] == multi and (got[k][1] == hours or abs(got[k][1] - hours) < 1e-9)
