"""U2 / U3 / A11-A13 on hand-made profiles and a brute-force check."""

import datetime as dt
import random

import pytest

from crashlens.operators.calendar import ReportWindow
from crashlens.operators.cohort import cohort_members, cohort_metrics, cohort_outcomes
from crashlens.params import fixture_params
from tests.conftest import d, epoch, pd_rows

ALL_DAYS = ReportWindow(first=d("2024-01-01"), last=d("2024-03-31"), weekdays=tuple(range(7)), days=7)


def _outcomes(spark, rows):
    o = cohort_outcomes(pd_rows(spark, rows), fixture_params())
    return {r.cid: r for r in o.collect()}


def test_first_crash_day_boundaries(spark):
    p = epoch("2024-01-01")
    rows = []
    for cid, offset in ((6, 6), (7, 7), (13, 13), (14, 14)):
        day = (d("2024-01-01") + dt.timedelta(days=offset)).isoformat()
        rows += [(cid, "2024-01-01", True, p, 100, 0, 0, 0), (cid, day, True, p, 100, 1, 0, 0)]
    o = _outcomes(spark, rows)
    assert (o[6].has_crashed, o[6].crashed_second_week, o[6].days_to_first_crash) == (True, False, 6)
    assert (o[7].has_crashed, o[7].crashed_second_week, o[7].days_to_first_crash) == (True, True, 7)
    assert (o[13].has_crashed, o[13].crashed_second_week) == (True, True)
    assert (o[14].has_crashed, o[14].crash_group) == (False, 0)
    assert o[13].crash_group == 1


def test_crash_before_creation_and_negative_content(spark):
    p = epoch("2024-01-10")
    rows = [
        (1, "2024-01-08", True, p, 100, 1, 0, 0),                                          # 2 days before pcd
        (2, "2024-01-11", True, p, 100, 0, -1, 0), (2, "2024-01-12", True, p, 100, 1, 0, 0),  # -1 and +1
    ]
    o = _outcomes(spark, rows)
    assert (o[1].has_crashed, o[1].days_to_first_crash) == (True, -2)
    assert (o[2].crash_group, o[2].has_crashed) == (0, True)
    members = cohort_members(cohort_outcomes(pd_rows(spark, rows), fixture_params()), ALL_DAYS, fixture_params())
    m = cohort_metrics(members.filter("end_date = date'2024-01-24'")).first()
    # profile 1's days (-2) are left out of the days statistics
    assert (m.cohort_profiles, m.cohort_crashed, m.days_count, m.days_min) == (2, 1, 1, 2)


@pytest.mark.parametrize("seed", [3, 17])
def test_random_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = dt.date(2024, 1, 1)
    rows = {}
    for _ in range(500):
        cid = rng.randrange(40)
        day = base + dt.timedelta(days=rng.randrange(45))
        e10s = rng.random() < 0.5
        pcd = epoch("2024-01-01") + (cid % 20) + rng.choice([0, 0, 0, 1])
        rows[(cid, day, e10s)] = (cid, day.isoformat(), e10s, pcd, 100, rng.choice([0, 0, 1]), rng.choice([-1, 0, 0, 1]), 0)
    rows = list(rows.values())
    p = fixture_params()
    got = {(r.end_date, r.cid): (r.crash_group, r.has_crashed, r.crashed_second_week, r.days_to_first_crash)
           for r in cohort_members(cohort_outcomes(pd_rows(spark, rows), p), ALL_DAYS, p).collect()}
    by_cid = {}
    for r in rows:
        by_cid.setdefault(r[0], []).append(r)
    expected = {}
    for off in range((ALL_DAYS.last - ALL_DAYS.first).days + 1):
        end = ALL_DAYS.first + dt.timedelta(days=off)
        end_int = epoch(end.isoformat())
        for cid, hist in by_cid.items():
            if not any(end_int - 20 <= h[3] <= end_int - 14 for h in hist):
                continue
            pcd0 = min(h[3] for h in hist)
            limit = dt.date(1970, 1, 1) + dt.timedelta(days=pcd0 + 13)
            early = [h for h in hist if d(h[1]) <= limit]
            tot = sum(h[5] + h[6] for h in early)
            crash_days = sorted(d(h[1]) for h in early if h[5] + h[6] > 0)
            first = crash_days[0] if crash_days else None
            birth = dt.date(1970, 1, 1) + dt.timedelta(days=pcd0)
            expected[(end, cid)] = (
                1 if tot >= 1 else 0, first is not None,
                first is not None and first >= birth + dt.timedelta(days=7),
                None if first is None else (first - birth).days,
            )
    assert got == expected
