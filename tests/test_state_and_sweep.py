"""The crash state carried from day to day, and the weekly counts by sweep."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from crashlens.operators import crash_state as C
from crashlens.operators import sweep
from crashlens.operators.calendar import report_window
from crashlens.operators.history import crash_stats
from crashlens.operators.weekly import weekly_metrics
from crashlens.params import fixture_params
from crashlens.plans.report import build_reports
from crashlens.plans.storage import write_intermediate
from crashlens.sources.fixtures import fixture_pings
from tests.conftest import PD_SCHEMA, SF001, epoch, pd_rows


def _random_days(spark, seed, profiles=60):
    rng = random.Random(seed)
    rows = []
    for cid in range(profiles):
        for k in rng.sample(range(31), rng.randint(0, 25)):
            for e10s in rng.sample([True, False], rng.randint(1, 2)):
                rows.append((cid, f"2024-01-{k + 1:02d}", e10s, epoch("2024-01-01") + rng.randint(-20, 25), rng.choice([0, 0, 600, 5000]),
                             rng.choice([0, 0, 0, 1, 2]), rng.choice([0, 0, -1, 1]), rng.choice([0, 1])))
    return pd_rows(spark, rows).cache()


def _stats(df):
    return sorted((r.end_date, r.cid, r.has_multiple_crashes, r.seconds) for r in df.collect())


def _kept(df):
    return write_intermediate(df, df.sparkSession, "crash_state")[0]


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_day_by_day_equals_whole_histories(spark, bounded, seed):
    pd, win = _random_days(spark, seed), report_window(fixture_params())
    want = _stats(crash_stats(pd, win, bounded=bounded))
    assert want and _stats(C.stats_day_by_day(pd, win, _kept, bounded=bounded)) == want


def test_merging_is_associative_and_late_rows_are_refolded(spark):
    pd = _random_days(spark, 3)
    cuts = ["20240101", "20240106", "20240107", "20240119", "20240201"]
    parts = [C.segments(pd.where(F.col("sd").between(a, b) & (F.col("sd") < b))) for a, b in zip(cuts, cuts[1:])]
    whole = sorted(map(tuple, C.segments(pd).collect()))
    left = reduce(C.merge_segments, parts)
    right = reduce(lambda later, earlier: C.merge_segments(earlier, later), reversed(parts))
    assert sorted(map(tuple, left.select("cid", *C.SEGMENT).collect())) == whole == sorted(map(tuple, right.select("cid", *C.SEGMENT).collect()))
    late = F.xxhash64("cid", "sd", "e10s") % 9 == 0
    state = C.segments(pd.where(~late))
    again = C.refold(state, pd, pd.where(late))
    assert sorted(map(tuple, again.select("cid", *C.SEGMENT).collect())) == whole


def test_a_step_reads_new_days_only(spark):
    r = build_reports(spark, fixture_pings(spark, SF001), fixture_params(), durable=True, buckets=4)
    try:
        state = C.segments(r.profile_day.where("month < '202401'"), prepartitioned=True)
        new = C.segments(r.profile_day.where("month = '202401'"), prepartitioned=True)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "(month#" in plan
        assert state.columns == new.columns
    finally:
        r.release()


def test_state_of_nothing(spark):
    empty, win = spark.createDataFrame([], PD_SCHEMA), report_window(fixture_params())
    assert C.stats_day_by_day(empty, win, _kept).collect() == [] and C.segments(empty).collect() == []


@pytest.mark.parametrize("seed", [4, 5, None])
def test_sweep_equals_weekly_metrics(spark, seed):
    p = fixture_params(crash_thresholds=(1, 2, 4))
    win = report_window(p)
    pd = build_reports(spark, fixture_pings(spark, SF001), p).profile_day if seed is None else _random_days(spark, seed, 25)
    got = sweep.weekly_counts(pd, win, p)
    want = weekly_metrics(pd, win, p).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_sweep_of_few_days(spark):
    """Totals are carried over days without events; windows without rows have no report."""
    p = fixture_params()
    win = report_window(p)
    pd = pd_rows(spark, [(1, "2024-01-08", True, epoch("2024-01-05"), 10, 1, 0, 0), (2, "2024-01-08", False, epoch("2010-01-05"), 0, 1, 0, 0)])
    got = {str(r.end_date): (r.wau, r.crashed_1, r.new_profiles, r.e10s_off_crashed) for r in sweep.weekly_counts(pd, win, p).collect()}
    assert got == {**{f"2024-01-{k:02d}": (1, 1, 1, 1) for k in (8, 9, 10, 11)}, "2024-01-12": (1, 1, 0, 1)}
    assert sweep.weekly_counts(pd.limit(0), win, p).collect() == []


def test_sweep_makes_two_events_a_row(spark):
    pd = _random_days(spark, 6)
    old = pd.where("pcd < unix_date(DATE '2023-12-01')")
    assert sweep.profile_events(old, 7).count() == 2 * old.count()
    assert sweep.profile_events(pd, 7).count() <= 4 * pd.count()
