"""Benchmark: all weekday reports of the fixture at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line. ``value`` is the end-to-end report job (read pings, write
the bucketed profile-day table, compute every report, publish summaries and
histograms). ``queries`` has per-step times on the durable profile-day table
(each step run once to warm up, then timed), the lazy single-plan weekly
summary straight from the raw table, and, as the yardstick, the same metrics
computed report by report (one job per metric per report, the shape of the
original job) unless BENCH_LOOP=0.

Before timing, the whole job runs once on the smallest fixture (sf0.001), so JVM
start-up and code generation of the same plan shapes are not billed to the run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from crashlens.operators import calendar, cohort, history, weekly  # noqa: E402
from crashlens.params import fixture_params  # noqa: E402
from crashlens.plans.job import run_report_job  # noqa: E402
from crashlens.plans.report import build_reports  # noqa: E402
from crashlens.session import cores_from_env, local_session  # noqa: E402
from crashlens.sources.fixtures import fixture_pings  # noqa: E402


def _timed(fn, warm: bool = True) -> float:
    if warm:
        fn()
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def _noop(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = cores_from_env(8)
    spark = local_session(cores=cores, shuffle_partitions=cores)
    params = fixture_params()
    scratch = tempfile.mkdtemp(prefix="crashlens-bench-")
    pings = fixture_pings(spark, sf_dir)
    q: dict[str, float] = {}

    # warm the JVM and the code-generation cache with the same plans on the smallest fixture
    t = time.perf_counter()
    warm_dir = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.001")
    run_report_job(spark, fixture_pings(spark, warm_dir), f"{scratch}/warmup", params)
    q["warmup_job_smallest_sf"] = round(time.perf_counter() - t, 3)

    t = time.perf_counter()
    job = run_report_job(spark, pings, f"{scratch}/out", params)
    total = round(time.perf_counter() - t, 3)
    q["report_job_end_to_end"] = total

    t = time.perf_counter()
    r = build_reports(spark, pings, params, durable=True)
    q["profile_day_table"] = round(time.perf_counter() - t, 3)
    pd = r.profile_day
    win = r.win
    q["weekly_metrics"] = _timed(_noop(r.weekly))
    q["crash_stats"] = _timed(_noop(history.crash_stats(pd, win, bounded=True, prepartitioned=True)))
    q["history_metrics"] = _timed(_noop(r.history))
    q["hours_histogram"] = _timed(_noop(r.histogram))
    q["cohort_metrics"] = _timed(_noop(r.cohort))
    q["weekly_summary"] = _timed(_noop(r.summary))
    q["crashed_history_join"] = _timed(_noop(r.crashed_history()))
    lazy = build_reports(spark, pings, params)
    q["weekly_summary_single_plan_from_raw"] = _timed(_noop(lazy.summary))

    if os.environ.get("BENCH_LOOP", "1") != "0":
        # yardstick: the original's shape, one job per metric per report
        ends = [row["end_date"] for row in r.calendar().collect()]
        t = time.perf_counter()
        for e in ends:
            one = calendar.ReportWindow(first=e, last=e, weekdays=win.weekdays, days=win.days)
            weekly.weekly_metrics(pd, one, params, prepartitioned=True).collect()
            stats = history.crash_stats(pd, one, bounded=True, prepartitioned=True)
            history.history_metrics(stats).collect()
            history.hours_histogram(stats).collect()
            cohort.cohort_metrics(cohort.cohort_members(cohort.cohort_outcomes(pd, params, prepartitioned=True), one, params)).collect()
        q["per_report_loop_same_metrics"] = round(time.perf_counter() - t, 3)

    n_reports = job.reports
    print(json.dumps({
        "metric": "all_weekday_reports_end_to_end",
        "value": total,
        "unit": "sec",
        "queries": q,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "reports": n_reports,
        "cores": cores,
    }))


if __name__ == "__main__":
    main()
