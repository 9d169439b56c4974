"""The end-to-end report job: read, roll up, compute every pending report, publish.

1. Pending are the report dates with data, from the first report day up to yesterday
   (W1), that have no published summary: gaps are filled, wherever they are.
2. The profile-day rollup is written once as a table bucketed by cid (lineage
   cut, later steps shuffle-free on cid).
3. Crash statistics per (report, profile) are checkpointed: the summary's median
   and geometric mean and the histogram all read them.
4. Histograms are written first, summaries last, with dynamic partition overwrite: a
   published summary says that its report is complete, so a run that fails between the
   two does the report again. With ``versioned`` both become visible by one commit
   (sources/commits.py).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crashlens.params import ReportParams
from crashlens.operators.calendar import only_these, pending_reports, report_window
from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import profile_day as rollup
from crashlens.plans.history_store import open_store
from crashlens.plans.report import reports_from_profile_day
from crashlens.sources import commits
from crashlens.sources.pings import PING_SCHEMA
from crashlens.sources.published import publish_histograms, publish_summaries, published_dates, published_partitions


@dataclass
class JobResult:
    first_report: _dt.date
    last_report: _dt.date
    reports: int  # reports computed


def possible_dates(win) -> list[_dt.date]:
    days = (win.last - win.first).days + 1
    every = [win.first + _dt.timedelta(days=i) for i in range(max(days, 0))]
    return [d for d in every if d.weekday() in win.weekdays]


def run_report_job(spark: SparkSession, raw_pings: DataFrame, out_dir: str, params: ReportParams, *,
                   buckets: int | None = None, echo: bool = False, versioned: bool = False) -> JobResult:
    return publish_pending_reports(spark, rollup(clean_pings(raw_pings, params)), out_dir, params,
                                   buckets=buckets, echo=echo, versioned=versioned)


def run_stored_report_job(spark: SparkSession, ping_dir: str, store_dir: str, out_dir: str, params: ReportParams, *,
                          schema: StructType = PING_SCHEMA, buckets: int | None = None, echo: bool = False) -> JobResult:
    """The daily job over a store (plans/history_store.py): take in the ping files that arrived
    since the last run, then publish what is due. Nothing taken in before is read as pings again."""
    store = open_store(spark, store_dir, cid_type=schema["client_id"].dataType.simpleString(), buckets=buckets)
    try:
        store.take_in(ping_dir, params, schema)
        return publish_pending_reports(spark, store.profile_days(params), out_dir, params, echo=echo, stored=True)
    finally:
        store.close()


def publish_pending_reports(spark: SparkSession, profile_day: DataFrame, out_dir: str, params: ReportParams, *,
                            buckets: int | None = None, echo: bool = False, stored: bool = False, versioned: bool = False) -> JobResult:
    """Compute and publish every report that has data and no published summary."""
    win = report_window(params)
    committed = commits.snapshot(spark, out_dir) if versioned else None
    done = set(committed.versions) if versioned else published_dates(spark, out_dir)
    todo = [d for d in possible_dates(win) if d not in done]
    if not todo:  # nothing due: do not even roll up
        return JobResult(win.first, win.last, 0)
    reports = reports_from_profile_day(spark, profile_day, params, durable=True, buckets=buckets, win=only_these(win, todo), stored=stored)
    try:
        # one row per report date; dates without any data never become reports
        due = pending_reports(reports.profile_day, reports.win, committed.reports() if versioned else published_partitions(spark, out_dir))
        pending = [r["end_date"] for r in due.select("end_date").collect()]
        if not pending:
            return JobResult(win.first, win.last, 0)
        reports.win = only_these(win, pending)
        if versioned:
            commits.publish(reports.summary, reports.histogram, out_dir)
        else:
            publish_histograms(reports.histogram, out_dir)
            publish_summaries(reports.summary, out_dir)
        if echo:
            # the console report of the newest report (about twenty lines)
            newest = reports.console.filter(F.col("end_date") == F.lit(max(pending))).orderBy("line")
            for row in newest.collect():
                print(row["text"])
        return JobResult(min(pending), max(pending), len(pending))
    finally:
        reports.release()
