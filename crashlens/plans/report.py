"""All reports of a run, as lazily built DataFrames over one profile-day table.

``build_reports`` takes raw pings and parameters and returns a ``Reports``
object whose methods are the report's tables. Nothing runs until an action.
With ``durable=True`` the profile-day rollup is first written as a table
bucketed by cid and partitioned by month (plans/storage.py), and everything
downstream reads it without shuffling on cid again; otherwise the run stays one
lazy plan over a single up-front repartition of the rollup on cid (the registered
test queries use this mode).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from crashlens.operators import calendar, cohort, history, summary, weekly
from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import profile_day as rollup
from crashlens.params import ReportParams
from crashlens.plans.storage import drop_files, drop_table, write_intermediate, write_profile_day


@dataclass
class Reports:
    params: ReportParams
    win: calendar.ReportWindow
    profile_day: DataFrame
    prepartitioned: bool = False
    durable: bool = False
    table: str | None = None
    _memo: dict = field(default_factory=dict, repr=False)
    _written: list[str] = field(default_factory=list, repr=False)

    def release(self) -> None:
        """Drop what a durable run has written for itself: its profile-day table and crash statistics."""
        spark = self.profile_day.sparkSession
        for path in self._written:
            drop_files(spark, path)
        self._written.clear()
        self._memo.clear()
        if self.table:
            drop_table(spark, self.table)
            self.table = None

    def calendar(self) -> DataFrame:
        return calendar.report_calendar(self.profile_day, self.win)

    @cached_property
    def weekly(self) -> DataFrame:
        return weekly.weekly_metrics(self.profile_day, self.win, self.params, prepartitioned=self.prepartitioned)

    def crash_stats(self, bounded: bool | None = None) -> DataFrame:
        bounded = self.params.history_bounded if bounded is None else bounded
        key = ("crash_stats", bounded)
        if key not in self._memo:
            stats = history.crash_stats(self.profile_day, self.win, bounded=bounded, prepartitioned=self.prepartitioned)
            if self.durable:
                # durable run: one small table per (report, crashed profile), read by the
                # median passes, the geometric mean and the histogram; written once to the
                # shared checkpoint folder, which also cuts the lineage.
                stats, path = write_intermediate(stats, self.profile_day.sparkSession, "crash_stats")
                self._written.append(path)
            self._memo[key] = stats
        return self._memo[key]

    @cached_property
    def history(self) -> DataFrame:
        return history.history_metrics(self.crash_stats())

    @cached_property
    def histogram(self) -> DataFrame:
        return history.hours_histogram(self.crash_stats())

    @cached_property
    def cohort_outcomes(self) -> DataFrame:
        return cohort.cohort_outcomes(self.profile_day, self.params, prepartitioned=self.prepartitioned, win=self.win)

    @cached_property
    def cohort_members(self) -> DataFrame:
        return cohort.cohort_members(self.cohort_outcomes, self.win, self.params)

    @cached_property
    def cohort(self) -> DataFrame:
        return cohort.cohort_metrics(self.cohort_members)

    @cached_property
    def metrics(self) -> DataFrame:
        return summary.combine_report_metrics(self.weekly, self.history, self.cohort)

    @cached_property
    def summary(self) -> DataFrame:
        return summary.weekly_summary(self.metrics, self.params)

    @cached_property
    def population(self) -> DataFrame:
        return summary.population_estimates(self.metrics, self.params)

    @cached_property
    def console(self) -> DataFrame:
        return summary.console_report(self.metrics, self.params)

    def crashed_history(self) -> DataFrame:
        return history.crashed_history(self.profile_day, self.win, prepartitioned=self.prepartitioned)

    def cohort_history(self) -> DataFrame:
        return cohort.cohort_history(self.profile_day, self.win, self.params, prepartitioned=self.prepartitioned)

    def longitudinal(self) -> DataFrame:
        return history.longitudinal(self.profile_day, self.win, prepartitioned=self.prepartitioned)


def build_reports(spark: SparkSession, raw_pings: DataFrame, params: ReportParams, *,
                  last_published: _dt.date | None = None, durable: bool = False,
                  buckets: int | None = None) -> Reports:
    return reports_from_profile_day(spark, rollup(clean_pings(raw_pings, params)), params,
                                    last_published=last_published, durable=durable, buckets=buckets)


def reports_from_profile_day(spark: SparkSession, pd: DataFrame, params: ReportParams, *,
                             last_published: _dt.date | None = None, durable: bool = False,
                             buckets: int | None = None, win: calendar.ReportWindow | None = None,
                             stored: bool = False) -> Reports:
    """``stored``: ``pd`` reads a table bucketed by cid (plans/history_store.py), which is used as it is."""
    win = win or calendar.report_window(params, last_published)
    table = None
    if stored:
        pass
    elif durable:
        table = f"crashlens_profile_day_{uuid.uuid4().hex[:10]}"
        pd = write_profile_day(pd, spark, buckets=buckets, table=table)
    else:
        # one shuffle on cid shared by every branch of a plan (identical subtrees are
        # reused as one exchange); downstream cid-keyed steps add none of their own
        pd = pd.repartition("cid")
    return Reports(params=params, win=win, profile_day=pd, prepartitioned=True, durable=durable, table=table)
