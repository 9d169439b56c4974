"""U1 as a mergeable state, so that a new day does not sort whole histories again.

A *segment* sums up a stretch of a profile's days: how many crash rows it has (``n``), the
session seconds up to its first crash row (``head``, that row included) and after its last one
(``tail``; both are all its seconds where it has none), the crashes on the first and last crash
row, the day of the last one and the seconds between its last two (``gap``). Segments of
adjoining stretches merge, and merging is associative: the gap across the seam is the tail of
the earlier plus the head of the later one.

The segment of a profile up to a report's end date holds that report's answer: the profile
counts when its last crash lies in the report's week, and the hours are the gap. So a run
needs the segments of yesterday and the rows that came in since, both keyed by cid.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.operators.calendar import ReportWindow, days_between, is_report_day
from crashlens.operators.history import crash_islands, crashed_profiles_in_week
from crashlens.operators.profiles import by_profile

SEGMENT = ("n", "head", "tail", "first_t", "last_t", "last_day", "gap")


def segments(profile_day: DataFrame, *, prepartitioned: bool = False) -> DataFrame:
    """One segment for each profile over the given rows."""
    ends = "CASE WHEN ends_in_crash THEN g END"
    return crash_islands(profile_day, prepartitioned=prepartitioned).groupBy("cid").agg(*[F.expr(e) for e in (
        "count_if(ends_in_crash) AS n",
        "sum(CASE WHEN g = 0 THEN island_seconds END) AS head",
        "coalesce(sum(CASE WHEN NOT ends_in_crash THEN island_seconds END), 0) AS tail",
        "max(CASE WHEN g = 0 THEN t END) AS first_t",
        f"max_by(t, {ends}) AS last_t",
        f"max_by(day, {ends}) AS last_day",
        f"max_by(CASE WHEN g > 0 THEN island_seconds END, {ends}) AS gap",
    )]).select("cid", *SEGMENT)


def merge_segments(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """The segments of two adjoining stretches as one, for profiles of either."""
    a, b = (df.select("cid", F.struct(*SEGMENT).alias(name)) for df, name in ((earlier, "a"), (later, "b")))
    both = a.join(b, "cid", "full_outer")

    def merged(name: str, when_both: str) -> str:
        return f"CASE WHEN b IS NULL THEN a.{name} WHEN a IS NULL THEN b.{name} ELSE {when_both} END AS {name}"

    return both.selectExpr(
        "cid",
        merged("n", "a.n + b.n"),
        merged("head", "CASE WHEN a.n > 0 THEN a.head ELSE a.tail + b.head END"),
        merged("tail", "CASE WHEN b.n > 0 THEN b.tail ELSE a.tail + b.tail END"),
        merged("first_t", "CASE WHEN a.n > 0 THEN a.first_t ELSE b.first_t END"),
        merged("last_t", "CASE WHEN b.n > 0 THEN b.last_t ELSE a.last_t END"),
        merged("last_day", "CASE WHEN b.n > 0 THEN b.last_day ELSE a.last_day END"),
        merged("gap", "CASE WHEN b.n > 1 THEN b.gap WHEN b.n = 0 THEN a.gap WHEN a.n > 0 THEN a.tail + b.head END"),
    )


def refold(state: DataFrame, history: DataFrame, late: DataFrame) -> DataFrame:
    """Rows came in for days that the state has already seen: the segments of their profiles
    (``late``: cid) are made anew from the profiles' whole ``history``, all others stay."""
    ids = late.select("cid").distinct()
    anew = segments(history.join(ids, "cid", "left_semi"))
    return state.join(ids, "cid", "left_anti").unionByName(anew)


def answers(state: DataFrame) -> DataFrame:
    """cid, last_day, has_multiple_crashes, seconds, hours of the profiles that have crashed."""
    out = state.where("n > 0").selectExpr(
        "cid", "last_day", "last_t > 1 OR n > 1 AS has_multiple_crashes",
        "CASE WHEN last_t > 1 THEN CAST(0 AS BIGINT) ELSE gap END AS seconds")
    return out.withColumn("hours", F.expr("seconds / 60 / 60"))


def report_stats(state: DataFrame, end_date: _dt.date, win: ReportWindow) -> DataFrame:
    """The crash statistics of the report of ``end_date``, from the state up to that day."""
    end = F.lit(end_date)
    return answers(state).where(F.col("last_day").between(F.date_sub(end, win.days - 1), end)).select(
        end.alias("end_date"), "cid", "has_multiple_crashes", "seconds", "hours")


def stats_day_by_day(profile_day: DataFrame, win: ReportWindow, keep: Callable[[DataFrame], DataFrame], *,
                     bounded: bool = True, prepartitioned: bool = False) -> DataFrame:
    """The crash statistics of all reports, the state carried from one report date to the next
    as daily runs would. ``keep`` stores a table and returns it (a run's new state)."""
    pd = by_profile(profile_day, prepartitioned)
    due = [r["d"] for r in pd.sparkSession.range(1).select(F.explode(F.sequence(F.lit(win.first), F.lit(win.last))).alias("d")).where(
        is_report_day(F.col("d"), win)).orderBy("d").collect()] if win.first <= win.last else []
    if not due:
        return report_stats(segments(pd.limit(0)), win.last, win)
    state, upto, out = None, None, []
    for end_date in due:
        new = segments(days_between(pd, None if upto is None else upto + _dt.timedelta(days=1), end_date), prepartitioned=True)
        state, upto = keep(new if state is None else merge_segments(state, new)), end_date
        out.append(report_stats(state, end_date, win))
    if bounded:
        return reduce(DataFrame.unionByName, out)
    # D3 off: every report sees the newest crash of the whole history, later days included
    rest = segments(days_between(pd, upto + _dt.timedelta(days=1), None), prepartitioned=True)
    newest = answers(keep(merge_segments(state, rest))).drop("last_day")
    return crashed_profiles_in_week(pd, win).join(newest, "cid").select("end_date", "cid", "has_multiple_crashes", "seconds", "hours")
