"""A2-A6 by an interval sweep: no row is repeated for the reports that see it.

A profile-day row is seen by the reports that end on its day or within the six days after. So
it adds its figures at its day and takes them back seven days later: two events, whatever the
number of reports. Running sums over a profile's events say from which day to which a count
holds for it (active, crashed n times, crashed with e10s on); where that changes, the profile
adds or takes back one from the total of all profiles. The totals are a row for each day.

A row of a new profile is seen while both its day and its creation day lie in the window: from
the later of the two until seven days after the earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlens.operators.calendar import ReportWindow, days_between, is_report_day, with_month
from crashlens.operators.profiles import by_profile
from crashlens.params import ReportParams

FIGURES = ("seen", "active", "active_crashes", "new", "new_crashes", "on_crashes", "off_crashes")


def profile_events(rows: DataFrame, days: int) -> DataFrame:
    """cid, at and the change of each figure at that day: two events for a row, two more for
    an active row of a new profile."""
    def event(at: str, sign: str, **figures: str) -> str:
        values = ", ".join(f"'{f}', {sign}CAST({figures[f] if f in figures else 0} AS BIGINT)" for f in FIGURES)
        return f"named_struct('at', {at}, {values})"

    own = {"seen": "1", "active": "int(ssl > 0)", "active_crashes": "if(ssl > 0, crashes, 0)",
           "on_crashes": "if(e10s, crashes, 0)", "off_crashes": "if(e10s, 0, crashes)"}
    new = {"new": "1", "new_crashes": "crashes"}
    events = f"array({event('day', '', **own)}, {event(f'date_add(day, {days})', '-', **own)})"
    both = f"array({event('greatest(day, born)', '', **new)}, {event(f'date_add(least(day, born), {days})', '-', **new)})"
    is_new = f"ssl > 0 AND abs(datediff(day, born)) < {days}"
    rows = rows.selectExpr("cid", "day", "e10s", "ssl", "cssm + cdc AS crashes", "date_from_unix_date(pcd) AS born")
    return rows.selectExpr("cid", f"inline(if({is_new}, concat({events}, {both}), {events}))")


def weekly_counts(profile_day: DataFrame, win: ReportWindow, params: ReportParams, *, prepartitioned: bool = False) -> DataFrame:
    """end_date, wau, crashed_<n>, new_profiles, new_crashed_<n>, e10s_{on,off}_crashed: the
    same rows as ``weekly.weekly_metrics`` has."""
    pd = by_profile(profile_day, prepartitioned).select(*with_month(profile_day, "cid", "day", "e10s", "pcd", "ssl", "cssm", "cdc"))
    events = profile_events(days_between(pd, win.scan_from, win.last), win.days)
    changes = events.groupBy("cid", "at").agg(*[F.sum(f).alias(f) for f in FIGURES])
    so_far = Window.partitionBy("cid").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    level = changes.select("cid", "at", *[F.sum(f).over(so_far).alias(f) for f in FIGURES])

    holds = {"seen": "seen > 0", "wau": "active > 0", "new_profiles": "new > 0",
             "e10s_on_crashed": "on_crashes > 0", "e10s_off_crashed": "off_crashes > 0"}
    for n in params.thresholds:
        holds |= {f"crashed_{n}": f"active > 0 AND active_crashes >= {n}", f"new_crashed_{n}": f"new > 0 AND new_crashes >= {n}"}
    flags = level.selectExpr("cid", "at", *[f"int({c}) AS {name}" for name, c in holds.items()])
    before = Window.partitionBy("cid").orderBy("at")
    steps = flags.select("at", *[(F.col(c) - F.lag(c, 1, 0).over(before)).alias(c) for c in holds])

    # a row for each day; report days without any event of their own carry the last total on
    ends = profile_day.sparkSession.range(1).select(F.explode(F.sequence(F.lit(win.first), F.lit(max(win.first, win.last)))).alias("at"))
    totals = steps.groupBy("at").agg(*[F.sum(c).alias(c) for c in holds])
    totals = totals.unionByName(ends.select("at", *[F.lit(0).cast("long").alias(c) for c in holds])).groupBy("at").agg(*[F.sum(c).alias(c) for c in holds])
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    out = totals.select(F.col("at").alias("end_date"), *[F.sum(c).over(upto).alias(c) for c in holds])
    return out.where(is_report_day(F.col("end_date"), win) & (F.col("seen") > 0)).drop("seen")
