"""Hours between a profile's two latest crashes.

For a profile that crashed in a report's week, walk its profile-day rows from
newest to oldest (ordered by sd, cdc, cssm, cdpgmp, ssl). The first crash row
found is f. If f holds more than one crash the gap is 0 hours; otherwise the
next older crash row n ends the gap and the hours are the session seconds of
rows f (inclusive) .. n (exclusive) / 3600; without n the profile has its first
crash (no gap).

Instead of a per-profile Python walk this is a gaps-and-islands window:
oldest first, ``g`` = number of crash rows strictly before a row. The rows with
the same g form an island that ends in crash number g, and the island sum of
ssl is exactly the f..n slice of the walk. So each crash row carries its own
(multi, hours) answer, and a report takes the newest crash its history can see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.functions.crash import hours, is_crash_row
from crashlens.functions.stats import exact_percentiles, geometric_mean
from crashlens.operators.calendar import ReportWindow, days_between, explode_to_reports, with_month
from crashlens.operators.profiles import by_profile, profiles_with_rows

SORT_KEYS = ("sd", "cdc", "cssm", "cdpgmp", "ssl")


def crash_islands(profile_day: DataFrame, *, prepartitioned: bool = False) -> DataFrame:
    """One row per profile and island: cid, g (crash rows before it), whether a crash row ends
    it, its session seconds, and that row's day and crashes."""
    order = ", ".join(SORT_KEYS)
    x = by_profile(profile_day, prepartitioned).selectExpr(
        "cid", *SORT_KEYS, "day", "cssm + cdc > 0 AS crash", "cssm + cdc AS t",
    ).withColumn("g", F.expr(
        "coalesce(sum(CAST(crash AS BIGINT)) OVER (PARTITION BY cid ORDER BY "
        f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    ))
    return x.groupBy("cid", "g").agg(*[F.expr(e) for e in (
        "bool_or(crash) AS ends_in_crash",
        "sum(ssl) AS island_seconds",
        "max(CASE WHEN crash THEN day END) AS day",
        "max(CASE WHEN crash THEN t END) AS t",
    )])


def crash_gaps(profile_day: DataFrame, *, prepartitioned: bool = False) -> DataFrame:
    """One row per crash row: cid, day, g (crash ordinal, oldest = 0), crashes on the
    row, session seconds since the previous crash row (exclusive) up to this one."""
    islands = crash_islands(profile_day, prepartitioned=prepartitioned)
    return islands.where("ends_in_crash").selectExpr(
        "cid", "day", "g", "t",
        "t > 1 OR g > 0 AS has_multiple_crashes",
        "CASE WHEN t > 1 THEN CAST(0 AS BIGINT) WHEN g > 0 THEN island_seconds END AS seconds",
    )


def crash_stats(profile_day: DataFrame, win: ReportWindow, *, bounded: bool = True,
                prepartitioned: bool = False) -> DataFrame:
    """U1 for every (report, profile that crashed in the report's week).

    Columns: end_date, cid, has_multiple_crashes, seconds (NULL without a gap),
    hours. ``bounded`` (D3): the newest crash on or before the report's end date;
    otherwise the newest crash of the whole history, as the original job did.
    """
    if bounded:
        # rows after the last report can never be seen (sd is a partition / pushed filter)
        profile_day = days_between(profile_day, None, win.last)
    profile_day = by_profile(profile_day, prepartitioned)
    # Only profiles with a crash row inside some report window need their history
    in_windows = days_between(profile_day, win.scan_from, win.last)   # prunes month partitions
    profile_day = profiles_with_rows(profile_day, is_crash_row(), source=in_windows)
    gaps = crash_gaps(profile_day, prepartitioned=True)
    if bounded:
        # the newest crash inside the report's week is the newest one it can see
        pick = ("max_by(has_multiple_crashes, g) AS m", "max_by(seconds, g) AS s")
    else:
        # the newest crash of the whole history, the same for every report of the profile
        gaps = gaps.selectExpr(
            "cid", "day",
            "max_by(has_multiple_crashes, g) OVER (PARTITION BY cid) AS has_multiple_crashes",
            "max_by(seconds, g) OVER (PARTITION BY cid) AS seconds",
        )
        pick = ("max(has_multiple_crashes) AS m", "max(seconds) AS s")
    out = explode_to_reports(gaps, win).groupBy("end_date", "cid").agg(*[F.expr(e) for e in pick])
    return out.selectExpr("end_date", "cid", "m AS has_multiple_crashes", "s AS seconds", "s / 60 / 60 AS hours")


def history_metrics(stats: DataFrame) -> DataFrame:
    """A10, A15, A16 per report: first-time vs repeat crashers, median and geometric
    mean of the hours between the two latest crashes (repeat crashers only)."""
    counts = stats.groupBy("end_date").agg(
        F.count_if(~F.col("has_multiple_crashes")).alias("first_time_crashers"),
        F.count_if(F.col("has_multiple_crashes")).alias("repeat_crashers"),
        geometric_mean(F.col("hours")).alias("geom_hours_between_crashes"),
    )
    med = exact_percentiles(stats, ["end_date"], "seconds", [0.5], ["median_seconds"])
    med = med.select("end_date", hours(F.col("median_seconds")).alias("median_hours_between_crashes"))
    return counts.join(med, "end_date", "left")


def hours_histogram(stats: DataFrame) -> DataFrame:
    """Repeat crashers counted by whole hours (ceiling)."""
    return (
        stats.filter(F.col("has_multiple_crashes"))
        .groupBy("end_date", F.ceil("hours").cast("int").alias("hours"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def hours_histogram_view(histogram: DataFrame, max_hours: int = 30) -> DataFrame:
    """The chart shows 0..30 hours."""
    return histogram.filter(F.col("hours").between(0, max_hours))


def crashed_profiles_in_week(profile_day: DataFrame, win: ReportWindow) -> DataFrame:
    """J1 left side / A19: distinct (report, cid) with a crash row inside the window."""
    crash_rows = profile_day.filter(is_crash_row()).select(*with_month(profile_day, "cid", "day"))
    return explode_to_reports(crash_rows, win).select("end_date", "cid").distinct()


def crashed_history(profile_day: DataFrame, win: ReportWindow, *, prepartitioned: bool = False) -> DataFrame:
    """The full profile-day history of every profile that crashed in a report's week.

    An equi join on cid. Both sides are partitioned on cid, so the join needs no further
    shuffle. The result repeats a profile's history once per report: it is for looking at
    single reports; the job itself never builds it.
    """
    pd = by_profile(profile_day, prepartitioned)
    crashed = crashed_profiles_in_week(pd, win)
    return crashed.join(pd, "cid")


def longitudinal(profile_day: DataFrame, win: ReportWindow, *, prepartitioned: bool = False) -> DataFrame:
    """One row per profile that crashed in some report's week (J1), with its
    creation day and its day rows as one array of structs, oldest first (one array, so
    fields cannot misalign). A profile's array is bounded by its number of (day, e10s) rows."""
    row = F.struct(*[F.col(c) for c in SORT_KEYS])
    pd = by_profile(profile_day, prepartitioned)
    pd = profiles_with_rows(pd, is_crash_row(), source=explode_to_reports(days_between(pd, win.scan_from, win.last), win))
    return pd.groupBy("cid").agg(F.min("pcd").alias("pcd"), F.array_sort(F.collect_list(row)).alias("history"))
