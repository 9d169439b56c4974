"""The new-profile cohort of each report.

The cohort of report E is every profile with a profile-day row whose creation
day lies in the report window shifted back 14 days, i.e. created between
E - 20 and E - 14. Each such profile is followed over its first two weeks
(creation day .. +13): did it crash at all (U2), when was its first crash and was
that in the second week (U3).

A profile's outcome does not depend on the report, so it is computed once per
profile (inside the cid partitions) and then attached to every report whose
cohort the profile belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlens.functions.crash import product_crashes
from crashlens.operators.calendar import ReportWindow, end_dates_covering
from crashlens.operators.profiles import by_profile, profiles_with_rows
from crashlens.params import ReportParams, date_to_epoch_day

DAY_PROBS = (0.1, 0.25, 0.5, 0.75, 0.9)
DAY_PROB_NAMES = ("days_p10", "days_p25", "days_p50", "days_p75", "days_p90")


def cohort_outcomes(profile_day: DataFrame, params: ReportParams, *, prepartitioned: bool = False,
                    win: ReportWindow | None = None) -> DataFrame:
    """One row per profile: pcd, crashed_two_weeks (U2 group: 1 if the crashes of rows
    up to pcd + 13 sum to >= 1), has_crashed / crashed_second_week /
    days_to_first_crash (U3: first crash row up to pcd + 13; days may be negative)
    and ``pcds``, the distinct creation days seen on its rows (cohort membership).

    With ``win`` only profiles that can be in one of its cohorts (a row created in
    [first - 20, last - 14]) are followed, over their whole history (J2)."""
    pd = by_profile(profile_day, prepartitioned)
    if win is not None:
        lo = date_to_epoch_day(win.scan_from) - params.cohort_lag_days
        hi = date_to_epoch_day(win.last) - params.cohort_lag_days
        pd = profiles_with_rows(pd, F.col("pcd").between(lo, hi))
    x = pd.select("cid", "day", "pcd", "cssm", "cdc")
    x = x.withColumn("pcd0", F.min("pcd").over(Window.partitionBy("cid")))
    birth = F.date_from_unix_date(F.col("pcd0"))
    in_two_weeks = F.col("day") <= F.date_add(birth, params.cohort_span_days - 1)
    crashes = product_crashes()
    per = x.groupBy("cid").agg(
        F.min("pcd0").alias("pcd"),
        F.sum(F.when(in_two_weeks, crashes)).alias("crashes_two_weeks"),
        F.min(F.when(in_two_weeks & (crashes > 0), F.col("day"))).alias("first_crash_day"),
        F.collect_set("pcd").alias("pcds"),
    )
    birth = F.date_from_unix_date(F.col("pcd"))
    first = F.col("first_crash_day")
    return per.select(
        "cid", "pcd", "pcds",
        F.when(F.coalesce(F.col("crashes_two_weeks"), F.lit(0)) >= 1, 1).otherwise(0).alias("crash_group"),
        first.isNotNull().alias("has_crashed"),
        F.coalesce(first >= F.date_add(birth, params.second_week_start), F.lit(False)).alias("crashed_second_week"),
        F.datediff(first, birth).alias("days_to_first_crash"),
    )


def cohort_members(outcomes: DataFrame, win: ReportWindow, params: ReportParams) -> DataFrame:
    """(end_date, cid) + outcome for every report whose cohort holds the profile."""
    ends = F.array_distinct(
        F.flatten(F.transform("pcds", lambda p: end_dates_covering(F.date_from_unix_date(p), win, params.cohort_lag_days)))
    )
    return outcomes.select(F.explode(ends).alias("end_date"), *[c for c in outcomes.columns if c != "pcds"])


def cohort_metrics(members: DataFrame) -> DataFrame:
    """A11-A13 per report: cohort size, crashed within two weeks, first crash in the
    second week, and count/mean/std/min/max/percentiles of days to first crash
    (crashed profiles with days >= 0). Days lie in 0..13, so the exact percentile
    buffer holds at most 14 distinct values per report."""
    crashed = F.col("has_crashed")
    days = F.when(crashed & (F.col("days_to_first_crash") >= 0), F.col("days_to_first_crash"))
    pct = F.percentile(days, list(DAY_PROBS))
    m = members.groupBy("end_date").agg(
        F.count(F.lit(1)).alias("cohort_profiles"),
        F.count_if(F.col("crash_group") == 1).alias("cohort_crashed"),
        F.count_if(crashed & F.col("crashed_second_week")).alias("cohort_crashed_second_week"),
        F.count(days).alias("days_count"),
        F.avg(days).alias("days_mean"),
        F.stddev_samp(days).alias("days_std"),
        F.min(days).alias("days_min"),
        F.max(days).alias("days_max"),
        pct.alias("_pct"),
    )
    return m.select(
        *[c for c in m.columns if c != "_pct"],
        *[F.col("_pct")[i].alias(name) for i, name in enumerate(DAY_PROB_NAMES)],
    )


def cohort_history(profile_day: DataFrame, win: ReportWindow, params: ReportParams, *,
                   prepartitioned: bool = False) -> DataFrame:
    """The full profile-day history of each report's cohort, one row per
    (report, history row)."""
    pd = by_profile(profile_day, prepartitioned)
    members = (
        pd.select("cid", "pcd").distinct()
        .select("cid", F.explode(end_dates_covering(F.date_from_unix_date("pcd"), win, params.cohort_lag_days)).alias("end_date"))
        .distinct()
    )
    return members.join(pd, "cid")
