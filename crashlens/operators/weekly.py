"""The weekly profile metrics of every report, in one pass.

Plan: profile-day rows -> (shuffle on cid, unless the input is already bucketed by
cid) -> expand each row to the reports whose window contains it -> one aggregate
per (report, profile) that keeps row-level conditions (active, new) as
conditional sums -> one aggregate per report. The per-(report, profile) step
runs inside the cid partitions, so the only other shuffle carries partial
per-report aggregates. ``count(distinct cid)`` becomes a plain conditional count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.operators.calendar import ReportWindow, explode_to_reports, with_month
from crashlens.operators.profiles import by_profile
from crashlens.params import ReportParams

E10S_STATES = ((True, "on"), (False, "off"))
RATE_KINDS = (("main", "cssm"), ("content", "cdc"), ("plugin", "cdpgmp"))


def weekly_profile_rows(profile_day: DataFrame, win: ReportWindow, *, prepartitioned: bool = False) -> DataFrame:
    """One row per (end_date, cid) with every per-profile quantity A2-A8 need.

    The aggregate list is written as SQL expressions: the same plan as the Column
    API, built with one JVM call per expression instead of dozens.
    """
    cols = with_month(profile_day, "cid", "day", "e10s", "pcd", "ssl", "cssm", "cdc", "cdpgmp")
    rows = explode_to_reports(by_profile(profile_day, prepartitioned).select(*cols), win)
    active = "ssl > 0"                                                                   # P11
    new = f"ssl > 0 AND pcd BETWEEN unix_date(date_sub(end_date, {win.days - 1})) AND unix_date(end_date)"  # P12
    crashes = "cssm + cdc"
    aggs = [
        f"bool_or({active}) AS active",
        f"sum(CASE WHEN {active} THEN {crashes} END) AS active_crashes",
        f"bool_or({new}) AS new_active",
        f"sum(CASE WHEN {new} THEN {crashes} END) AS new_active_crashes",
        "sum(ssl) AS ssl", "sum(cssm) AS cssm", "sum(cdc) AS cdc", "sum(cdpgmp) AS cdpgmp",
    ]
    for flag, tag in E10S_STATES:
        state = "e10s" if flag else "NOT e10s"
        aggs += [f"sum(CASE WHEN {state} THEN {c} END) AS {c}_{tag}" for c in ("ssl", "cssm", "cdc", "cdpgmp")]
        aggs.append(f"sum(CASE WHEN {state} THEN {crashes} END) AS crashes_{tag}")
    return rows.groupBy("end_date", "cid").agg(*[F.expr(a) for a in aggs])


def _per_hour(num: str, seconds: str) -> str:
    """Crashes per hour of use; NULL without use."""
    return f"try_divide({num}, {seconds} / 60 / 60)"


def weekly_metrics(profile_day: DataFrame, win: ReportWindow, params: ReportParams, *,
                   prepartitioned: bool = False) -> DataFrame:
    """One row per report end date:

    * ``wau``                      A2 distinct profiles with an active row (ssl > 0)
    * ``crashed_<n>``              A3 active profiles whose active rows sum to >= n crashes
    * ``new_profiles``             A4 active profiles created inside the window
    * ``new_crashed_<n>``          A5 A3 over those rows only
    * ``e10s_{on,off}_crashed``    A6 profiles with > 0 crashes in that e10s state (all rows)
    * ``{main,content,plugin}_per_hour[_on|_off]``  A7 / A8 mean over profiles of
      crashes / hours (all rows; profiles without use give NULL and are skipped)
    """
    p = weekly_profile_rows(profile_day, win, prepartitioned=prepartitioned)
    aggs = ["count_if(active) AS wau"]
    aggs += [f"count_if(active AND active_crashes >= {n}) AS crashed_{n}" for n in params.thresholds]
    aggs.append("count_if(coalesce(new_active, false)) AS new_profiles")
    aggs += [f"count_if(new_active AND new_active_crashes >= {n}) AS new_crashed_{n}" for n in params.thresholds]
    aggs += [f"count_if(crashes_{tag} > 0) AS e10s_{tag}_crashed" for _, tag in E10S_STATES]
    aggs += [f"avg({_per_hour(col, 'ssl')}) AS {kind}_per_hour" for kind, col in RATE_KINDS]
    aggs += [
        f"avg({_per_hour(f'{col}_{tag}', f'ssl_{tag}')}) AS {kind}_per_hour_{tag}"
        for _, tag in E10S_STATES
        for kind, col in RATE_KINDS
    ]
    return p.groupBy("end_date").agg(*[F.expr(a) for a in aggs])
