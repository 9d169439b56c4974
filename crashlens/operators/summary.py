"""The weekly summary (one row per report, 23 published keys) and the
population estimates behind the console report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crashlens.params import PER_HOURS, ReportParams

RATE_KINDS = ("main", "content", "plugin")


def ratio(num: str, den: str) -> str:
    """A count ratio as SQL; NULL when the denominator is 0 or missing."""
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


def combine_report_metrics(weekly: DataFrame, history: DataFrame, cohort: DataFrame) -> DataFrame:
    """All per-report quantities side by side; the weekly metrics define which reports
    exist. Every input has one row per report, so these joins are tiny."""
    return weekly.join(history, "end_date", "left").join(cohort, "end_date", "left")


def summary_columns(params: ReportParams) -> list[str]:
    cols = ["date"]
    cols += [f"proportion_wau_crashes_{n}" for n in params.thresholds]
    cols += [f"proportion_new_crashes_{n}" for n in params.thresholds]
    cols += [
        "proportion_new_profiles", "proportion_first_time_crashes", "proportion_multiple_crashes",
        "proportion_e10s_enabled", "proportion_e10s_disabled",
    ]
    cols += [f"crash_rate_{k}_avg_by_user" for k in RATE_KINDS]
    cols += [f"crash_rate_{k}_avg_by_user_and_e10s_{s}" for s in ("enabled", "disabled") for k in RATE_KINDS]
    cols += [
        "median_hours_between_crashes", "geom_hours_between_crashes",
        "proportion_new_crashes_bis", "proportion_new_crashes_bis_second_week",
    ]
    return cols


def weekly_summary(metrics: DataFrame, params: ReportParams) -> DataFrame:
    """The published weekly summary, keyed by threshold (D8), ratios NULL on an
    empty denominator (D9), rates per 1000 hours (F12)."""
    exprs = ["date_format(end_date, 'yyyy-MM-dd') AS date"]
    exprs += [f"{ratio(f'crashed_{n}', 'wau')} AS proportion_wau_crashes_{n}" for n in params.thresholds]
    exprs += [f"{ratio(f'new_crashed_{n}', 'new_profiles')} AS proportion_new_crashes_{n}" for n in params.thresholds]
    exprs += [
        f"{ratio('new_profiles', 'wau')} AS proportion_new_profiles",
        f"{ratio('coalesce(first_time_crashers, 0)', 'crashed_1')} AS proportion_first_time_crashes",
        f"{ratio('coalesce(repeat_crashers, 0)', 'crashed_1')} AS proportion_multiple_crashes",
        f"{ratio('e10s_on_crashed', 'crashed_1')} AS proportion_e10s_enabled",
        f"{ratio('e10s_off_crashed', 'crashed_1')} AS proportion_e10s_disabled",
    ]
    exprs += [f"{k}_per_hour * {PER_HOURS}D AS crash_rate_{k}_avg_by_user" for k in RATE_KINDS]
    exprs += [
        f"{k}_per_hour_{tag} * {PER_HOURS}D AS crash_rate_{k}_avg_by_user_and_e10s_{state}"
        for tag, state in (("on", "enabled"), ("off", "disabled"))
        for k in RATE_KINDS
    ]
    exprs += [
        "median_hours_between_crashes",
        "geom_hours_between_crashes",
        f"{ratio('cohort_crashed', 'cohort_profiles')} AS proportion_new_crashes_bis",
        f"{ratio('cohort_crashed_second_week', 'cohort_profiles')} AS proportion_new_crashes_bis_second_week",
    ]
    return metrics.selectExpr("end_date", *exprs)


POPULATION_COUNTS = (
    ("wau", "active_profiles"),
    ("new_profiles", "new_profiles"),
    ("first_time_crashers", "first_time_crashers"),
    ("repeat_crashers", "repeat_crashers"),
    ("e10s_on_crashed", "e10s_enabled_crashed"),
    ("e10s_off_crashed", "e10s_disabled_crashed"),
    ("cohort_profiles", "cohort_profiles"),
    ("cohort_crashed", "cohort_crashed"),
    ("cohort_crashed_second_week", "cohort_crashed_second_week"),
)


def population_estimates(metrics: DataFrame, params: ReportParams) -> DataFrame:
    """Sample counts scaled to the population (x100 for a 1% sample), plus the
    console's days-to-first-crash figures. F15: ``active_profiles_text`` carries the
    thousands-separated text of the active-profile estimate."""
    f = params.population_factor
    exprs = [f"CAST(coalesce({src}, 0) AS DOUBLE) * {f}D AS {name}_estimate" for src, name in POPULATION_COUNTS]
    for n in params.thresholds:
        exprs.append(f"CAST(crashed_{n} AS DOUBLE) * {f}D AS crashed_{n}_estimate")
        exprs.append(f"CAST(new_crashed_{n} AS DOUBLE) * {f}D AS new_crashed_{n}_estimate")
    exprs += ["days_mean AS mean_days_to_first_crash", "days_p50 AS median_days_to_first_crash",
              "days_p90 AS p90_days_to_first_crash",
              f"format_number(CAST(wau AS DOUBLE) * {f}D, 0) AS active_profiles_text"]
    return metrics.selectExpr("end_date", *exprs)


def console_report(metrics: DataFrame, params: ReportParams) -> DataFrame:
    """The weekly console report as text, one row per (report, line).

    Counts are population estimates (sample count x 100 for a 1% sample) with thousands
    separators; shares are percentages with two decimals; rates are per 1000 hours.
    Built from the per-report metrics only (one row per report), never from profiles.
    """
    f = params.population_factor

    def est(col: str) -> str:
        return f"format_number(CAST(coalesce({col}, 0) AS DOUBLE) * {f}D, 0)"

    # format_string does not return NULL for a NULL argument, so test for it first
    def pct(num: str, den: str) -> str:
        r = ratio(num, den)
        return f"CASE WHEN {r} IS NULL THEN 'n/a' ELSE format_string('%.2f%%', {r} * 100) END"

    def num(col: str) -> str:
        return f"CASE WHEN {col} IS NULL THEN 'n/a' ELSE format_string('%.2f', {col}) END"

    lines = [
        f"concat('Active profiles: ', {est('wau')})",
        *[f"concat('Profiles with {n}+ crashes: ', {est(f'crashed_{n}')}, ' (', {pct(f'crashed_{n}', 'wau')}, ' of active)')"
          for n in params.thresholds],
        f"concat('New profiles: ', {est('new_profiles')}, ' (', {pct('new_profiles', 'wau')}, ' of active)')",
        *[f"concat('New profiles with {n}+ crashes: ', {est(f'new_crashed_{n}')}, ' (', "
          f"{pct(f'new_crashed_{n}', 'new_profiles')}, ' of new)')" for n in params.thresholds],
        f"concat('First crash on record: ', {est('first_time_crashers')}, ' (', {pct('first_time_crashers', 'crashed_1')}, ' of crashed)')",
        f"concat('Crashed before: ', {est('repeat_crashers')}, ' (', {pct('repeat_crashers', 'crashed_1')}, ' of crashed)')",
        f"concat('Cohort created two weeks earlier: ', {est('cohort_profiles')})",
        f"concat('Cohort crashed within two weeks: ', {est('cohort_crashed')}, ' (', {pct('cohort_crashed', 'cohort_profiles')}, ')')",
        f"concat('Cohort first crash in week two: ', {est('cohort_crashed_second_week')}, ' (', "
        f"{pct('cohort_crashed_second_week', 'cohort_profiles')}, ' of cohort, ', "
        f"{pct('cohort_crashed_second_week', 'cohort_crashed')}, ' of those that crashed)')",
        f"concat('Days to first crash: mean ', {num('days_mean')}, ', median ', {num('days_p50')}, ', p90 ', {num('days_p90')})",
        f"concat('e10s enabled among crashed: ', {est('e10s_on_crashed')}, ' (', {pct('e10s_on_crashed', 'crashed_1')}, ')')",
        f"concat('e10s disabled among crashed: ', {est('e10s_off_crashed')}, ' (', {pct('e10s_off_crashed', 'crashed_1')}, ')')",
        *[f"concat('{k.capitalize()} crashes per 1000 hours: ', {num(f'{k}_per_hour * {PER_HOURS}D')})" for k in RATE_KINDS],
        *[f"concat('{k.capitalize()} crashes per 1000 hours, e10s {word}: ', {num(f'{k}_per_hour_{state} * {PER_HOURS}D')})"
          for state, word in (("on", "enabled"), ("off", "disabled")) for k in RATE_KINDS],
    ]
    arr = "array(" + ", ".join(f"named_struct('line', {i}, 'text', {t})" for i, t in enumerate(lines)) + ")"
    return metrics.selectExpr("end_date", f"explode({arr}) AS l").selectExpr("end_date", "l.line AS line", "l.text AS text")
