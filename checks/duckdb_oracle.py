"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code, in the shape of the original job: one
query per metric, evaluated week by week through a calendar join, the crash
history as an explicit newest-first walk (row numbers) rather than the Spark
gaps-and-islands window. Doubles are rounded to 6 places on both sides.

The fixture parameters (FIXTURES.md): sample '42', sd floor 20160701,
pcd in [14610, 19753], reports on weekdays 2024-01-08 .. 2024-01-30.
"""

from __future__ import annotations

from crashlens.operators.series import SHUTDOWN_KILL_NOTE_DATE, SHUTDOWN_KILL_NOTE_LABEL

FIRST_REPORT = "2024-01-08"
LAST_REPORT = "2024-01-30"
PCD_FLOOR = 14610
PCD_CEILING = 19753
PUBLISHED_GAPS = ("2024-01-10", "2024-01-22", "2024-01-30")  # reports left out before asking what is pending
ASKED_WEEKS = ("2024-01-13", "2024-01-24", "2024-01-30")     # the first is a Saturday: nothing published
R = 6  # rounding of doubles for comparison

BASE = f"""
raw AS (
  SELECT user_id AS cid,
         CASE WHEN user_id % 10 = 9 THEN '7' ELSE '42' END AS sid,
         CASE WHEN event_id % 23 = 0 THEN 'beta' ELSE 'release' END AS channel,
         strftime(ts, '%Y%m%d') AS sd,
         CASE WHEN event_id % 29 = 0 THEN 'Fennec' ELSE 'Firefox' END AS appname,
         CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN -1
              WHEN event_id % 31 = 0 OR user_id % 60 = 13 THEN 0
              ELSE CAST(floor(value * 300) AS BIGINT) END AS ssl,
         CAST(CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_type = 'error' AND event_id % 9 = 0 THEN 1 ELSE 0 END AS BIGINT) AS cssm,
         CAST(CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_type = 'error' AND event_id % 8 = 1 THEN 1 ELSE 0 END AS BIGINT) AS cdc,
         CAST(CASE WHEN event_id % 11 = 3 AND event_type = 'view' THEN 1 ELSE 0 END AS BIGINT) AS sk,
         CAST(CASE WHEN event_type = 'click' AND event_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS cdgmp,
         CAST(CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS cdp,
         CAST(CASE WHEN user_id % 50 = 7 THEN 14000 WHEN user_id % 50 = 8 THEN 20000
              ELSE 19718 + user_id % 30 END AS INTEGER) AS pcd,
         CASE WHEN event_id % 43 = 0 THEN NULL ELSE (user_id + hour(ts) // 12) % 2 = 0 END AS e10s
  FROM events
),
clean AS (
  SELECT cid, sid, channel, sd, appname, ssl,
         coalesce(cssm, 0) AS cssm, coalesce(cdc, 0) AS cdc, coalesce(sk, 0) AS sk,
         coalesce(cdgmp, 0) AS cdgmp, coalesce(cdp, 0) AS cdp, pcd, e10s
  FROM raw
  WHERE sid = '42' AND channel = 'release' AND appname = 'Firefox' AND sd >= '20160701'
    AND ssl >= 0 AND ssl <= 86400 AND pcd >= {PCD_FLOOR} AND pcd <= {PCD_CEILING}
    AND e10s IN (true, false) AND cid IS NOT NULL
),
agg AS (
  SELECT cid, sd, e10s, min(pcd) AS pcd,
         CAST(sum(ssl) AS BIGINT) AS ssl, CAST(sum(cssm) AS BIGINT) AS cssm,
         CAST(sum(cdc - sk) AS BIGINT) AS cdc, CAST(sum(cdgmp + cdp) AS BIGINT) AS cdpgmp
  FROM clean GROUP BY cid, sd, e10s
),
cal AS (
  SELECT CAST(d AS DATE) AS end_date,
         strftime(CAST(d AS DATE) - 6, '%Y%m%d') AS start_sd,
         strftime(CAST(d AS DATE), '%Y%m%d') AS end_sd,
         date_diff('day', DATE '1970-01-01', CAST(d AS DATE)) AS end_int
  FROM generate_series(DATE '{FIRST_REPORT}', DATE '{LAST_REPORT}', INTERVAL 1 DAY) AS g(d)
  WHERE isodow(CAST(d AS DATE)) <= 5
),
wk AS (
  SELECT c.end_date, c.end_int, a.*
  FROM cal c JOIN agg a ON a.sd BETWEEN c.start_sd AND c.end_sd
),
weeks AS (SELECT DISTINCT end_date, end_int FROM wk)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip(), *[c.strip() for c in ctes if c]])


def _rnd(expr: str) -> str:
    # + 0.0 turns a rounded -0.0 into 0.0, as Spark's decimal-based round does
    return f"(round({expr}, {R}) + 0.0)"


# ---- per-metric CTEs, as the original per-week queries -------------------------

A3 = """
crashed_per AS (
  SELECT end_date, cid, sum(cssm + cdc) AS total_crashes
  FROM wk WHERE ssl > 0 GROUP BY end_date, cid
),
crashed_cnt AS (
  SELECT w.end_date,
         CAST(count(p.cid) FILTER (WHERE p.total_crashes >= 1) AS BIGINT) AS crashed_1,
         CAST(count(p.cid) FILTER (WHERE p.total_crashes >= 2) AS BIGINT) AS crashed_2
  FROM weeks w LEFT JOIN crashed_per p USING (end_date) GROUP BY w.end_date
)
"""

A2_A4 = """
wau_cnt AS (
  SELECT end_date,
         CAST(count(DISTINCT cid) FILTER (WHERE ssl > 0) AS BIGINT) AS wau,
         CAST(count(DISTINCT cid) FILTER (WHERE ssl > 0 AND pcd BETWEEN end_int - 6 AND end_int) AS BIGINT) AS new_profiles
  FROM wk GROUP BY end_date
)
"""

A5 = """
new_per AS (
  SELECT end_date, cid, sum(cssm + cdc) AS total_crashes
  FROM wk WHERE ssl > 0 AND pcd BETWEEN end_int - 6 AND end_int GROUP BY end_date, cid
),
new_cnt AS (
  SELECT w.end_date,
         CAST(count(p.cid) FILTER (WHERE p.total_crashes >= 1) AS BIGINT) AS new_crashed_1,
         CAST(count(p.cid) FILTER (WHERE p.total_crashes >= 2) AS BIGINT) AS new_crashed_2
  FROM weeks w LEFT JOIN new_per p USING (end_date) GROUP BY w.end_date
)
"""

A6 = """
e10s_per AS (
  SELECT end_date, cid, e10s, sum(cssm + cdc) AS total_crashes
  FROM wk GROUP BY end_date, cid, e10s HAVING sum(cssm + cdc) > 0
),
e10s_cnt AS (
  SELECT w.end_date,
         CAST(count(p.cid) FILTER (WHERE p.e10s) AS BIGINT) AS e10s_enabled,
         CAST(count(p.cid) FILTER (WHERE NOT p.e10s) AS BIGINT) AS e10s_disabled
  FROM weeks w LEFT JOIN e10s_per p USING (end_date) GROUP BY w.end_date
)
"""

A7 = """
rate_per AS (
  SELECT end_date, cid,
         sum(cssm) / NULLIF(sum(ssl) / 60 / 60, 0) AS mc,
         sum(cdc) / NULLIF(sum(ssl) / 60 / 60, 0) AS cc,
         sum(cdpgmp) / NULLIF(sum(ssl) / 60 / 60, 0) AS pc
  FROM wk GROUP BY end_date, cid
),
rates AS (
  SELECT end_date, avg(mc) * 1000 AS crash_rate_main_avg_by_user,
         avg(cc) * 1000 AS crash_rate_content_avg_by_user,
         avg(pc) * 1000 AS crash_rate_plugin_avg_by_user
  FROM rate_per GROUP BY end_date
)
"""

A8 = """
rate_e10s_per AS (
  SELECT end_date, cid, e10s,
         sum(cssm) / NULLIF(sum(ssl) / 60 / 60, 0) AS mc,
         sum(cdc) / NULLIF(sum(ssl) / 60 / 60, 0) AS cc,
         sum(cdpgmp) / NULLIF(sum(ssl) / 60 / 60, 0) AS pc
  FROM wk GROUP BY end_date, cid, e10s
),
rates_e10s AS (
  SELECT end_date,
         avg(mc) FILTER (WHERE e10s) * 1000 AS crash_rate_main_avg_by_user_and_e10s_enabled,
         avg(cc) FILTER (WHERE e10s) * 1000 AS crash_rate_content_avg_by_user_and_e10s_enabled,
         avg(pc) FILTER (WHERE e10s) * 1000 AS crash_rate_plugin_avg_by_user_and_e10s_enabled,
         avg(mc) FILTER (WHERE NOT e10s) * 1000 AS crash_rate_main_avg_by_user_and_e10s_disabled,
         avg(cc) FILTER (WHERE NOT e10s) * 1000 AS crash_rate_content_avg_by_user_and_e10s_disabled,
         avg(pc) FILTER (WHERE NOT e10s) * 1000 AS crash_rate_plugin_avg_by_user_and_e10s_disabled
  FROM rate_e10s_per GROUP BY end_date
)
"""

J1 = """
crashed_ids AS (
  SELECT DISTINCT end_date, cid FROM wk WHERE cssm + cdc > 0
)
"""


def _walk(bounded: bool) -> str:
    """U1 as the original newest-first walk over row numbers."""
    bound = "AND a.sd <= strftime(cr.end_date, '%Y%m%d')" if bounded else ""
    return f"""
hist AS (
  SELECT cr.end_date, a.cid, a.ssl, a.cssm + a.cdc AS t,
         row_number() OVER (PARTITION BY cr.end_date, a.cid
                            ORDER BY a.sd DESC, a.cdc DESC, a.cssm DESC, a.cdpgmp DESC, a.ssl DESC) AS rn
  FROM crashed_ids cr JOIN agg a ON a.cid = cr.cid {bound}
),
first_crash AS (
  SELECT end_date, cid, min(rn) AS f_rn FROM hist WHERE t > 0 GROUP BY end_date, cid
),
walk AS (
  SELECT h.end_date, h.cid, f.f_rn,
         max(CASE WHEN h.rn = f.f_rn THEN h.t END) AS f_t,
         min(CASE WHEN h.t > 0 AND h.rn > f.f_rn THEN h.rn END) AS n_rn
  FROM hist h JOIN first_crash f USING (end_date, cid)
  GROUP BY h.end_date, h.cid, f.f_rn
),
gap AS (
  SELECT w.end_date, w.cid, w.f_t, w.n_rn,
         sum(CASE WHEN h.rn >= w.f_rn AND h.rn < w.n_rn THEN h.ssl ELSE 0 END) AS s
  FROM walk w JOIN hist h USING (end_date, cid)
  GROUP BY w.end_date, w.cid, w.f_t, w.n_rn
),
stats AS (
  SELECT end_date, cid,
         (f_t > 1 OR n_rn IS NOT NULL) AS has_multiple_crashes,
         CASE WHEN f_t > 1 THEN 0.0 WHEN n_rn IS NOT NULL THEN s / 60 / 60 END AS hours
  FROM gap
)
"""


HISTORY = """
hist_cnt AS (
  SELECT end_date,
         CAST(count(*) FILTER (WHERE NOT has_multiple_crashes) AS BIGINT) AS first_time_crashers,
         CAST(count(*) FILTER (WHERE has_multiple_crashes) AS BIGINT) AS repeat_crashers,
         median(hours) AS median_hours_between_crashes,
         exp(avg(ln(hours + 1))) - 1 AS geom_hours_between_crashes
  FROM stats GROUP BY end_date
)
"""

COHORT = """
members AS (
  SELECT DISTINCT c.end_date, a.cid
  FROM cal c JOIN agg a ON a.pcd BETWEEN c.end_int - 6 - 14 AND c.end_int - 14
),
prof AS (SELECT cid, min(pcd) AS pcd FROM agg GROUP BY cid),
outcome AS (
  SELECT p.cid, p.pcd,
         coalesce(sum(a.cssm + a.cdc) FILTER (WHERE a.sd <= strftime(DATE '1970-01-01' + p.pcd + 13, '%Y%m%d')), 0) AS tot,
         min(a.sd) FILTER (WHERE a.sd <= strftime(DATE '1970-01-01' + p.pcd + 13, '%Y%m%d') AND a.cssm + a.cdc > 0) AS first_sd
  FROM prof p JOIN agg a USING (cid) GROUP BY p.cid, p.pcd
),
cohort_rows AS (
  SELECT m.end_date, m.cid,
         CASE WHEN o.tot >= 1 THEN 1 ELSE 0 END AS crash_group,
         o.first_sd IS NOT NULL AS has_crashed,
         coalesce(CAST(strptime(o.first_sd, '%Y%m%d') AS DATE) >= DATE '1970-01-01' + o.pcd + 7, false) AS crashed_second_week,
         CAST(date_diff('day', DATE '1970-01-01' + o.pcd, CAST(strptime(o.first_sd, '%Y%m%d') AS DATE)) AS INTEGER) AS days_to_first_crash
  FROM members m JOIN outcome o USING (cid)
),
cohort_cnt AS (
  SELECT end_date,
         CAST(count(*) AS BIGINT) AS cohort_profiles,
         CAST(count(*) FILTER (WHERE crash_group = 1) AS BIGINT) AS cohort_crashed,
         CAST(count(*) FILTER (WHERE has_crashed AND crashed_second_week) AS BIGINT) AS cohort_crashed_second_week
  FROM cohort_rows GROUP BY end_date
),
days AS (
  SELECT end_date,
         CAST(count(days_to_first_crash) AS BIGINT) AS days_count,
         avg(days_to_first_crash) AS days_mean,
         stddev_samp(days_to_first_crash) AS days_std,
         min(days_to_first_crash) AS days_min,
         max(days_to_first_crash) AS days_max,
         quantile_cont(days_to_first_crash, 0.1) AS days_p10,
         quantile_cont(days_to_first_crash, 0.25) AS days_p25,
         quantile_cont(days_to_first_crash, 0.5) AS days_p50,
         quantile_cont(days_to_first_crash, 0.75) AS days_p75,
         quantile_cont(days_to_first_crash, 0.9) AS days_p90
  FROM cohort_rows WHERE has_crashed AND days_to_first_crash >= 0 GROUP BY end_date
),
days_all AS (
  SELECT c.end_date, CAST(coalesce(d.days_count, 0) AS BIGINT) AS days_count, d.days_mean, d.days_std,
         d.days_min, d.days_max, d.days_p10, d.days_p25, d.days_p50, d.days_p75, d.days_p90
  FROM (SELECT DISTINCT end_date FROM cohort_rows) c LEFT JOIN days d USING (end_date)
)
"""

ALL_METRICS = [A2_A4, A3, A5, A6, A7, A8, J1, _walk(True), HISTORY, COHORT]

METRICS_JOIN = """
metrics AS (
  SELECT * FROM weeks
  JOIN wau_cnt USING (end_date) JOIN crashed_cnt USING (end_date) JOIN new_cnt USING (end_date)
  JOIN e10s_cnt USING (end_date) JOIN rates USING (end_date) JOIN rates_e10s USING (end_date)
  LEFT JOIN hist_cnt USING (end_date) LEFT JOIN cohort_cnt USING (end_date) LEFT JOIN days_all USING (end_date)
)
"""

SUMMARY = f"""
summary AS (
  SELECT end_date, strftime(end_date, '%Y-%m-%d') AS date,
    crashed_1 / NULLIF(wau, 0) AS proportion_wau_crashes_1,
    crashed_2 / NULLIF(wau, 0) AS proportion_wau_crashes_2,
    new_crashed_1 / NULLIF(new_profiles, 0) AS proportion_new_crashes_1,
    new_crashed_2 / NULLIF(new_profiles, 0) AS proportion_new_crashes_2,
    new_profiles / NULLIF(wau, 0) AS proportion_new_profiles,
    coalesce(first_time_crashers, 0) / NULLIF(crashed_1, 0) AS proportion_first_time_crashes,
    coalesce(repeat_crashers, 0) / NULLIF(crashed_1, 0) AS proportion_multiple_crashes,
    e10s_enabled / NULLIF(crashed_1, 0) AS proportion_e10s_enabled,
    e10s_disabled / NULLIF(crashed_1, 0) AS proportion_e10s_disabled,
    crash_rate_main_avg_by_user, crash_rate_content_avg_by_user, crash_rate_plugin_avg_by_user,
    crash_rate_main_avg_by_user_and_e10s_enabled, crash_rate_content_avg_by_user_and_e10s_enabled,
    crash_rate_plugin_avg_by_user_and_e10s_enabled, crash_rate_main_avg_by_user_and_e10s_disabled,
    crash_rate_content_avg_by_user_and_e10s_disabled, crash_rate_plugin_avg_by_user_and_e10s_disabled,
    median_hours_between_crashes, geom_hours_between_crashes,
    cohort_crashed / NULLIF(cohort_profiles, 0) AS proportion_new_crashes_bis,
    cohort_crashed_second_week / NULLIF(cohort_profiles, 0) AS proportion_new_crashes_bis_second_week
  FROM metrics
)
"""

SUMMARY_KEYS = [
    "proportion_wau_crashes_1", "proportion_wau_crashes_2", "proportion_new_crashes_1", "proportion_new_crashes_2",
    "proportion_new_profiles", "proportion_first_time_crashes", "proportion_multiple_crashes",
    "proportion_e10s_enabled", "proportion_e10s_disabled",
    "crash_rate_main_avg_by_user", "crash_rate_content_avg_by_user", "crash_rate_plugin_avg_by_user",
    "crash_rate_main_avg_by_user_and_e10s_enabled", "crash_rate_content_avg_by_user_and_e10s_enabled",
    "crash_rate_plugin_avg_by_user_and_e10s_enabled", "crash_rate_main_avg_by_user_and_e10s_disabled",
    "crash_rate_content_avg_by_user_and_e10s_disabled", "crash_rate_plugin_avg_by_user_and_e10s_disabled",
    "median_hours_between_crashes", "geom_hours_between_crashes",
    "proportion_new_crashes_bis", "proportion_new_crashes_bis_second_week",
]

# chart id, legend, summary column, shown as percentage
SERIES = [
    ("crash-rates", "crash_rate_main", "crash_rate_main_avg_by_user", False),
    ("crash-rates", "crash_rate_content", "crash_rate_content_avg_by_user", False),
    ("crash-rates", "crash_rate_plugin", "crash_rate_plugin_avg_by_user", False),
    ("percentage-crashed", "wau_crashes", "proportion_wau_crashes_1", True),
    ("percentage-crashed", "wau_2+_crashes", "proportion_wau_crashes_2", True),
    ("first-crashes", "first_time_crashes", "proportion_first_time_crashes", True),
    ("first-crashes", "multiple_crashes", "proportion_multiple_crashes", True),
    ("e10s", "e10s_enabled", "proportion_e10s_enabled", True),
    ("e10s", "e10s_disabled", "proportion_e10s_disabled", True),
    ("crash-rates-e10s", "crash_rate_content_e10s_enabled", "crash_rate_content_avg_by_user_and_e10s_enabled", False),
    ("crash-rates-e10s", "crash_rate_content_e10s_disabled", "crash_rate_content_avg_by_user_and_e10s_disabled", False),
    ("new-profiles", "new_profiles", "proportion_new_profiles", True),
    ("percentage-new-crashed", "percentage_new_crashes", "proportion_new_crashes_1", True),
    ("percentage-new-crashed", "percentage_new_2+_crashes", "proportion_new_crashes_2", True),
    ("percentage-new-crashed-bis", "percentage_new_crashes_bis", "proportion_new_crashes_bis", True),
    ("hours_between_crashes", "median_hours_between_crashes", "median_hours_between_crashes", False),
    ("hours_between_crashes", "geom_mean_hours_between_crashes", "geom_hours_between_crashes", False),
]


def _summary_sql() -> str:
    return _with(*ALL_METRICS, METRICS_JOIN, SUMMARY)


def _console_lines() -> list[str]:
    """Each line of the console report as a text expression over the metrics."""

    def est(c):
        return f"format('{{:,}}', CAST(coalesce({c}, 0) * 100 AS BIGINT))"

    def two(x):  # two decimals, half up on the shortest decimal form
        return f"coalesce(CAST(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DECIMAL(30, 2)) AS VARCHAR), 'n/a')"

    def pct(a, b):
        return f"CASE WHEN {a} IS NULL OR coalesce({b}, 0) = 0 THEN 'n/a' ELSE {two(f'CAST({a} AS DOUBLE) / {b} * 100')} || '%' END"

    def share(title, a, b, of):
        return f"'{title}: ' || {est(a)} || ' (' || {pct(a, b)} || '{of})'"

    lines = [f"'Active profiles: ' || {est('wau')}"]
    lines += [share(f"Profiles with {n}+ crashes", f"crashed_{n}", "wau", " of active") for n in (1, 2)]
    lines.append(share("New profiles", "new_profiles", "wau", " of active"))
    lines += [share(f"New profiles with {n}+ crashes", f"new_crashed_{n}", "new_profiles", " of new") for n in (1, 2)]
    lines.append(share("First crash on record", "first_time_crashers", "crashed_1", " of crashed"))
    lines.append(share("Crashed before", "repeat_crashers", "crashed_1", " of crashed"))
    lines.append(f"'Cohort created two weeks earlier: ' || {est('cohort_profiles')}")
    lines.append(share("Cohort crashed within two weeks", "cohort_crashed", "cohort_profiles", ""))
    week2 = "cohort_crashed_second_week"
    lines.append(f"'Cohort first crash in week two: ' || {est(week2)} || ' (' || {pct(week2, 'cohort_profiles')} || ' of cohort, ' || "
                 f"{pct(week2, 'cohort_crashed')} || ' of those that crashed)'")
    lines.append(f"'Days to first crash: mean ' || {two('days_mean')} || ', median ' || {two('days_p50')} || ', p90 ' || {two('days_p90')}")
    lines += [share(f"e10s {s} among crashed", f"e10s_{s}", "crashed_1", "") for s in ("enabled", "disabled")]
    kinds = ("main", "content", "plugin")
    lines += [f"'{k.capitalize()} crashes per 1000 hours: ' || {two(f'crash_rate_{k}_avg_by_user')}" for k in kinds]
    lines += [f"'{k.capitalize()} crashes per 1000 hours, e10s {s}: ' || {two(f'crash_rate_{k}_avg_by_user_and_e10s_{s}')}"
              for s in ("enabled", "disabled") for k in kinds]
    return lines


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_pings"] = _with() + "\nSELECT cid, sid, channel, sd, appname, ssl, cssm, cdc, sk, cdgmp, cdp, pcd, e10s FROM clean"
    q["profile_day"] = _with() + "\nSELECT cid, sd, e10s, pcd, ssl, cssm, cdc, cdpgmp FROM agg"
    q["report_weeks"] = _with() + """
SELECT end_date, CAST(end_date - 6 AS DATE) AS start_date, strftime(end_date, '%Y-%m-%d') AS date,
       strftime(end_date - 6, '%Y%m%d') AS start_sd, strftime(end_date, '%Y%m%d') AS end_sd,
       CAST(isodow(end_date) - 1 AS INTEGER) AS weekday
FROM weeks"""
    q["report_week_neighbours"] = _with() + """
SELECT end_date,
       CAST(CASE WHEN isodow(end_date) = 7 THEN end_date - 2 WHEN isodow(end_date) = 1 THEN end_date - 3
            ELSE end_date - 1 END AS DATE) AS previous_report,
       CAST(CASE WHEN isodow(end_date) BETWEEN 1 AND 4 THEN end_date + 1 WHEN isodow(end_date) = 5 THEN end_date + 3
            WHEN isodow(end_date) = 6 THEN end_date + 2 ELSE end_date + 8 END AS DATE) AS next_report
FROM weeks"""
    q["last_report_date"] = _with() + "\nSELECT max(end_date) AS last_report_date FROM weeks"
    q["weekly_active"] = _with(A2_A4) + "\nSELECT end_date, wau FROM wau_cnt"
    q["crashed_profiles"] = _with(A3) + "\nSELECT end_date, crashed_1, crashed_2 FROM crashed_cnt"
    q["new_profiles"] = _with(A2_A4) + "\nSELECT end_date, new_profiles FROM wau_cnt"
    q["new_profiles_crashed"] = _with(A5) + "\nSELECT end_date, new_crashed_1, new_crashed_2 FROM new_cnt"
    q["e10s_crashed_profiles"] = _with(A6) + "\nSELECT end_date, e10s_enabled, e10s_disabled FROM e10s_cnt"
    q["crash_rates"] = _with(A7) + f"""
SELECT end_date, {_rnd('crash_rate_main_avg_by_user')} AS crash_rate_main_avg_by_user,
       {_rnd('crash_rate_content_avg_by_user')} AS crash_rate_content_avg_by_user,
       {_rnd('crash_rate_plugin_avg_by_user')} AS crash_rate_plugin_avg_by_user
FROM rates"""
    e10s_cols = [
        f"crash_rate_{k}_avg_by_user_and_e10s_{s}" for s in ("enabled", "disabled") for k in ("main", "content", "plugin")
    ]
    q["crash_rates_by_e10s"] = _with(A8) + "\nSELECT end_date, " + ", ".join(f"{_rnd(c)} AS {c}" for c in e10s_cols) + " FROM rates_e10s"
    q["crashed_history"] = _with(J1) + """
SELECT cr.end_date, a.cid, a.sd, a.e10s, a.pcd, a.ssl, a.cssm, a.cdc, a.cdpgmp
FROM crashed_ids cr JOIN agg a USING (cid)"""
    q["cohort_history"] = _with(COHORT) + """
SELECT m.end_date, a.cid, a.sd, a.e10s, a.pcd, a.ssl, a.cssm, a.cdc, a.cdpgmp
FROM members m JOIN agg a USING (cid)"""
    q["longitudinal"] = _with(J1) + """
SELECT cid, min(pcd) AS pcd,
       string_agg(concat_ws(',', sd, cdc, cssm, cdpgmp, ssl), ';' ORDER BY sd, cdc, cssm, cdpgmp, ssl) AS history
FROM agg WHERE cid IN (SELECT cid FROM crashed_ids) GROUP BY cid"""
    q["hours_between_crashes"] = _with(J1, _walk(True)) + f"\nSELECT end_date, cid, has_multiple_crashes, {_rnd('hours')} AS hours FROM stats"
    q["hours_between_crashes_full_history"] = (
        _with(J1, _walk(False)) + f"\nSELECT end_date, cid, has_multiple_crashes, {_rnd('hours')} AS hours FROM stats"
    )
    q["first_vs_repeat"] = _with(J1, _walk(True), HISTORY) + "\nSELECT end_date, first_time_crashers, repeat_crashers FROM hist_cnt"
    q["hours_summary"] = _with(J1, _walk(True), HISTORY) + f"""
SELECT end_date, {_rnd('median_hours_between_crashes')} AS median_hours_between_crashes,
       {_rnd('geom_hours_between_crashes')} AS geom_hours_between_crashes
FROM hist_cnt"""
    hist_sql = """
SELECT end_date, CAST(ceil(hours) AS INTEGER) AS hours, CAST(count(*) AS BIGINT) AS count
FROM stats WHERE has_multiple_crashes GROUP BY end_date, CAST(ceil(hours) AS INTEGER)"""
    q["hours_histogram"] = _with(J1, _walk(True)) + hist_sql
    q["hours_histogram_view"] = _with(J1, _walk(True)) + f"\nSELECT * FROM ({hist_sql}) WHERE hours BETWEEN 0 AND 30"
    q["week_lookup"] = _with(J1, _walk(True)) + f"\nSELECT * FROM ({hist_sql}) WHERE end_date = DATE '{LAST_REPORT}'"
    q["cohort_two_week"] = _with(COHORT) + "\nSELECT end_date, cid, crash_group FROM cohort_rows"
    q["cohort_second_week"] = _with(COHORT) + (
        "\nSELECT end_date, cid, has_crashed, crashed_second_week, days_to_first_crash FROM cohort_rows"
    )
    q["cohort_counts"] = _with(COHORT) + (
        "\nSELECT end_date, cohort_profiles, cohort_crashed, cohort_crashed_second_week FROM cohort_cnt"
    )
    dcols = ["days_mean", "days_std", "days_p10", "days_p25", "days_p50", "days_p75", "days_p90"]
    q["days_to_first_crash"] = _with(COHORT) + (
        "\nSELECT end_date, days_count, days_min, days_max, "
        + ", ".join(f"{_rnd(c)} AS {c}" for c in dcols)
        + " FROM days_all"
    )
    q["weekly_summary"] = _summary_sql() + "\nSELECT date, " + ", ".join(f"{_rnd(k)} AS {k}" for k in SUMMARY_KEYS) + " FROM summary"
    est = [
        ("wau", "active_profiles"), ("new_profiles", "new_profiles"), ("first_time_crashers", "first_time_crashers"),
        ("repeat_crashers", "repeat_crashers"), ("e10s_enabled", "e10s_enabled_crashed"),
        ("e10s_disabled", "e10s_disabled_crashed"), ("cohort_profiles", "cohort_profiles"),
        ("cohort_crashed", "cohort_crashed"), ("cohort_crashed_second_week", "cohort_crashed_second_week"),
    ]
    cols = [f"CAST(coalesce({src}, 0) * 100.0 AS DOUBLE) AS {name}_estimate" for src, name in est]
    for n in (1, 2):
        cols.append(f"CAST(crashed_{n} * 100.0 AS DOUBLE) AS crashed_{n}_estimate")
        cols.append(f"CAST(new_crashed_{n} * 100.0 AS DOUBLE) AS new_crashed_{n}_estimate")
    cols += [f"{_rnd('days_mean')} AS mean_days_to_first_crash", f"{_rnd('days_p50')} AS median_days_to_first_crash",
             f"{_rnd('days_p90')} AS p90_days_to_first_crash",
             "format('{:,}', CAST(wau * 100 AS BIGINT)) AS active_profiles_text"]
    q["population_estimates"] = _with(*ALL_METRICS, METRICS_JOIN) + "\nSELECT end_date, " + ", ".join(cols) + " FROM metrics"
    parts = [
        f"SELECT date, '{chart}' AS chart, '{legend}' AS series, {_rnd(col)} AS value, {str(pct).lower()} AS percentage FROM summary"
        for chart, legend, col, pct in SERIES
    ]
    q["summary_series"] = _summary_sql() + "\n" + "\nUNION ALL\n".join(parts)
    q["release_markers"] = f"""
WITH releases AS (
  SELECT CAST(DATE '2022-07-01' + CAST(event_id % 600 AS INTEGER) AS DATE) AS date,
         CASE event_id % 3 WHEN 0 THEN 'major' WHEN 1 THEN 'stability' ELSE 'dev' END AS category,
         'v' || CAST(event_id AS VARCHAR) AS version
  FROM events
)
SELECT date, version AS label, category FROM releases
WHERE date >= DATE '{LAST_REPORT}' - INTERVAL 12 MONTH AND category = 'major'
UNION ALL SELECT DATE '{SHUTDOWN_KILL_NOTE_DATE}', '{SHUTDOWN_KILL_NOTE_LABEL}', 'annotation'"""
    gaps = ", ".join(f"DATE '{d}'" for d in PUBLISHED_GAPS)
    q["pending_reports"] = _with() + f"""
SELECT end_date, CAST(end_date - 6 AS DATE) AS start_date, strftime(end_date, '%Y-%m-%d') AS date FROM weeks WHERE end_date IN ({gaps})"""
    asked = ", ".join(f"(DATE '{d}')" for d in ASKED_WEEKS)
    q["week_lookup_published"] = _with(J1, _walk(True), f"h AS ({hist_sql})", f"asked AS (SELECT * FROM (VALUES {asked}) AS v(end_date))") + """
SELECT a.end_date, CASE WHEN h.end_date IS NULL THEN 'missing' ELSE 'published' END AS status, h.hours, h.count
FROM asked a LEFT JOIN h ON h.end_date = a.end_date"""
    q["dated_histogram_latest"] = q["week_lookup"]
    q["weekly_counts_by_sweep"] = _with(A2_A4, A3, A5, A6) + """
SELECT end_date, wau, crashed_1, crashed_2, new_profiles, new_crashed_1, new_crashed_2, e10s_enabled, e10s_disabled
FROM wau_cnt JOIN crashed_cnt USING (end_date) JOIN new_cnt USING (end_date) JOIN e10s_cnt USING (end_date)"""
    q["hours_between_crashes_day_by_day"] = q["hours_between_crashes"]
    q["console_report"] = _with(*ALL_METRICS, METRICS_JOIN) + "\nSELECT end_date, l.line AS line, l.text AS text FROM (SELECT end_date, unnest([" + ", ".join(
        f"{{'line': {i}, 'text': {t}}}" for i, t in enumerate(_console_lines())) + "]) AS l FROM metrics)"
    q["profile_day_store"] = q["profile_day"]
    q["committed_summaries"], q["committed_histograms"] = q["weekly_summary"], q["hours_histogram"]
    q["clean_pings_from_drifting_files"] = q["clean_pings"]
    q["weekly_summary_store"] = q["dated_summaries"] = q["merged_array"] = q["weekly_summary"]
    q["weekly_summary_durable"] = q["publish_and_merge"] = q["weekly_summary"]
    q["hours_histogram_durable"] = q["hours_histogram"]
    q["clean_pings_from_scan"] = q["clean_pings"]
    return q
