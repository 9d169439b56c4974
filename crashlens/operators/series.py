"""The site's data selections, as DataFrames.

The site draws nine time-series charts from the merged weekly summaries, marks
releases of the last year on them and adds one fixed annotation. Drawing is not
rebuilt; the selections are: a long (date, chart, series, value) table and a
marker table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.params import RELEASE_LOOKBACK_MONTHS

# Chart id, legend, summary column, drawn as a percentage.
CHART_SERIES = [
    ("crash-rates", "crash_rate_main", "crash_rate_main_avg_by_user", False),
    ("crash-rates", "crash_rate_content", "crash_rate_content_avg_by_user", False),
    ("crash-rates", "crash_rate_plugin", "crash_rate_plugin_avg_by_user", False),
    ("percentage-crashed", "wau_crashes", "proportion_wau_crashes_1", True),
    ("percentage-crashed", "wau_2+_crashes", "proportion_wau_crashes_2", True),
    ("first-crashes", "first_time_crashes", "proportion_first_time_crashes", True),
    ("first-crashes", "multiple_crashes", "proportion_multiple_crashes", True),
    ("e10s", "e10s_enabled", "proportion_e10s_enabled", True),
    ("e10s", "e10s_disabled", "proportion_e10s_disabled", True),
    ("crash-rates-e10s", "crash_rate_{kind}_e10s_enabled", "crash_rate_{kind}_avg_by_user_and_e10s_enabled", False),
    ("crash-rates-e10s", "crash_rate_{kind}_e10s_disabled", "crash_rate_{kind}_avg_by_user_and_e10s_disabled", False),
    ("new-profiles", "new_profiles", "proportion_new_profiles", True),
    ("percentage-new-crashed", "percentage_new_crashes", "proportion_new_crashes_1", True),
    ("percentage-new-crashed", "percentage_new_2+_crashes", "proportion_new_crashes_2", True),
    ("percentage-new-crashed-bis", "percentage_new_crashes_bis", "proportion_new_crashes_bis", True),
    ("hours_between_crashes", "median_hours_between_crashes", "median_hours_between_crashes", False),
    ("hours_between_crashes", "geom_mean_hours_between_crashes", "geom_hours_between_crashes", False),
]

# The annotation the site adds to every marker set.
SHUTDOWN_KILL_NOTE_DATE = _dt.date(2017, 3, 7)
SHUTDOWN_KILL_NOTE_LABEL = "Shutdown kills removed (click me)"
MARKER_CATEGORIES = ("major", "stability", "dev")


def summary_series(summary: DataFrame, e10s_kind: str = "content") -> DataFrame:
    """One row per (date, chart, series) with the plotted value.

    ``e10s_kind`` (main | content | plugin) picks the e10s chart's crash type, as the
    site's toggle does. A single explode of an array of structs: no union, one pass.
    """
    rows = [
        F.struct(
            F.lit(chart).alias("chart"),
            F.lit(legend.format(kind=e10s_kind)).alias("series"),
            F.col(col.format(kind=e10s_kind)).cast("double").alias("value"),
            F.lit(pct).alias("percentage"),
        )
        for chart, legend, col, pct in CHART_SERIES
    ]
    return summary.select("date", F.explode(F.array(*rows)).alias("s")).select("date", "s.*")


def release_markers(releases: DataFrame, as_of: _dt.date, category: str = "major") -> DataFrame:
    """P23 + O6: releases of one category from the last year, plus the fixed
    annotation. ``releases`` has (date DATE, category STRING, version STRING)."""
    if category not in MARKER_CATEGORIES:
        raise ValueError(f"category must be one of {MARKER_CATEGORIES}")
    since = F.add_months(F.lit(as_of), -RELEASE_LOOKBACK_MONTHS)
    picked = releases.filter((F.col("date") >= since) & (F.col("category") == category)).select(
        "date", F.col("version").alias("label"), "category"
    )
    spark: SparkSession = releases.sparkSession
    note = spark.createDataFrame(
        [(SHUTDOWN_KILL_NOTE_DATE, SHUTDOWN_KILL_NOTE_LABEL, "annotation")], "date date, label string, category string"
    )
    return picked.unionByName(note)
