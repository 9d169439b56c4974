"""Test fixture: a deterministic mapping of the ``events`` table to raw pings.

The mapping (documented in FIXTURES.md) produces off-sample / off-channel /
off-app rows, NULL, negative and over-long sessions, zero-usage rows, NULL
counters, negative content crashes, out-of-range creation dates, NULL e10s and
both e10s states on one day, so every cleaning rule and edge case is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.sources.pings import select_ping_columns

# The fixture mapping, one SQL expression per main_summary column.
_MAPPING = {
    "client_id": "user_id",
    "sample_id": "CASE WHEN user_id % 10 = 9 THEN '7' ELSE '42' END",
    "normalized_channel": "CASE WHEN event_id % 23 = 0 THEN 'beta' ELSE 'release' END",
    "submission_date_s3": "date_format(ts, 'yyyyMMdd')",
    "app_name": "CASE WHEN event_id % 29 = 0 THEN 'Fennec' ELSE 'Firefox' END",
    "subsession_length": (
        "CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN -1 "
        "WHEN event_id % 31 = 0 OR user_id % 60 = 13 THEN 0 "
        "ELSE CAST(floor(value * 300) AS BIGINT) END"
    ),
    "crash_submit_success_main": (
        "CAST(CASE WHEN event_id % 19 = 0 THEN NULL "
        "WHEN event_type = 'error' AND event_id % 9 = 0 THEN 1 ELSE 0 END AS BIGINT)"
    ),
    "crashes_detected_content": (
        "CAST(CASE WHEN event_id % 17 = 0 THEN NULL "
        "WHEN event_type = 'error' AND event_id % 8 = 1 THEN 1 ELSE 0 END AS BIGINT)"
    ),
    "shutdown_kill": "CAST(CASE WHEN event_id % 11 = 3 AND event_type = 'view' THEN 1 ELSE 0 END AS BIGINT)",
    "crashes_detected_gmplugin": "CAST(CASE WHEN event_type = 'click' AND event_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT)",
    "crashes_detected_plugin": "CAST(CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 2 ELSE 0 END AS BIGINT)",
    "profile_creation_date": (
        "CAST(CASE WHEN user_id % 50 = 7 THEN 14000 WHEN user_id % 50 = 8 THEN 20000 "
        "ELSE 19718 + user_id % 30 END AS INT)"
    ),
    "e10s_enabled": "CASE WHEN event_id % 43 = 0 THEN NULL ELSE (user_id + hour(ts) div 12) % 2 = 0 END",
}


def events_as_main_summary(events: DataFrame) -> DataFrame:
    """events -> a main_summary-shaped table (source column names)."""
    return events.selectExpr(*[f"{expr} AS {name}" for name, expr in _MAPPING.items()])


def write_drifting_fixture(spark: SparkSession, sf_dir: str, where: str) -> None:
    """The fixture in the files of three writers: as it is; session lengths as text and e10s as
    a number; without the gmplugin counter, for pings that have none of it."""
    pings = events_as_main_summary(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))
    old = F.xxhash64(*pings.columns) % 2 == 0
    no_counter = ~old & (F.col("crashes_detected_gmplugin") == 0)
    typed = pings.where(old).withColumns({"subsession_length": F.col("subsession_length").cast("string"),
                                          "e10s_enabled": F.col("e10s_enabled").cast("int"), "shutdown_kill": F.col("shutdown_kill").cast("double")})
    for part in (pings.where(~old & ~no_counter), typed, pings.where(no_counter).drop("crashes_detected_gmplugin")):
        part.repartition("submission_date_s3").write.mode("append").partitionBy("submission_date_s3", "sample_id").parquet(where)


def fixture_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pings (short column names) of the fixture at ``sf_dir``."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return select_ping_columns(events_as_main_summary(events))


def fixture_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release table (date, category, version) with a row for each event (FIXTURES.md)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").selectExpr(
        "date_add(DATE '2022-07-01', CAST(event_id % 600 AS INT)) AS date",
        "CASE event_id % 3 WHEN 0 THEN 'major' WHEN 1 THEN 'stability' ELSE 'dev' END AS category",
        "concat('v', CAST(event_id AS STRING)) AS version",
    )
