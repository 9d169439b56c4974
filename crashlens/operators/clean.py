"""Keep the sample / channel / app of interest and drop implausible rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.params import ReportParams

COUNTERS = ("cssm", "cdc", "sk", "cdgmp", "cdp")


def clean_pings(raw: DataFrame, params: ReportParams, *, created_by_today: bool = True) -> DataFrame:
    """Filter raw pings and fill missing crash counters with 0.

    * P2-P5: sample bucket, channel, app, submission-date floor (``yyyyMMdd`` text compare,
      which is a partition filter on the real table).
    * P7 / D1: session length within [0, 86400] on the *unfilled* column, so a NULL
      session length drops the row rather than becoming 0.
    * P8: profile creation day within [2010-01-01, today] in days since 1970
      (``created_by_today=False`` leaves the upper bound to a later step).
    * P9: e10s must be true or false (NULL dropped).
    * P6: the five crash counters NULL -> 0.
    A NULL client id is dropped too: it cannot be followed over time.
    """
    return (
        raw.filter(F.col("sid") == params.sample_id)
        .filter(F.col("channel") == params.channel)
        .filter(F.col("appname") == params.app_name)
        .filter(F.col("sd") >= params.submission_floor)
        .filter(F.col("ssl").between(0, params.max_session_seconds))
        .filter((F.col("pcd") >= params.pcd_floor) & ((F.col("pcd") <= params.pcd_ceiling) if created_by_today else F.lit(True)))
        .filter(F.col("e10s").isNotNull())
        .filter(F.col("cid").isNotNull())
        .fillna(0, subset=list(COUNTERS))
    )
