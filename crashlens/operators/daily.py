"""A1: roll pings up to one row per (profile, submission day, e10s state)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROFILE_DAY_COLUMNS = ("cid", "sd", "day", "e10s", "pcd", "ssl", "cssm", "cdc", "cdpgmp")


def profile_day(clean: DataFrame) -> DataFrame:
    """Sum session seconds and crashes per (cid, sd, e10s).

    * content crashes are net of shutdown kills (``cdc - sk``, may be negative);
    * plugin crashes combine GMP and NPAPI plugins (``cdgmp + cdp``);
    * ``pcd`` is ``min`` rather than an order-dependent ``first`` (D5).

    Partial (map-side) aggregation runs before the shuffle on the group key, so a
    client with a huge number of pings is combined inside each scan task first.
    ``day`` is the submission date as a DATE for window arithmetic.
    """
    return (
        clean.groupBy("cid", "sd", "e10s")
        .agg(
            F.min("pcd").alias("pcd"),
            F.sum("ssl").alias("ssl"),
            F.sum("cssm").alias("cssm"),
            F.sum(F.col("cdc") - F.col("sk")).alias("cdc"),
            F.sum(F.col("cdgmp") + F.col("cdp")).alias("cdpgmp"),
        )
        .withColumn("day", F.try_to_date("sd", "yyyyMMdd"))
        .select(*PROFILE_DAY_COLUMNS)
    )


def partial_profile_day(clean: DataFrame) -> DataFrame:
    """A1 kept apart by creation day, so that the ceiling on it (P8: not after the day of
    the report) can be applied when reporting, not when the pings came in."""
    return (
        clean.groupBy("cid", "sd", "e10s", "pcd")
        .agg(
            F.sum("ssl").alias("ssl"),
            F.sum("cssm").alias("cssm"),
            F.sum(F.col("cdc") - F.col("sk")).alias("cdc"),
            F.sum(F.col("cdgmp") + F.col("cdp")).alias("cdpgmp"),
        )
    )


def combine_profile_days(partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Merge partial profile-day rows of the same (cid, sd, e10s), e.g. rollups of
    separately arriving ping batches. Sums and min are associative, so rolling up
    each batch and combining equals rolling up everything at once. ``by`` names columns
    that follow from the day (its month) and are kept, so that filters on them go through."""
    return (
        partials.groupBy("cid", "sd", "e10s", *by)
        .agg(
            F.min("pcd").alias("pcd"),
            F.sum("ssl").alias("ssl"),
            F.sum("cssm").alias("cssm"),
            F.sum("cdc").alias("cdc"),
            F.sum("cdpgmp").alias("cdpgmp"),
        )
        .withColumn("day", F.try_to_date("sd", "yyyyMMdd"))
        .select(*PROFILE_DAY_COLUMNS, *by)
    )
