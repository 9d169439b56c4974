"""Profile-keyed helpers shared by the weekly, history and cohort steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def by_profile(profile_day: DataFrame, prepartitioned: bool) -> DataFrame:
    """Hash-partition on cid once, before any expansion, unless already bucketed by cid."""
    return profile_day if prepartitioned else profile_day.repartition("cid")


def profiles_with_rows(profile_day: DataFrame, where: Column, *, source: DataFrame | None = None) -> DataFrame:
    """All rows (whole history) of the profiles having at least one row matching ``where``.

    The same selection as the original's "distinct cid with ... LEFT JOIN the table
    USING (cid)" subsets (J1, J2): a semi join on the cid partitioning both sides
    share. ``source`` (default: the rows themselves) is where candidates are looked
    for, e.g. a partition-pruned slice. Spark picks the join from its own statistics.
    """
    ids = (profile_day if source is None else source).filter(where).select("cid").distinct()
    return profile_day.join(ids, "cid", "left_semi")
