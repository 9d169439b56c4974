"""Crash and rate expressions shared by the metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_crashes(cssm: str = "cssm", cdc: str = "cdc") -> Column:
    """Main + content crashes of a profile-day row (plugin crashes never count)."""
    return F.col(cssm) + F.col(cdc)


def is_crash_row(cssm: str = "cssm", cdc: str = "cdc") -> Column:
    return product_crashes(cssm, cdc) > 0


def hours(seconds: Column) -> Column:
    """seconds -> hours, as ``/ 60 / 60`` on doubles."""
    return seconds / 60 / 60


def per_hour(count: Column, seconds: Column) -> Column:
    """Crashes per hour of use; NULL when there is no use (D2: never a division error)."""
    return F.try_divide(count, hours(seconds))
