"""Date helpers as Spark column expressions.

Submission dates arrive as ``yyyyMMdd`` text and profile creation dates as days
since 1970-01-01; inside the library both become DATE / int arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_TEXT = "yyyyMMdd"
ISO_TEXT = "yyyy-MM-dd"


def int_to_date(n: Column | str) -> Column:
    """days since 1970-01-01 -> DATE."""
    return F.date_from_unix_date(F.col(n) if isinstance(n, str) else n)


def date_to_int(d: Column | str) -> Column:
    """DATE -> days since 1970-01-01."""
    return F.unix_date(F.col(d) if isinstance(d, str) else d)


def text_to_date(s: Column | str, fmt: str = DAY_TEXT) -> Column:
    """text -> DATE (NULL when the text does not parse)."""
    return F.try_to_date(F.col(s) if isinstance(s, str) else s, fmt)


def date_to_text(d: Column | str, fmt: str = DAY_TEXT) -> Column:
    """DATE -> text (``yyyyMMdd`` by default, ``yyyy-MM-dd`` for report keys)."""
    return F.date_format(F.col(d) if isinstance(d, str) else d, fmt)


def iso_text(d: Column | str) -> Column:
    """F8: ISO date text used as the report key."""
    return date_to_text(d, ISO_TEXT)


def weekday(d: Column | str) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(F.col(d) if isinstance(d, str) else d)


def file_date(path_col: Column, stem: str) -> Column:
    """the end date of a published file ``<stem>-yyyyMMdd-yyyyMMdd.json``."""
    pattern = stem + r"-\d{8}-(\d{8})\.json$"
    return F.try_to_date(F.regexp_extract(path_col, pattern, 1), DAY_TEXT)


def file_start(path_col: Column, stem: str) -> Column:
    """the start date of a published file."""
    return F.try_to_date(F.regexp_extract(path_col, stem + r"-(\d{8})-\d{8}\.json$", 1), DAY_TEXT)
