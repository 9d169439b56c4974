import datetime as dt

import pytest
from pyspark.sql import functions as F

from crashlens.functions.crash import hours, is_crash_row, per_hour, product_crashes
from crashlens.functions.dates import (date_to_int, date_to_text, file_date, int_to_date, iso_text, text_to_date,
                                       weekday)


def test_date_functions(spark):
    df = spark.createDataFrame([(19723, "20240101", "out/weekly-20231226-20240101.json")], "n int, s string, path string")
    r = df.select(
        int_to_date("n").alias("f1"),
        date_to_int(int_to_date("n")).alias("f2"),
        text_to_date("s").alias("f3"),
        date_to_text(text_to_date("s")).alias("f4"),
        F.date_add(text_to_date("s"), 13).alias("f5"),
        F.datediff(F.lit(dt.date(2024, 1, 15)), text_to_date("s")).alias("f6"),
        weekday(text_to_date("s")).alias("f7"),
        iso_text(text_to_date("s")).alias("f8"),
        file_date(F.col("path"), "weekly").alias("f13"),
        text_to_date(F.lit("2024-13-45")).alias("bad"),
    ).first()
    assert r.f1 == dt.date(2024, 1, 1) and r.f2 == 19723 and r.f3 == dt.date(2024, 1, 1)
    assert r.f4 == "20240101" and r.f5 == dt.date(2024, 1, 14) and r.f6 == 14
    assert r.f7 == 0 and r.f8 == "2024-01-01" and r.f13 == dt.date(2024, 1, 1) and r.bad is None


def test_crash_expressions(spark):
    df = spark.createDataFrame([(1, -1, 0, 7200), (2, 0, 3, 0)], "cssm bigint, cdc bigint, cdpgmp bigint, ssl bigint")
    rows = df.select(product_crashes().alias("c"), is_crash_row().alias("k"), hours(F.col("ssl")).alias("h"),
                     per_hour(F.col("cdpgmp"), F.col("ssl")).alias("r")).collect()
    assert (rows[0].c, rows[0].k, rows[0].h, rows[0].r) == (0, False, 2.0, 0.0)
    assert (rows[1].c, rows[1].k, rows[1].r) == (2, True, None)   # no use: NULL rate, no error (D2)
    assert rows[0].h == pytest.approx(2.0)
