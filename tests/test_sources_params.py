import os
import tempfile

import pytest
from pyspark.errors import AnalysisException

from pyspark.sql import functions as F

from crashlens.operators.summary import summary_columns
from crashlens.params import fixture_params
from crashlens.plans.report import build_reports
from crashlens.sources.fixtures import events_as_main_summary, fixture_pings
from crashlens.sources.pings import RAW_COLUMNS, read_raw_pings
from tests.conftest import SF001


def test_read_raw_pings_falls_back_only_on_missing_path(spark):
    root = tempfile.mkdtemp(prefix="crashlens-pings-")
    older = os.path.join(root, "v3")
    events_as_main_summary(spark.read.parquet(f"{SF001}/events.parquet")).withColumn("client_id", F.col("client_id").cast("string")).write.parquet(older)
    df = read_raw_pings(spark, [os.path.join(root, "v4"), older])
    assert df.columns == list(RAW_COLUMNS.values())
    assert df.count() == 1000
    not_parquet = os.path.join(root, "bad")
    os.makedirs(not_parquet)
    with open(os.path.join(not_parquet, "x.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        read_raw_pings(spark, [not_parquet, older]).count()
    with pytest.raises(AnalysisException):
        read_raw_pings(spark, [os.path.join(root, "nope")])


def test_extra_threshold_keys(spark):
    # Thresholds always include 1 and 2, come back sorted and are keyed by n
    p = fixture_params(crash_thresholds=(3,))
    assert p.thresholds == (1, 2, 3)
    r = build_reports(spark, fixture_pings(spark, SF001), p)
    cols = r.summary.columns
    for n in (1, 2, 3):
        assert f"proportion_wau_crashes_{n}" in cols and f"proportion_new_crashes_{n}" in cols
    assert set(summary_columns(p)) <= set(cols)
    for row in r.weekly.collect():
        assert row.crashed_3 <= row.crashed_2 <= row.crashed_1


def test_string_client_ids(spark):
    """The original's client id is a string; any hashable key works the same."""
    p = fixture_params()
    pings = fixture_pings(spark, SF001)
    as_text = pings.withColumn("cid", F.concat(F.lit("client-"), F.col("cid").cast("string")))
    a = {r.date: r for r in build_reports(spark, pings, p).summary.drop("end_date").collect()}
    b = {r.date: r for r in build_reports(spark, as_text, p).summary.drop("end_date").collect()}
    assert a.keys() == b.keys()
    for k in a:
        for f in a[k].__fields__:
            x, y = a[k][f], b[k][f]
            assert x == y if not isinstance(x, float) else x == pytest.approx(y, rel=1e-12), (k, f)
