"""The plans the design relies on: pushdown at the ping scan, no cid shuffle on the
durable table, month-partition pruning."""

import contextlib
import io
import os
import tempfile

from pyspark.sql import functions as F

from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import profile_day
from crashlens.params import fixture_params
from crashlens.plans.report import build_reports
from crashlens.sources.fixtures import events_as_main_summary, fixture_pings
from crashlens.sources.pings import read_raw_pings
from tests.conftest import SF001


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_ping_scan_pushdown(spark):
    root = tempfile.mkdtemp(prefix="crashlens-ms-")
    ms = events_as_main_summary(spark.read.parquet(f"{SF001}/events.parquet")).withColumn("unused", F.lit("x")).withColumn("client_id", F.col("client_id").cast("string"))
    ms.write.partitionBy("submission_date_s3", "sample_id").parquet(os.path.join(root, "ms"))
    plan = _plan(profile_day(clean_pings(read_raw_pings(spark, os.path.join(root, "ms")), fixture_params())))
    assert "PartitionFilters: [isnotnull(sample_id" in plan and "(sample_id#" in plan
    assert "EqualTo(normalized_channel,release)" in plan
    assert "LessThanOrEqual(subsession_length,86400)" in plan
    assert "unused" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_durable_plans_shuffle_free_on_cid(spark):
    r = build_reports(spark, fixture_pings(spark, SF001), fixture_params(), durable=True, buckets=4)
    try:
        weekly = _plan(r.weekly)
        assert "Bucketed: true" in weekly and "PartitionFilters: [isnotnull(month" in weekly
        # the only exchange is the per-report one
        assert weekly.count("Exchange hashpartitioning") + weekly.count("Exchange (") <= 2
        assert "hashpartitioning(cid" not in weekly
        from crashlens.operators.history import crash_stats

        gaps = _plan(crash_stats(r.profile_day, r.win, prepartitioned=True))
        tree = gaps.split("== Physical Plan ==")[1].split("\n\n")[0]
        # no shuffle at all: the candidate profiles (counted, small) are broadcast
        assert "Exchange" not in tree.replace("BroadcastExchange", "")
        assert "BroadcastHashJoin LeftSemi" in tree
    finally:
        r.release()


def test_no_python_in_report_plans(spark):
    """Everything stays JVM-side: no Python UDF evaluation anywhere in the report plans."""
    r = build_reports(spark, fixture_pings(spark, SF001), fixture_params())
    for df in (r.summary, r.histogram, r.cohort_members, r.population, r.console):
        plan = _plan(df)
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow"):
            assert marker not in plan
