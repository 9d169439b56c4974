"""The driver contract, and every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as entry_mod
from checks.compare import TABLES, _rows
from tests.conftest import SF001


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "date" and len(df.columns) == 23


def test_every_query_has_oracle():
    assert set(entry_mod.core_queries()) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(entry_mod.core_queries()))
def test_against_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF001)
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


def test_building_a_query_runs_nothing(spark):
    """Plans are built without running the query: no job but the reading of a table's schema.
    (Those that publish or write a table first do so by their nature.)"""
    writes = {"weekly_summary_durable", "hours_histogram_durable", "publish_and_merge", "clean_pings_from_scan", "last_report_date",
              "clean_pings_from_drifting_files", "committed_summaries", "committed_histograms", "profile_day_store", "weekly_summary_store",
              "hours_between_crashes_day_by_day", "pending_reports", "week_lookup_published", "dated_summaries", "dated_histogram_latest", "merged_array"}
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(entry_mod.core_queries()) - writes):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        entry_mod.core_queries()[name](spark, SF001)
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 1, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
