"""

``entry(spark)`` runs the flagship query (the weekly summary) on sf0.001;
``queries()`` maps every registered operator to a (spark, sf_dir) -> DataFrame
callable built from the ``events`` table through the fixture mapping of
FIXTURES.md; ``oracle_sql()`` gives the DuckDB twin of each.

Doubles are rounded to 6 places in the registered outputs (and in the oracle), so
that summation order cannot flip a comparison.
"""

from __future__ import annotations

import datetime as _dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.duckdb_oracle import ASKED_WEEKS, PUBLISHED_GAPS, oracle_queries  # noqa: E402
from crashlens.operators import cohort, crash_state, history, series, sweep  # noqa: E402
from crashlens.operators.calendar import pending_reports  # noqa: E402
from crashlens.operators.clean import clean_pings  # noqa: E402
from crashlens.operators.summary import summary_columns  # noqa: E402
from crashlens.params import fixture_params  # noqa: E402
from crashlens.plans.history_store import ProfileDayStore, open_store  # noqa: E402
from crashlens.plans.job import run_report_job  # noqa: E402
from crashlens.plans.report import Reports, build_reports, reports_from_profile_day  # noqa: E402
from crashlens.plans.storage import write_intermediate  # noqa: E402
from crashlens.session import scratch_path  # noqa: E402
from crashlens.sources import commits  # noqa: E402
from crashlens.sources.dated_files import read_dated, write_dated  # noqa: E402
from crashlens.sources.drifting import read_drifting_pings  # noqa: E402
from crashlens.sources.fixtures import events_as_main_summary, fixture_pings, fixture_releases, write_drifting_fixture  # noqa: E402
from crashlens.sources.pings import PING_SCHEMA, read_raw_pings  # noqa: E402
from crashlens.sources.published import (HOURS_SCHEMA, export_merged, lookup_weeks, publish_histograms,  # noqa: E402
                                         publish_summaries, published_partitions, read_summaries, summary_schema)

SF_SMOKE = "/root/testdata/sf0.001"
DIGITS = 6


def _llm():
    """The training-data operators and pipeline, if they and what they need can be imported."""
    try:
        from crashlens.llm import oracle, queries as llm_queries

        import corpus_pipeline
    except ImportError:
        return {}, {}
    return ({**llm_queries.queries(), "pipeline": corpus_pipeline.run},
            {**oracle.oracle_sql(), **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})})


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(F.col(f.name), DIGITS).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
          for f in df.schema.fields]
    )


def _reports(spark: SparkSession, sf_dir: str) -> Reports:
    return build_reports(spark, fixture_pings(spark, sf_dir), fixture_params())


def _r(fn: Callable[[Reports], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _rounded(fn(_reports(spark, sf_dir)))


def _weekly(*cols: str) -> Callable[[SparkSession, str], DataFrame]:
    return _r(lambda r: r.weekly.select("end_date", *cols))


def _summary_cols(r: Reports) -> DataFrame:
    return r.summary.drop("end_date")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the 23-key weekly summary of every weekday report."""
    return queries()["weekly_summary"](spark, SF_SMOKE)


def _durable(spark: SparkSession, sf_dir: str) -> Reports:
    """The reports over a written profile-day table, as the job builds them."""
    return build_reports(spark, fixture_pings(spark, sf_dir), fixture_params(), durable=True)


def _published(spark: SparkSession, sf_dir: str) -> str:
    """Run the job into a fresh folder and return it."""
    out = scratch_path(spark, "published")
    run_report_job(spark, fixture_pings(spark, sf_dir), out, fixture_params())
    return out


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_summaries(spark, _published(spark, sf_dir), summary_columns(fixture_params()))


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture written out under the source's column names and read by the ping scan."""
    where = scratch_path(spark, "main_summary")
    pings = events_as_main_summary(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))
    pings.write.partitionBy("submission_date_s3", "sample_id").parquet(where)
    return read_raw_pings(spark, [where + "-older", where], _fixture_schema())


def _fixture_schema() -> StructType:
    """The ping table's schema with the fixture's numeric profile ids."""
    return StructType([StructField(f.name, LongType() if f.name == "client_id" else f.dataType) for f in PING_SCHEMA])


def _stored(spark: SparkSession, sf_dir: str) -> ProfileDayStore:
    """A store that took in the fixture in two drops of files; the second also brings a share of
    the pings of the first one's days."""
    where, schema = scratch_path(spark, "landing"), _fixture_schema()
    pings = events_as_main_summary(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))
    first = (F.col("submission_date_s3") <= "20240115") & (F.xxhash64(*pings.columns) % 5 != 0)
    store = open_store(spark, scratch_path(spark, "store"), cid_type="bigint")
    for drop in (first, ~first):
        pings.where(drop).repartition("submission_date_s3").write.mode("append").partitionBy("submission_date_s3", "sample_id").parquet(where)
        store.take_in(where, fixture_params(), schema)
    return store


def _stored_reports(spark: SparkSession, sf_dir: str) -> Reports:
    p = fixture_params()
    return reports_from_profile_day(spark, _stored(spark, sf_dir).profile_days(p), p, stored=True)


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reports(spark, sf_dir)
    counts = sweep.weekly_counts(r.profile_day, r.win, r.params, prepartitioned=True)
    return counts.withColumnsRenamed({"e10s_on_crashed": "e10s_enabled", "e10s_off_crashed": "e10s_disabled"})


def _day_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each report date is written and read again by the next, as daily runs do."""
    r = _durable(spark, sf_dir)
    keep = lambda state: write_intermediate(state, spark, "crash_state")[0]
    return crash_state.stats_day_by_day(r.profile_day, r.win, keep, prepartitioned=True).drop("seconds")


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is due after all reports but three were published."""
    r, out = _durable(spark, sf_dir), scratch_path(spark, "published")
    publish_summaries(r.summary.where(~F.col("date").isin(list(PUBLISHED_GAPS))), out)
    return pending_reports(r.profile_day, r.win, published_partitions(spark, out)).select("end_date", "start_date", "date")


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "published")
    publish_histograms(_durable(spark, sf_dir).histogram, out)
    return lookup_weeks(spark, out, [_dt.date.fromisoformat(d) for d in ASKED_WEEKS])


def _dated_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries written one file a report in the original naming, and read back."""
    where, keys = scratch_path(spark, "dated"), summary_columns(fixture_params())
    write_dated(_durable(spark, sf_dir).summary, where, "weekly")
    return read_dated(spark, where, "weekly", StructType(summary_schema(keys).fields[:-1])).drop("end_date")


def _dated_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_path(spark, "dated")
    write_dated(_durable(spark, sf_dir).histogram.select("hours", "count", "end_date"), where, "hours")
    return read_dated(spark, where, "hours", StructType(HOURS_SCHEMA.fields[:-1]), latest=True)


def _drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_path(spark, "drifting")
    write_drifting_fixture(spark, sf_dir, where)
    return read_drifting_pings(spark, where, _fixture_schema())


def _committed(spark: SparkSession, sf_dir: str) -> commits.Snapshot:
    """A first run with wrong numbers for two reports, a second one that does these again, and
    one that dies before its commit."""
    r, out = _durable(spark, sf_dir), scratch_path(spark, "committed")
    redone = F.col("end_date").isin([_dt.date.fromisoformat(d) for d in PUBLISHED_GAPS[:2]])
    spoilt = lambda c: F.when(redone, F.col(c) + 1).otherwise(F.col(c))
    bad_summary = r.summary.withColumn("proportion_new_profiles", spoilt("proportion_new_profiles"))
    bad_hours = r.histogram.withColumn("count", spoilt("count"))
    commits.publish(bad_summary, bad_hours, out)
    commits.publish(r.summary.where(redone), r.histogram.where(redone), out)
    commits.write_histograms(bad_hours, out, commits.new_version())
    return commits.snapshot(spark, out)


def _merged_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table as the single JSON array the site reads, read back."""
    where, keys = scratch_path(spark, "merged"), summary_columns(fixture_params())
    export_merged(_durable(spark, sf_dir).summary, where, as_array=True)
    return spark.read.schema(StructType(summary_schema(keys).fields[:-1])).json(f"{where}/*.txt")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query: those of the report job, and those of the training-data operators if present."""
    return {**core_queries(), **_llm()[0]}


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "clean_pings": lambda spark, d: clean_pings(fixture_pings(spark, d), fixture_params()),
        "profile_day": _r(lambda r: r.profile_day.drop("day")),
        "report_weeks": _r(lambda r: r.calendar().select("end_date", "start_date", "date", "start_sd", "end_sd", "weekday")),
        "report_week_neighbours": _r(lambda r: r.calendar().select("end_date", "previous_report", "next_report")),
        "last_report_date": lambda spark, d: _merged(spark, d).agg(F.max("end_date").alias("last_report_date")),
        "weekly_active": _weekly("wau"),
        "crashed_profiles": _weekly("crashed_1", "crashed_2"),
        "new_profiles": _weekly("new_profiles"),
        "new_profiles_crashed": _weekly("new_crashed_1", "new_crashed_2"),
        "e10s_crashed_profiles": _r(lambda r: r.weekly.select(
            "end_date", F.col("e10s_on_crashed").alias("e10s_enabled"), F.col("e10s_off_crashed").alias("e10s_disabled"))),
        "crash_rates": _r(lambda r: r.weekly.select(
            "end_date", *[(F.col(f"{k}_per_hour") * 1000).alias(f"crash_rate_{k}_avg_by_user")
                          for k in ("main", "content", "plugin")])),
        "crash_rates_by_e10s": _r(lambda r: r.weekly.select(
            "end_date",
            *[(F.col(f"{k}_per_hour_{t}") * 1000).alias(f"crash_rate_{k}_avg_by_user_and_e10s_{s}")
              for t, s in (("on", "enabled"), ("off", "disabled")) for k in ("main", "content", "plugin")])),
        "crashed_history": _r(lambda r: r.crashed_history().select(
            "end_date", "cid", "sd", "e10s", "pcd", "ssl", "cssm", "cdc", "cdpgmp")),
        "cohort_history": _r(lambda r: r.cohort_history().select(
            "end_date", "cid", "sd", "e10s", "pcd", "ssl", "cssm", "cdc", "cdpgmp")),
        "longitudinal": _r(lambda r: r.longitudinal().select(
            "cid", "pcd",
            F.concat_ws(";", F.transform("history", lambda h: F.concat_ws(
                ",", h.sd, h.cdc.cast("string"), h.cssm.cast("string"), h.cdpgmp.cast("string"), h.ssl.cast("string")
            ))).alias("history"))),
        "hours_between_crashes": _r(lambda r: r.crash_stats(bounded=True).select(
            "end_date", "cid", "has_multiple_crashes", "hours")),
        "hours_between_crashes_full_history": _r(lambda r: r.crash_stats(bounded=False).select(
            "end_date", "cid", "has_multiple_crashes", "hours")),
        "first_vs_repeat": _r(lambda r: r.history.select("end_date", "first_time_crashers", "repeat_crashers")),
        "hours_summary": _r(lambda r: r.history.select(
            "end_date", "median_hours_between_crashes", "geom_hours_between_crashes")),
        "hours_histogram": _r(lambda r: r.histogram),
        "hours_histogram_view": _r(lambda r: history.hours_histogram_view(r.histogram)),
        "week_lookup": _r(lambda r: r.histogram.filter(F.col("end_date") == F.lit(r.win.last))),
        "cohort_two_week": _r(lambda r: r.cohort_members.select("end_date", "cid", "crash_group")),
        "cohort_second_week": _r(lambda r: r.cohort_members.select(
            "end_date", "cid", "has_crashed", "crashed_second_week", "days_to_first_crash")),
        "cohort_counts": _r(lambda r: r.cohort.select(
            "end_date", "cohort_profiles", "cohort_crashed", "cohort_crashed_second_week")),
        "days_to_first_crash": _r(lambda r: r.cohort.select(
            "end_date", "days_count", "days_min", "days_max", "days_mean", "days_std",
            *cohort.DAY_PROB_NAMES)),
        "weekly_summary": _r(_summary_cols),
        "population_estimates": _r(lambda r: r.population),
        "summary_series": _r(lambda r: series.summary_series(r.summary)),
        "release_markers": lambda spark, d: series.release_markers(fixture_releases(spark, d), fixture_params().last_report),
        "weekly_summary_durable": lambda spark, d: _rounded(_summary_cols(_durable(spark, d))),
        "hours_histogram_durable": lambda spark, d: _rounded(_durable(spark, d).histogram),
        "publish_and_merge": lambda spark, d: _rounded(_merged(spark, d).drop("end_date")),
        "profile_day_store": lambda spark, d: _stored(spark, d).profile_days(fixture_params()).drop("day", "month"),
        "weekly_summary_store": lambda spark, d: _rounded(_summary_cols(_stored_reports(spark, d))),
        "weekly_counts_by_sweep": _sweep,
        "hours_between_crashes_day_by_day": lambda spark, d: _rounded(_day_by_day(spark, d)),
        "pending_reports": _pending,
        "week_lookup_published": _lookup,
        "dated_summaries": lambda spark, d: _rounded(_dated_summaries(spark, d)),
        "dated_histogram_latest": _dated_latest,
        "merged_array": lambda spark, d: _rounded(_merged_array(spark, d)),
        "clean_pings_from_drifting_files": lambda spark, d: clean_pings(_drifting(spark, d), fixture_params()),
        "committed_summaries": lambda spark, d: _rounded(_committed(spark, d).summaries(summary_columns(fixture_params())).drop("end_date")),
        "committed_histograms": lambda spark, d: _committed(spark, d).histograms(),
        "console_report": _r(lambda r: r.console),
        "clean_pings_from_scan": lambda spark, d: clean_pings(_scanned(spark, d), fixture_params()),
    }


def oracle_sql() -> dict[str, str]:
    sql = {**oracle_queries(), **_llm()[1]}
    return {k: sql[k] for k in queries() if k in sql}


__all__ = ["entry", "queries", "oracle_sql"]
