"""Published weekly summaries and hour histograms.

The original wrote one small JSON file per report and table, shelled out to
merge them and copied files to object storage. Here the outputs are two
JSON tables partitioned by ``end_date`` written straight to their final
location (local, HDFS or s3a), with dynamic partition overwrite so re-running a
report replaces exactly that report. Reading back, merging and "which report was
published last" are ordinary Spark reads over the same tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from crashlens.sources.dated_files import listing

SUMMARY_DIR = "summary"
HOURS_DIR = "hours"
PUBLISH_DIGITS = 10  # the published files carry 10 decimals


def summary_schema(keys: list[str]) -> StructType:
    """Columns of a published summary, end_date last."""
    fields = [StructField("date", StringType())]
    fields += [StructField(k, DoubleType()) for k in keys if k != "date"]
    fields.append(StructField("end_date", DateType()))
    return StructType(fields)


HOURS_SCHEMA = StructType([
    StructField("hours", IntegerType()),
    StructField("count", LongType()),
    StructField("end_date", DateType()),
])


def _write(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("end_date")
        .json(path)
    )


def rounded_summary(summary: DataFrame) -> DataFrame:
    doubles = [f.name for f in summary.schema.fields if isinstance(f.dataType, DoubleType)]
    return summary.select(*[F.round(c, PUBLISH_DIGITS).alias(c) if c in doubles else F.col(c) for c in summary.columns])


def publish_summaries(summary: DataFrame, out_dir: str) -> None:
    """One JSON record per report under ``summary/end_date=YYYY-MM-DD``."""
    _write(rounded_summary(summary), f"{out_dir.rstrip('/')}/{SUMMARY_DIR}")


def publish_histograms(histogram: DataFrame, out_dir: str) -> None:
    """The hours histogram of each report, ``[{"hours": h, "count": n}, ...]``."""
    _write(histogram.select("hours", "count", "end_date"), f"{out_dir.rstrip('/')}/{HOURS_DIR}")


def read_summaries(spark: SparkSession, out_dir: str, keys: list[str]) -> DataFrame | None:
    """All published summaries as one table, oldest first (None if none)."""
    try:
        df = spark.read.schema(summary_schema(keys)).json(f"{out_dir.rstrip('/')}/{SUMMARY_DIR}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return None
        raise
    return df.orderBy("end_date")


def read_histograms(spark: SparkSession, out_dir: str) -> DataFrame | None:
    try:
        return spark.read.schema(HOURS_SCHEMA).json(f"{out_dir.rstrip('/')}/{HOURS_DIR}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return None
        raise


def published_partitions(spark: SparkSession, out_dir: str, what: str = SUMMARY_DIR) -> DataFrame:
    """end_date of the reports that a published table holds, from the folder listing alone."""
    files = listing(spark, f"{out_dir.rstrip('/')}/{what}")
    date = F.try_to_date(F.regexp_extract("path", r"/end_date=(\d{4}-\d{2}-\d{2})/[^/]*$", 1))
    return files.where("length > 0").select(date.alias("end_date")).where("end_date IS NOT NULL").distinct()


def last_published_date(spark: SparkSession, out_dir: str) -> _dt.date | None:
    """End date of the latest published report (None: start the backfill
    from the configured default)."""
    return published_partitions(spark, out_dir).agg(F.max("end_date").alias("d")).first()["d"]


def published_dates(spark: SparkSession, out_dir: str) -> set[_dt.date]:
    """End dates of the published summaries, one per report."""
    return {r["end_date"] for r in published_partitions(spark, out_dir).collect()}


def week_histogram(spark: SparkSession, out_dir: str, end_date: _dt.date) -> DataFrame | None:
    """One report's histogram (a partition-pruned read); an empty result is the
    site's "missing data" case."""
    hist = read_histograms(spark, out_dir)
    return None if hist is None else hist.filter(F.col("end_date") == F.lit(end_date))


def lookup_weeks(spark: SparkSession, out_dir: str, end_dates: Sequence[_dt.date]) -> DataFrame:
    """The published histograms of the asked weeks: end_date, status, hours, count. A week
    without a published file is one row "missing" and no data file is opened for it; of the
    table only the asked partitions are read."""
    asked = spark.createDataFrame([(d,) for d in sorted(set(end_dates))], "end_date date")
    there = published_partitions(spark, out_dir, HOURS_DIR).withColumn("there", F.lit(True))
    asked = asked.join(there, "end_date", "left")
    status = F.when(F.col("there"), "published").otherwise("missing").alias("status")
    hist = read_histograms(spark, out_dir)
    if hist is None:
        return asked.select("end_date", status, F.lit(None).cast("int").alias("hours"), F.lit(None).cast("long").alias("count"))
    return asked.join(hist.where(F.col("end_date").isin(list(end_dates))), "end_date", "left").select("end_date", status, "hours", "count")


def export_merged(summaries: DataFrame, path: str, *, as_array: bool = False) -> None:
    """S8 export: the merged table as a single JSON file, oldest first. One row per
    report, so a single writer is bounded by the number of reports.

    ``as_array=True`` writes the one-line JSON array the site reads
    (``[{"date": ...}, ...]``, nulls kept) instead of one object per line."""
    rows = summaries.drop("end_date")
    if as_array:
        cols = ["date"] + [c for c in rows.columns if c != "date"]  # date first: the array sorts by it
        merged = F.to_json(F.array_sort(F.collect_list(F.struct(*cols))), {"ignoreNullFields": "false"})
        rows.agg(merged.alias("value")).coalesce(1).write.mode("overwrite").text(path)
        return
    rows.coalesce(1).sortWithinPartitions("date").write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(path)


def export_histogram_arrays(histograms: DataFrame, path: str) -> None:
    """S7 in the site's layout: per report one line ``[{"hours": h, "count": n}, ...]``
    (hours ascending) under ``end_date=YYYY-MM-DD``. One aggregate per report, bounded
    by that report's distinct hour buckets."""
    arr = F.to_json(F.array_sort(F.collect_list(F.struct("hours", "count"))))
    (
        histograms.groupBy("end_date").agg(arr.alias("value"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("end_date").text(path)
    )
