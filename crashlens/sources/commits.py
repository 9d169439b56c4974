"""S6-S9 as one commit: the summary and the histogram of a report become visible together.

A run writes both tables into folders of its own (``summary/version=<v>/end_date=<d>``, the same
for ``hours``), which nobody reads yet, and then adds one file to ``commits``: a row per report
with the version that holds it. That file appears by a rename, so a reader sees both tables of a
run or neither, and a run that dies at any step leaves only files that no row names. Redoing a
report adds a row; the latest version of each report counts, and its earlier files stay as they
are for readers that look at them, until ``expire`` drops them.

Defined cases: nothing committed gives empty tables; a report without an hour between crashes has
a summary row and no histogram rows, in the new version as well; an empty run commits nothing.
A reader takes one ``Snapshot`` and reads both tables through it.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from crashlens.plans.storage import drop_files
from crashlens.sources.dated_files import listing
from crashlens.sources.published import HOURS_DIR, HOURS_SCHEMA, SUMMARY_DIR, rounded_summary, summary_schema

COMMITS = "commits"
ROW = "end_date date, version string"


def new_version() -> str:
    """Versions sort by the time they were begun at."""
    return f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _write(df: DataFrame, out_dir: str, what: str, version: str) -> None:
    where = f"{out_dir.rstrip('/')}/{what}/version={version}"
    df.write.option("ignoreNullFields", "false").partitionBy("end_date").json(where)


def write_summaries(summary: DataFrame, out_dir: str, version: str) -> None:
    _write(rounded_summary(summary), out_dir, SUMMARY_DIR, version)


def write_histograms(histogram: DataFrame, out_dir: str, version: str) -> None:
    _write(histogram.select("hours", "count", "end_date"), out_dir, HOURS_DIR, version)


def commit(spark: SparkSession, out_dir: str, version: str, end_dates: list[_dt.date]) -> None:
    """Make a version's reports visible: a row each, in a file that appears at once."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{out_dir.rstrip('/')}/{COMMITS}"
    staged, final = Path(f"{folder}/.{version}.json"), Path(f"{folder}/{version}.json")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(folder))
    stream = fs.create(staged, True)
    try:
        stream.write(bytearray("".join(json.dumps({"end_date": d.isoformat(), "version": version}) + "\n" for d in end_dates), "utf-8"))
    finally:
        stream.close()
    if not fs.rename(staged, final):
        raise OSError(f"could not commit {version} below {folder}")


def publish(summary: DataFrame, histogram: DataFrame, out_dir: str) -> str | None:
    """Write and commit the reports of one run; the version, or None if there are none."""
    spark, version = summary.sparkSession, new_version()
    write_histograms(histogram, out_dir, version)
    write_summaries(summary, out_dir, version)
    # what was written, by the listing alone: a date per report
    files = listing(spark, f"{out_dir.rstrip('/')}/{SUMMARY_DIR}/version={version}").where("length > 0")
    date = F.to_date(F.regexp_extract("path", r"/end_date=(\d{4}-\d{2}-\d{2})/[^/]*$", 1))
    done = sorted(r["d"] for r in files.select(date.alias("d")).distinct().collect())
    if not done:
        return None
    commit(spark, out_dir, version, done)
    return version


@dataclass(frozen=True)
class Snapshot:
    """The reports that were committed when it was taken, by end date."""

    spark: SparkSession
    out_dir: str
    versions: dict[_dt.date, str]

    def _read(self, what: str, schema: StructType) -> DataFrame:
        folder = f"{self.out_dir.rstrip('/')}/{what}"
        if not self.versions:
            return self.spark.createDataFrame([], schema)
        current = [f"{v}/{d}" for d, v in self.versions.items()]  # a short text for each report
        whole = StructType([*schema.fields]).add("version", StringType())
        rows = self.spark.read.schema(whole).json(folder)
        return rows.where(F.concat_ws("/", "version", F.col("end_date").cast("string")).isin(current)).drop("version")

    def summaries(self, keys: list[str]) -> DataFrame:
        return self._read(SUMMARY_DIR, summary_schema(keys))

    def histograms(self) -> DataFrame:
        return self._read(HOURS_DIR, HOURS_SCHEMA)

    def reports(self) -> DataFrame:
        """end_date of the committed reports."""
        return self.spark.createDataFrame([(d,) for d in sorted(self.versions)], "end_date date")


def snapshot(spark: SparkSession, out_dir: str) -> Snapshot:
    folder = f"{out_dir.rstrip('/')}/{COMMITS}"
    if listing(spark, folder).isEmpty():
        return Snapshot(spark, out_dir, {})
    rows = spark.read.schema(ROW).json(folder).groupBy("end_date").agg(F.max("version").alias("version"))
    return Snapshot(spark, out_dir, {r["end_date"]: r["version"] for r in rows.collect()})


def expire(spark: SparkSession, out_dir: str) -> int:
    """Drop the versions that hold no current report and were begun before the latest commit: a
    run that goes on now is later than it. Returns how many. Readers of older snapshots lose
    their files."""
    held = set(snapshot(spark, out_dir).versions.values())
    if not held:
        return 0
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(out_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = set()
    for what in (SUMMARY_DIR, HOURS_DIR):
        for entry in fs.globStatus(Path(f"{out_dir.rstrip('/')}/{what}/version=*")) or []:
            version = entry.getPath().getName().removeprefix("version=")
            if version not in held and version < max(held):
                drop_files(spark, entry.getPath().toString())
                gone.add(version)
    return len(gone)
