"""Published reports in their original naming.

Each report and table is a file ``<stem>-yyyyMMdd-yyyyMMdd.json`` (first and last day of its
week) that holds one JSON array on one line. The folder's listing is a table; the dates come
from the names, so the latest report or those of a span are picked before a file is opened.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crashlens.functions.dates import date_to_text, file_date, file_start
from crashlens.plans.storage import drop_files

LISTING = "path string, length long, modified timestamp"


def listing(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """path, length, modified of the files below ``folder``, from its listing alone; no rows
    without the folder."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], LISTING)
        raise
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def dated_files(spark: SparkSession, folder: str, stem: str) -> DataFrame:
    """path, start_date, end_date of the files of one table."""
    named = listing(spark, folder, f"{stem}-*.json").select(
        "path", file_start(F.col("path"), stem).alias("start_date"), file_date(F.col("path"), stem).alias("end_date"))
    return named.where("start_date IS NOT NULL AND end_date IS NOT NULL")


def last_dated(spark: SparkSession, folder: str, stem: str) -> _dt.date | None:
    """The end date of the latest file, None without any."""
    return dated_files(spark, folder, stem).agg(F.max("end_date")).first()[0]


def read_dated(spark: SparkSession, folder: str, stem: str, schema: StructType, *, first: _dt.date | None = None,
               last: _dt.date | None = None, latest: bool = False) -> DataFrame:
    """The rows of the files whose end date lies in the span (all without one), or of the
    latest of them, with ``end_date``. Other files are not opened."""
    files = dated_files(spark, folder, stem)
    if first is not None:
        files = files.where(F.col("end_date") >= F.lit(first))
    if last is not None:
        files = files.where(F.col("end_date") <= F.lit(last))
    if latest:
        files = files.join(files.agg(F.max("end_date").alias("end_date")), "end_date", "left_semi")
    paths = [r["path"] for r in files.select("path").collect()]  # one for each report
    if not paths:
        return spark.createDataFrame([], StructType(schema.fields)).withColumn("end_date", F.lit(None).cast("date"))
    return spark.read.schema(schema).json(paths).withColumn("end_date", file_date(F.col("_metadata.file_path"), stem))


def write_dated(rows: DataFrame, folder: str, stem: str, days: int = 7) -> int:
    """Write one file for each ``end_date`` of ``rows``, an array of its rows in column order;
    files of the same week are replaced. Returns how many. A report is a row, or a bounded
    histogram; the array is built on executors, and the driver gives the files their names."""
    spark, folder = rows.sparkSession, folder.rstrip("/")
    columns = [c for c in rows.columns if c != "end_date"]
    name = F.concat(F.lit(f"{stem}-"), date_to_text(F.date_sub("end_date", days - 1)), F.lit("-"), date_to_text("end_date"), F.lit(".json"))
    array = F.to_json(F.array_sort(F.collect_list(F.struct(*columns))), {"ignoreNullFields": "false"})
    staging = f"{folder}/.staging-{uuid.uuid4().hex[:12]}"
    rows.groupBy(name.alias("file")).agg(array.alias("value")).write.partitionBy("file").text(staging)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    n = 0
    for part in fs.globStatus(Path(f"{staging}/file=*/part-*")) or []:
        target = Path(f"{folder}/{part.getPath().getParent().getName().removeprefix('file=')}")
        fs.delete(target, False)
        fs.rename(part.getPath(), target)
        n += 1
    drop_files(spark, staging)
    return n
