"""Scan of the per-session ping table and the 13-column projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

# Source column -> short name used throughout the report.
RAW_COLUMNS = {
    "client_id": "cid",
    "sample_id": "sid",
    "normalized_channel": "channel",
    "submission_date_s3": "sd",
    "app_name": "appname",
    "subsession_length": "ssl",
    "crash_submit_success_main": "cssm",
    "crashes_detected_content": "cdc",
    "shutdown_kill": "sk",
    "crashes_detected_gmplugin": "cdgmp",
    "crashes_detected_plugin": "cdp",
    "profile_creation_date": "pcd",
    "e10s_enabled": "e10s",
}


# The columns with their types in the ping table. The two partition columns are text.
PING_SCHEMA = StructType([StructField(name, kind()) for kind, names in (
    (StringType, "client_id sample_id normalized_channel submission_date_s3 app_name"),
    (LongType, "subsession_length crash_submit_success_main crashes_detected_content shutdown_kill "
               "crashes_detected_gmplugin crashes_detected_plugin"),
    (IntegerType, "profile_creation_date"),
    (BooleanType, "e10s_enabled"),
) for name in names.split()])


def select_ping_columns(df: DataFrame) -> DataFrame:
    """Keep the 13 columns the report uses, under their short names."""
    return df.select(*[F.col(src).alias(dst) for src, dst in RAW_COLUMNS.items()])


def read_raw_pings(spark: SparkSession, paths: Sequence[str] | str, schema: StructType = PING_SCHEMA) -> DataFrame:
    """Read the ping table, trying each location in order.

    The original tried a newer dataset version and fell back to an older one on any
    error; here only a missing path moves on to the next candidate, so real read
    errors surface. The schema is given, so no file footer is read while planning, a
    column that older files lack reads as NULL, and the partition columns stay text.
    Filters applied later (sample bucket, submission date) reach the scan as partition /
    pushed filters.
    """
    if isinstance(paths, str):
        paths = [paths]
    last_err: Exception | None = None
    for path in paths:
        try:
            df = spark.read.schema(schema).parquet(path)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
                last_err = err
                continue
            raise
        return select_ping_columns(df)
    raise last_err if last_err else ValueError("no ping location given")
