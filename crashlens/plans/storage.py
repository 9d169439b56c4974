"""The durable profile-day table.

Every later step (weekly metrics, crash history, cohort, the J1/J2 self joins)
keys on the profile id. Writing the profile-day rollup once as a table bucketed
by ``cid`` under the cluster's shared checkpoint folder does three things:

* it cuts the lineage back to the raw ping scan, so a lost executor re-reads a
  few bucket files instead of re-running the scan and rollup;
* reads come back hash-partitioned on ``cid``, so aggregations, windows and
  self joins on ``cid`` run without another shuffle, in every later job;
* each file's rows are sorted by (cid, sd), which packs a profile's rows together; the
  history window still sorts, as a bucket has a file per month and more sort keys;
* it is also partitioned by month (``yyyyMM``), so a step that only needs recent days
  (the weekly metrics) prunes old partitions, while a bucketed scan over several
  months still comes back hash-partitioned on cid.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.operators.calendar import MONTH_COL, month_key

from crashlens.session import scratch_path


def default_buckets(spark: SparkSession) -> int:
    """Buckets = the larger of the shuffle-partition setting and the cluster's task
    slots, so every slot gets a bucket. Large deployments pass ``buckets`` explicitly,
    sized to about 256 MB of profile-day rows per bucket (see README)."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


def write_profile_day(profile_day: DataFrame, spark: SparkSession, *, buckets: int | None = None,
                      path: str | None = None, table: str | None = None) -> DataFrame:
    """Write ``profile_day`` bucketed by cid and return the table (a bucketed scan).

    ``repartition(buckets, cid)`` first, so each bucket is one file; without it
    every writing task would emit a file per bucket.
    """
    buckets = buckets or default_buckets(spark)
    path = path or scratch_path(spark, "profile_day")
    table = table or f"crashlens_profile_day_{uuid.uuid4().hex[:10]}"
    (
        profile_day.withColumn(MONTH_COL, month_key(F.col("day")))
        .repartition(buckets, "cid")
        .write.mode("overwrite")
        .partitionBy(MONTH_COL)
        .bucketBy(buckets, "cid")
        .sortBy("cid", "sd")
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


def write_intermediate(df: DataFrame, spark: SparkSession, name: str) -> tuple[DataFrame, str]:
    """Write a small intermediate table to the shared checkpoint folder and read it
    back: one job (a reliable ``checkpoint()`` computes its input twice unless cached),
    lineage cut, and the file survives the loss of any executor. Also returns its path."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def make_folder(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def drop_files(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table made by ``write_profile_day``, files and all, so that runs do not pile up copies."""
    where = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if where:
        drop_files(spark, where["data_type"])
