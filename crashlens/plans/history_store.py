"""S3: a profile-day table that grows with the pings and is never rolled up twice.

The store is a folder with

* ``profile_day``: partial profile-day rows (one per profile, day, e10s state and creation
  day), partitioned by month and bucketed by cid, as every later step wants them;
* ``consumed/run=N``: the ping files that run N took in (path, length, time of change);
* ``journal``: a row when a run's new months are complete in ``staging/run=N``, and one when
  they have replaced the table's.

A run lists the ping files without opening any, leaves out those consumed, rolls up the rest,
adds the stored rows of just the months they touch, and overwrites just these partitions. The
creation day is kept apart so that its ceiling, which moves with the day of the report (P8),
is applied when reading; collapsing the rows then needs no shuffle, as the table is bucketed.

A run that dies before its first journal row has changed nothing; one that dies after it is
finished from its staged months by the next ``open_store``, as often as it takes. One run at
a time may write to a store. A consumed file that changes in place is an error: its pings are
already counted.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crashlens.operators.calendar import MONTH_COL
from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import combine_profile_days, partial_profile_day
from crashlens.params import ReportParams
from crashlens.plans.storage import default_buckets, drop_files, make_folder
from crashlens.sources.dated_files import LISTING, listing
from crashlens.sources.pings import PING_SCHEMA, select_ping_columns

JOURNAL = "run long, step string, months array<string>"
PARTIAL = ("cid", "sd", "e10s", "pcd", "ssl", "cssm", "cdc", "cdpgmp")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], schema)
        raise


def merge_partials(rows: DataFrame) -> DataFrame:
    """Partial profile-day rows of equal profile, day, e10s state and creation day as one."""
    sums = [F.sum(c).alias(c) for c in PARTIAL[4:]]
    return rows.groupBy(*PARTIAL[:4], MONTH_COL).agg(*sums).select(*PARTIAL, MONTH_COL)


@dataclass(frozen=True)
class ProfileDayStore:
    spark: SparkSession
    path: str
    table: str
    buckets: int

    # --- the journal --------------------------------------------------------------------

    def _journal(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/journal", JOURNAL)

    def _note(self, run: int, step: str, months: list[str]) -> None:
        self.spark.createDataFrame([(run, step, months)], JOURNAL).coalesce(1).write.mode("append").parquet(f"{self.path}/journal")

    def last_run(self) -> int:
        """Number of the last run that took in files; 0 before the first."""
        return self._journal().agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]

    def consumed(self) -> DataFrame:
        """path, length, modified of the files of all journaled runs."""
        files = _read(self.spark, f"{self.path}/consumed", LISTING + ", run long")
        return files.join(self._journal().select("run").distinct(), "run", "left_semi").drop("run")

    def finish(self) -> None:
        """Replace the months of a run that was journaled but not seen through."""
        open_runs = self._journal().groupBy("run").agg(F.max(F.col("step") == "done").alias("done"), F.first("months").alias("months"))
        for r in open_runs.where("NOT done").orderBy("run").collect():  # one at most
            self._replace(r["run"], r["months"])

    # --- taking in ------------------------------------------------------------------------

    def stored(self) -> DataFrame:
        return self.spark.table(self.table)

    def _replace(self, run: int, months: list[str]) -> None:
        staged = self.spark.read.schema(self.stored().schema).parquet(f"{self.path}/staging/run={run}")
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            # one file for each bucket and month
            staged.repartition(self.buckets, "cid").sortWithinPartitions(MONTH_COL, "cid", "sd").write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        self._note(run, "done", months)
        for part in ("run", "delta"):
            drop_files(self.spark, f"{self.path}/staging/{part}={run}")

    def _changed(self, delta: DataFrame, months: list[str]) -> DataFrame:
        """The new rows of the months that they touch: stored ones and those of ``delta``."""
        old = self.stored().filter(F.col(MONTH_COL).isin(months)).select(*PARTIAL, MONTH_COL)
        return merge_partials(old.unionByName(delta))

    def fold_in(self, partials: DataFrame, files: DataFrame) -> list[str]:
        """Add partial profile-day rows (``operators.daily.partial_profile_day``) that come from
        ``files``; returns the months that were rebuilt."""
        run = self.last_run() + 1
        at = f"{self.path}/staging/delta={run}"
        partials.select(*PARTIAL, F.substring("sd", 1, 6).alias(MONTH_COL)).write.mode("overwrite").parquet(at)
        delta = self.spark.read.parquet(at).withColumn(MONTH_COL, F.col(MONTH_COL).cast("string"))
        months = sorted(r[0] for r in delta.select(MONTH_COL).distinct().collect())
        self._changed(delta, months).write.mode("overwrite").parquet(f"{self.path}/staging/run={run}")
        files.select("path", "length", "modified").write.mode("overwrite").parquet(f"{self.path}/consumed/run={run}")
        self._note(run, "begun", months)
        self._replace(run, months)
        return months

    def new_files(self, ping_dir: str) -> DataFrame:
        """path, length, modified of the ping files that no run has taken in. Files are listed, not read."""
        listed = listing(self.spark, ping_dir, "*.parquet")
        seen = self.consumed().select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"))
        changed = F.col("length") != F.col("old_length")
        changed |= F.col("modified") != F.col("old_modified")
        found = listed.join(seen, "path", "left")
        again = found.where(changed).select("path").limit(5).collect()
        if again:
            raise ValueError(f"consumed ping files have changed: {[r[0] for r in again]}")
        return found.where("old_length IS NULL").select("path", "length", "modified")

    def take_in(self, ping_dir: str, params: ReportParams, schema: StructType = PING_SCHEMA) -> list[str]:
        """Take in the ping files that arrived since the last run; returns the rebuilt months."""
        new = self.new_files(ping_dir).collect()  # the list that Spark's own file index would hold
        if not new:
            return []
        raw = self.spark.read.schema(schema).option("basePath", ping_dir).parquet(*[r["path"] for r in new])
        partials = partial_profile_day(clean_pings(select_ping_columns(raw), params, created_by_today=False))
        return self.fold_in(partials, self.spark.createDataFrame(new, LISTING))

    # --- reading --------------------------------------------------------------------------

    def profile_days(self, params: ReportParams) -> DataFrame:
        """A1 of everything taken in, as seen on ``params.today``: no shuffle, and filters on
        the month reach the partitions."""
        return combine_profile_days(self.stored().filter(F.col("pcd") <= params.pcd_ceiling), by=(MONTH_COL,))

    def close(self) -> None:
        """Drop the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def open_store(spark: SparkSession, path: str, *, cid_type: str = "string", buckets: int | None = None) -> ProfileDayStore:
    """The store at ``path``, made if it isn't there. The number of buckets is fixed when it is made."""
    path = path.rstrip("/")
    layout = _read(spark, f"{path}/layout", "buckets int, cid_type string").first()
    if layout is None:
        layout = {"buckets": buckets or default_buckets(spark), "cid_type": cid_type}
        spark.createDataFrame([(layout["buckets"], cid_type)], "buckets int, cid_type string").coalesce(1).write.parquet(f"{path}/layout")
    table = f"crashlens_store_{hashlib.sha1(path.encode()).hexdigest()[:12]}"
    if not spark.catalog.tableExists(table):
        make_folder(spark, f"{path}/profile_day")
        spark.sql(
            f"CREATE TABLE {table} (cid {layout['cid_type']}, sd STRING, e10s BOOLEAN, pcd INT, ssl BIGINT, cssm BIGINT, cdc BIGINT, cdpgmp BIGINT, {MONTH_COL} STRING) "
            f"USING parquet PARTITIONED BY ({MONTH_COL}) CLUSTERED BY (cid) SORTED BY (cid, sd) INTO {layout['buckets']} BUCKETS LOCATION '{path}/profile_day'")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    store = ProfileDayStore(spark, path, table, layout["buckets"])
    store.finish()
    return store
