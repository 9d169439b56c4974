"""Incremental reporting over a growing folder of ping files (Structured Streaming).

The report itself is a batch computation over every profile's whole history, so
the stream does not hold report state. Instead:

* the file source tracks which ping files were already consumed (its checkpoint);
* each micro-batch is cleaned and rolled up to *partial* profile-day rows, which
  are written under ``partials/query=<id>/batch=<id>`` (overwrite, so a retried batch
  replaces its own output: idempotent; the query's id lives in the checkpoint, so if the
  checkpoint is lost the files are read anew into a folder of their own and none counts
  twice). Rows stay apart by creation day: its ceiling moves with the day of the report;
* once the stream has consumed everything available, the batches that came in since the last
  run are folded into the profile-day store (plans/history_store.py): only the months they
  touch are rewritten, and a batch is never read again; then every pending report is published.

Run from a daily scheduler: the available-now trigger consumes what arrived since
the last run and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import partial_profile_day
from crashlens.params import ReportParams
from crashlens.plans.history_store import open_store
from crashlens.plans.job import JobResult, publish_pending_reports
from crashlens.sources.dated_files import LISTING
from crashlens.sources.pings import select_ping_columns

PARTIALS = "partials"


def run_incremental_reports(spark: SparkSession, ping_dir: str, ping_schema: StructType, state_dir: str,
                            out_dir: str, params: ReportParams, *, buckets: int | None = None,
                            max_files_per_trigger: int | None = None) -> JobResult:
    """Consume the ping files that arrived since the last run, then publish every
    report that became due. ``ping_schema`` is the source table's schema (source
    column names); ``state_dir`` holds the stream checkpoint and the partial rollups.

    Publishing runs once, after the stream has consumed everything available, so the
    result does not depend on how the stream splits the new files into micro-batches.
    """
    state_dir = state_dir.rstrip("/")
    partials_dir = f"{state_dir}/{PARTIALS}"

    def write_partials(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        pd = partial_profile_day(clean_pings(select_ping_columns(batch), params, created_by_today=False))
        pd.write.mode("overwrite").parquet(f"{partials_dir}/query={query_id}/batch={batch_id}")

    reader = spark.readStream.schema(ping_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query: StreamingQuery = (
        reader.parquet(ping_dir).writeStream.foreachBatch(write_partials)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    store = open_store(spark, f"{state_dir}/store/query={query.id}", cid_type=ping_schema["client_id"].dataType.simpleString(), buckets=buckets)
    try:
        new = store.new_files(f"{partials_dir}/query={query.id}").collect()
        if new:
            store.fold_in(spark.read.parquet(*[r["path"] for r in new]), spark.createDataFrame(new, LISTING))
        return publish_pending_reports(spark, store.profile_days(params), out_dir, params, stored=True)
    finally:
        store.close()
