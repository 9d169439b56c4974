import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import profile_day
from crashlens.operators.summary import summary_columns
from crashlens.params import fixture_params
from crashlens.plans.history_store import ProfileDayStore, open_store
from crashlens.plans.job import run_report_job, run_stored_report_job
from crashlens.plans.report import reports_from_profile_day
from crashlens.sources.fixtures import events_as_main_summary
from crashlens.sources.pings import PING_SCHEMA, select_ping_columns
from crashlens.sources.published import read_summaries
from tests.conftest import SF01

SCHEMA = StructType([StructField(f.name, LongType() if f.name == "client_id" else f.dataType) for f in PING_SCHEMA])


@pytest.fixture(scope="module")
def pings(spark):
    """The fixture's pings, a share of them one month earlier."""
    p = events_as_main_summary(spark.read.parquet(f"{SF01}/events.parquet"))
    back = F.date_format(F.add_months(F.to_date("submission_date_s3", "yyyyMMdd"), -1), "yyyyMMdd")
    return p.withColumn("submission_date_s3", F.when(F.col("client_id") % 7 == 0, back).otherwise(F.col("submission_date_s3"))).cache()


def _drop(pings, where, landing):
    pings.filter(where).coalesce(1).write.mode("append").partitionBy("submission_date_s3", "sample_id").parquet(landing)


def _rows(df):
    return sorted(tuple(r) for r in df.select("cid", "sd", "e10s", "pcd", "ssl", "cssm", "cdc", "cdpgmp").collect())


def test_half_then_all_equals_one_run(spark, pings):
    root = tempfile.mkdtemp(prefix="crashlens-store-")
    landing, p = f"{root}/pings", fixture_params()
    late = F.xxhash64(*pings.columns) % 5 == 0  # of January, come in with the second drop
    first = (F.col("submission_date_s3") <= "20240115") & ~((F.col("submission_date_s3") >= "20240101") & late)
    store = open_store(spark, f"{root}/store", cid_type="bigint", buckets=4)
    _drop(pings, first, landing)
    assert store.take_in(landing, p, SCHEMA) == ["202312", "202401"]
    assert store.take_in(landing, p, SCHEMA) == [] and store.last_run() == 1
    _drop(pings, ~first, landing)
    store.close()
    store = open_store(spark, f"{root}/store", buckets=99)  # as a new session would; the layout stays
    assert store.buckets == 4
    assert store.take_in(landing, p, SCHEMA)[-1] == "202401"
    want = profile_day(clean_pings(select_ping_columns(pings), p))
    assert _rows(store.profile_days(p)) == _rows(want) and len(_rows(want)) > 1000
    # The ceiling of another day, without a new rollup
    early = p.with_(today=dt.date(2024, 1, 10))
    assert _rows(store.profile_days(early)) == _rows(profile_day(clean_pings(select_ping_columns(pings), early)))
    store.close()


def test_only_changed_months_are_read_and_rewritten(spark, pings):
    root = tempfile.mkdtemp(prefix="crashlens-store-")
    landing, p = f"{root}/pings", fixture_params()
    store = open_store(spark, f"{root}/store", cid_type="bigint", buckets=4)

    def files(month):
        return {r[0] for r in store.stored().filter(f"month = '{month}'").select("_metadata.file_path").distinct().collect()}

    _drop(pings, F.col("submission_date_s3") < "20240116", landing)
    store.take_in(landing, p, SCHEMA)
    december, january = files("202312"), files("202401")
    _drop(pings, F.col("submission_date_s3") >= "20240116", landing)
    delta = store.stored().filter("month = '202401'").drop("day")
    plan = store._changed(delta, ["202401"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "202401" in plan and "202312" not in plan
    assert store.take_in(landing, p, SCHEMA) == ["202401"]
    assert files("202312") == december and not files("202401") & january
    assert len(december) <= 4
    # collapsing the creation days needs no shuffle, and a month's filter reaches the partitions
    read = store.profile_days(p).filter("month = '202401'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in read and "month#" in read.split("PartitionFilters")[1].split("]")[0]
    weekly = reports_from_profile_day(spark, store.profile_days(p), p, stored=True).weekly._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cid" not in weekly
    store.close()


@pytest.mark.parametrize("dies_in", ["_note", "_replace"])
def test_a_run_that_dies_is_seen_through(spark, pings, monkeypatch, dies_in):
    root = tempfile.mkdtemp(prefix="crashlens-store-")
    landing, p = f"{root}/pings", fixture_params()
    _drop(pings, F.lit(True), landing)
    store = open_store(spark, f"{root}/store", cid_type="bigint", buckets=4)

    def dead(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ProfileDayStore, dies_in, dead)
        with pytest.raises(RuntimeError):
            store.take_in(landing, p, SCHEMA)
    store.close()
    store = open_store(spark, f"{root}/store")
    if dies_in == "_note":  # nothing was journaled: the files are still new
        assert store.last_run() == 0 and store.stored().isEmpty()
        store.take_in(landing, p, SCHEMA)
    else:
        assert store.take_in(landing, p, SCHEMA) == []
    assert _rows(store.profile_days(p)) == _rows(profile_day(clean_pings(select_ping_columns(pings), p)))
    store.close()


def test_a_changed_file_is_refused(spark, pings):
    root = tempfile.mkdtemp(prefix="crashlens-store-")
    p = fixture_params()
    pings.limit(500).coalesce(1).write.parquet(f"{root}/pings")
    store = open_store(spark, f"{root}/store", cid_type="bigint", buckets=2)
    store.take_in(f"{root}/pings", p, SCHEMA)
    path = store.consumed().first()["path"].removeprefix("file:")
    with open(path, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="changed"):
        store.take_in(f"{root}/pings", p, SCHEMA)
    store.close()


def test_daily_job_over_a_store(spark, pings):
    root = tempfile.mkdtemp(prefix="crashlens-store-")
    landing, out, keys = f"{root}/pings", f"{root}/out", summary_columns(fixture_params())
    for upto, today in (("20240118", dt.date(2024, 1, 19)), ("20240131", dt.date(2024, 1, 31))):
        have = "20231101" if upto == "20240118" else "20240119"
        _drop(pings, F.col("submission_date_s3").between(have, upto), landing)
        run_stored_report_job(spark, landing, f"{root}/store", out, fixture_params(today=today), schema=SCHEMA, buckets=4)
    run_report_job(spark, select_ping_columns(pings), f"{root}/batch", fixture_params(), buckets=4)
    got, want = ({r.date: r for r in read_summaries(spark, x, keys).collect()} for x in (out, f"{root}/batch"))
    assert set(got) == set(want) and len(want) == 17
    assert all(got[d] == want[d] for d in want if d >= "2024-01-19")  # those of the second run
