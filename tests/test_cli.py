import json
import os
import tempfile

from pyspark.sql import functions as F

from crashlens.__main__ import main
from crashlens.sources.fixtures import events_as_main_summary
from tests.conftest import SF001


def test_cli_runs_job(spark):
    root = tempfile.mkdtemp(prefix="crashlens-cli-")
    ms = os.path.join(root, "ms")
    events_as_main_summary(spark.read.parquet(f"{SF001}/events.parquet")).withColumn("client_id", F.col("client_id").cast("string")).write.parquet(ms)
    out = os.path.join(root, "out")
    main(["--pings", os.path.join(root, "missing"), ms, "--out", out, "--today", "2024-01-31",
          "--first-report", "2024-01-08", "--buckets", "4"])
    merged = os.path.join(out, "merged")
    part = [f for f in os.listdir(merged) if f.endswith(".json")][0]
    rows = [json.loads(x) for x in open(os.path.join(merged, part))]
    assert rows and rows[0]["date"] >= "2024-01-08" and len(rows[0]) == 23
    arr_dir = os.path.join(out, "merged_array")
    part = [f for f in os.listdir(arr_dir) if f.startswith("part-")][0]
    arr = json.loads(open(os.path.join(arr_dir, part)).read())
    assert isinstance(arr, list) and len(arr) == len(rows)
    assert [x["date"] for x in arr] == sorted(x["date"] for x in arr)
    assert all(len(x) == 23 for x in arr)
    week = os.path.join(out, "hours_arrays", "end_date=" + arr[-1]["date"])
    text = "".join(open(os.path.join(week, f)).read() for f in os.listdir(week) if f.startswith("part-"))
    hist = json.loads(text)
    assert [h["hours"] for h in hist] == sorted(h["hours"] for h in hist)
    assert set(hist[0]) == {"hours", "count"}
