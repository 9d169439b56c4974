"""Run the report job from the command line.

    python -m crashlens --pings <ping table> [<fallback location> ...] --out <folder> [--today 2024-01-31]
    spark-submit --py-files crashlens.zip crashlens/__main__.py --pings ... --out ...

Reads the ping table (first location that exists), computes every weekday report
after the last published one up to yesterday, publishes summaries and histograms
under ``--out`` and exports the merged summary as one JSON file (``--out``/merged, one
object per line; ``--out``/merged_array, the single JSON array the site reads).
The session comes from spark-submit; ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import SparkSession

from crashlens.operators.summary import summary_columns
from crashlens.params import ReportParams
from crashlens.plans.job import run_report_job
from crashlens.session import ensure_checkpoint_dir
from crashlens.sources.commits import snapshot
from crashlens.sources.pings import read_raw_pings
from crashlens.sources.published import export_histogram_arrays, export_merged, read_histograms, read_summaries


def _date(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="crashlens")
    ap.add_argument("--pings", nargs="+", required=True, help="ping table locations, tried in order")
    ap.add_argument("--out", required=True, help="output folder (summary/, hours/, merged/)")
    ap.add_argument("--today", type=_date, default=_dt.date.today())
    ap.add_argument("--first-report", type=_date, default=None,
                    help="backfill start when nothing is published yet (default: the day after 2016-09-01)")
    ap.add_argument("--thresholds", type=int, nargs="*", default=[1, 2])
    ap.add_argument("--full-history", action="store_true", help="D3: let reports see later crashes too")
    ap.add_argument("--buckets", type=int, default=None)
    ap.add_argument("--versioned", action="store_true", help="summary and histogram of a run become visible by one commit")
    args = ap.parse_args(argv)

    params = ReportParams(today=args.today, crash_thresholds=tuple(args.thresholds),
                          history_bounded=not args.full_history)
    if args.first_report:
        params = params.with_(default_last_report=args.first_report - _dt.timedelta(days=1))
    spark = SparkSession.builder.appName("crashlens").getOrCreate()
    ensure_checkpoint_dir(spark)
    result = run_report_job(spark, read_raw_pings(spark, args.pings), args.out, params, buckets=args.buckets, echo=True, versioned=args.versioned)
    there = snapshot(spark, args.out) if args.versioned else None
    merged = there.summaries(summary_columns(params)) if there else read_summaries(spark, args.out, summary_columns(params))
    if merged is not None:
        export_merged(merged, f"{args.out.rstrip('/')}/merged")
        export_merged(merged, f"{args.out.rstrip('/')}/merged_array", as_array=True)
    hist = there.histograms() if there else read_histograms(spark, args.out)
    if hist is not None:
        export_histogram_arrays(hist, f"{args.out.rstrip('/')}/hours_arrays")
    print(f"reports {result.first_report} .. {result.last_report}: {result.reports} report days")


if __name__ == "__main__":
    main()
