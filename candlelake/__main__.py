"""Command line: ``python -m candlelake <command> ...`` on the cluster's session.

  full-reload  --landing DIR --target DIR [--merged] [--rejects DIR] [--audit DIR]
  incremental  --landing DIR --target DIR --marks DIR [--as-of YYYY-MM-DD] [--lookback N] [--first-run-days N]
               [--per-key] [--revise] [--gaps N] [--rejects DIR] [--audit DIR]
  stream       --landing DIR --target DIR --checkpoint DIR [--max-files N] [--every "2 days"] [--revise] [--rejects DIR] [--audit DIR]
  dq-report    --landing DIR

Spark settings (master, shuffle partitions, spark.checkpoint.dir) come from spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging

from pyspark.sql import SparkSession

from .constants import FIRST_RUN_DAYS, LOOKBACK_DAYS
from .operators.bronze import flatten, landed_values
from .operators.coverage import coverage_gaps
from .operators.silver import dq_report, parse
from .plans import reload_values, run_incremental
from .session import work_dir
from .sinks.targets import ParquetTarget
from .sources.landing import read_landing
from .sources.merged import merged_values
from .streaming import start_incremental_stream
from .streaming.incremental_stream import MAX_FILES


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="candlelake")
    ap.add_argument("--format", default="json", choices=["json", "parquet"], help="landing file format")
    sub = ap.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("full-reload")
    f.add_argument("--landing", required=True)
    f.add_argument("--target", required=True)
    f.add_argument("--merged", action="store_true", help="the landing holds pretty-printed documents of all symbols")
    i = sub.add_parser("incremental")
    i.add_argument("--landing", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--marks", required=True)
    i.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    i.add_argument("--lookback", type=int, default=LOOKBACK_DAYS)
    i.add_argument("--first-run-days", type=int, default=FIRST_RUN_DAYS)
    i.add_argument("--per-key", action="store_true")
    i.add_argument("--gaps", type=int, default=None, help="instead of the window, the days that a symbol lacks and others have, in gaps of at most so many days")
    s = sub.add_parser("stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--max-files", type=int, default=MAX_FILES)
    s.add_argument("--every", default=None, help='run continuously, e.g. "2 days" (default: process what is there, then stop)')
    d = sub.add_parser("dq-report")
    d.add_argument("--landing", required=True)
    for p in (i, s):
        p.add_argument("--revise", action="store_true", help="a later copy with other values replaces the loaded one")
    for p in (f, i, s):
        p.add_argument("--audit", default=None, help="table of one row per load")
        p.add_argument("--rejects", default=None, help="table for landed values that cannot be loaded")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName(f"candlelake-{args.cmd}").getOrCreate()
    try:
        if args.cmd == "full-reload":
            values = merged_values(spark, args.landing) if args.merged else landed_values(read_landing(spark, args.landing, fmt=args.format))
            result = reload_values(spark, values, args.target, args.rejects, args.audit)
        elif args.cmd == "incremental":
            held = ParquetTarget(args.target).read(spark) if args.gaps else None
            work_dir(spark)
            result = run_incremental(
                spark, args.landing, args.target, args.marks, args.as_of, args.lookback, per_key=args.per_key, fmt=args.format,
                first_run_days=args.first_run_days, rejects_path=args.rejects, revise=args.revise, audit_path=args.audit,
                gaps=None if held is None else coverage_gaps(held, args.gaps).checkpoint(),
            )
        elif args.cmd == "stream":
            start_incremental_stream(
                spark, args.landing, args.target, args.checkpoint, args.max_files, fmt=args.format,
                available_now=args.every is None, processing_time=args.every, rejects_path=args.rejects,
                revise=args.revise, audit_path=args.audit,
            ).awaitTermination()
            result = {"outcome": "stream finished"}
        else:
            report = dq_report(parse(flatten(read_landing(spark, args.landing, fmt=args.format))))
            result = {"checks": [r.asDict() for r in report.collect()]}  # seven rows
        print(json.dumps(result, default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
