"""Cluster entry point: run registered queries and write their results.

    spark-submit --py-files baobab.zip baobab/job.py \\
        --input <warehouse dir> --output <shared dir> [--query name ...] [--input-bytes N] [--stage]

Each result is written as Parquet under ``<output>/<query>``; nothing is collected
to the driver. ``--input-bytes`` (total input size) sizes shuffle partitions and
scan splits with :func:`baobab.session.sizing_conf`.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

if __package__ in (None, ""):  # run as a script path (spark-submit baobab/job.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from baobab.session import build_session, sizing_conf  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True, help="folder holding <table>.parquet inputs")
    ap.add_argument("--output", required=True, help="shared folder for the results")
    ap.add_argument("--query", action="append", help="query name (repeatable); default: all")
    ap.add_argument("--input-bytes", type=int, default=0)
    ap.add_argument("--cores", type=int, default=0, help="total executor cores (sizing)")
    ap.add_argument("--stage", action="store_true",
                    help="write shared intermediates once under <output>/_stage and reuse them")
    args = ap.parse_args(argv)

    conf = sizing_conf(args.input_bytes, max(args.cores, 1)) if args.input_bytes else {}
    spark = build_session("baobab-job", conf=conf)
    if not spark.conf.get("spark.checkpoint.dir", None):  # the output folder is shared as well
        spark.sparkContext.setCheckpointDir(f"{args.output.rstrip('/')}/_shared")
    from baobab.plans import QUERIES
    from baobab.plans.base import stage_intermediates

    if args.stage:
        stage_intermediates(args.input, f"{args.output.rstrip('/')}/_stage")

    names = args.query or list(QUERIES)
    unknown = [n for n in names if n not in QUERIES]
    if unknown:
        raise SystemExit(f"unknown queries: {unknown}")
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, args.input).write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/{name}")
        print(f"{name}\t{time.perf_counter() - t0:.2f}s")


if __name__ == "__main__":
    main()
