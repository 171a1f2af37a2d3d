"""spark-submit entry point, one subcommand per step of the daily run.

    spark-submit strata/jobs.py run-day --root s3a://lake/warehouse --dt 2026-02-20
    spark-submit strata/jobs.py bronze  --root ... --entity orders --dt 2026-02-20
    spark-submit strata/jobs.py dim     --root ... --entity customers --dt 2026-02-20
    spark-submit strata/jobs.py fact    --root ... --dt 2026-02-20
    spark-submit strata/jobs.py gold    --root ... --dt 2026-02-20
    spark-submit strata/jobs.py init    --root ...

The session comes from the cluster (``SparkSession.builder.getOrCreate()``);
no setting is changed here.  ``--run-ts`` fixes the processing instant (for
reruns and tests); by default each step uses the current time.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata.compat import compute_yesterday_dt  # noqa: E402
from strata.plans import daily as D  # noqa: E402
from strata.plans.catalog import ensure_catalog  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata.jobs", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="step", required=True)
    for step in ("init", "bronze", "dim", "fact", "gold", "run-day"):
        s = sub.add_parser(step)
        s.add_argument("--root", required=True, help="warehouse root folder")
        if step == "init":
            s.add_argument("--dim-buckets", type=int, default=None)
            continue
        s.add_argument("--dt", default=None, help="business day YYYY-MM-DD (default: yesterday, London)")
        s.add_argument("--run-ts", default=None, help="processing instant 'YYYY-MM-DD HH:MM:SS'")
        if step in ("bronze", "run-day"):
            s.add_argument("--landing-root", default=None, help="landing root (default: --root)")
            s.add_argument("--bronze-mode", choices=("append", "replace_day"), default="append")
        if step in ("bronze", "dim"):
            choices = ("customers", "products", "orders") if step == "bronze" else ("customers", "products")
            s.add_argument("--entity", required=True, choices=choices)
        if step in ("dim", "run-day"):
            s.add_argument("--dim-buckets", type=int, default=None)
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> str:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"strata-{args.step}").getOrCreate()
    if args.step == "init":
        ensure_catalog(spark, args.root, args.dim_buckets)
        return "init"
    dt = _dt.date.fromisoformat(args.dt).isoformat() if args.dt else compute_yesterday_dt()["dt"]
    if args.step == "run-day":
        D.run_day(spark, args.root, dt, args.run_ts, args.landing_root, args.bronze_mode,
                  dim_buckets=args.dim_buckets)
    elif args.step == "bronze":
        D.ingest_entity(spark, args.root, args.landing_root or args.root, args.entity, dt, args.run_ts,
                        args.bronze_mode)
    elif args.step == "dim":
        spec, stg_spec, dim = D.DIMENSIONS[args.entity]
        D.merge_dimension(spark, args.root, dt, spec, stg_spec, dim, args.run_ts, args.dim_buckets)
    elif args.step == "fact":
        D.load_fact(spark, args.root, dt)
    elif args.step == "gold":
        D.load_gold(spark, args.root, dt, args.run_ts)
    return f"{args.step} {dt}"


if __name__ == "__main__":
    print(run(sys.argv[1:]))
