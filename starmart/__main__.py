"""Command line: ``spark-submit``-able load and comparison.

    python -m starmart load    --raw s3a://raw --root s3a://house --batch-id b2 --as-of 2024-02-01 --previous b1
    python -m starmart stage facts --root s3a://house --snapshot b2 --as-of 2024-02-01
    python -m starmart check   --root s3a://house --batch-id b2
    python -m starmart compare --root s3a://house --snapshot b2 --out s3a://reports --as-of 2024-02-01
"""

from __future__ import annotations

import argparse

from starmart.plans.comparison import write_comparison
from starmart.plans.warehouse import Warehouse, load_batch, run_stage
from starmart.session import build_session


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="starmart")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="raw files to staging, dimensions, facts and mart")
    load.add_argument("--raw", required=True)
    load.add_argument("--batch-id", required=True)
    load.add_argument("--previous", help="batch whose route snapshot this one builds on (the latest)")
    load.add_argument("--first", action="store_true", help="start an empty warehouse")
    load.add_argument("--reload-mart", action="store_true", help="rebuild the whole mart")
    load.add_argument("--version", choices=("current", "as_of_event"), default="current", help="route version of a fact")
    stage = jobs.add_parser("stage", help="one stage of the load; without a batch id all staged batches")
    stage.add_argument("name", choices=("staging", "generated", "dimensions", "routes", "facts", "mart"))
    stage.add_argument("--raw", help="raw files, for the stage staging")
    stage.add_argument("--batch-id", help="for staging and routes it is needed")
    stage.add_argument("--snapshot", help="route snapshot that facts and mart use (that of the batch)")
    stage.add_argument("--previous")
    stage.add_argument("--first", action="store_true")
    stage.add_argument("--version", choices=("current", "as_of_event"), default="current")
    report = jobs.add_parser("compare", help="star against mart, as CSV and JSON")
    report.add_argument("--snapshot", required=True)
    report.add_argument("--out", required=True)
    report.add_argument("--days", type=int, default=7)
    check = jobs.add_parser("check", help="constraints of a batch; fails if one is violated")
    check.add_argument("--batch-id", required=True)
    for job in (load, report, check, stage):
        job.add_argument("--root", required=True)
    for job in (load, report, stage):
        job.add_argument("--as-of", required=True, help="the moment that counts as now")
    args = parser.parse_args(argv)
    if args.job == "check":
        house = Warehouse(build_session(), args.root)
        broken = house.constraints(args.batch_id, args.batch_id).filter("violations > 0")
        found = {r.check_name: r.violations for r in broken.collect()}  # one row per declared constraint
        if found:
            raise SystemExit(f"violated: {found}")
        return {"violated": 0}
    as_of = args.as_of if " " in args.as_of else f"{args.as_of} 00:00:00"
    spark = build_session()
    if args.job == "load":
        done = load_batch(spark, args.raw, args.root, args.batch_id, as_of, args.previous, args.reload_mart, args.first, args.version)
    elif args.job == "stage":
        done = run_stage(
            Warehouse(spark, args.root), args.name, args.batch_id, as_of, args.raw, args.snapshot, args.previous, args.first, args.version)
    else:
        done = write_comparison(Warehouse(spark, args.root), args.snapshot, args.out, as_of, args.days)
    print(done)
    return done


if __name__ == "__main__":
    main()
