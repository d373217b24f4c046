"""Command line for the HR warehouse jobs.

    python -m tidemark run --landing L --out O [--incremental] [--no-gate] [--period P]
    python -m tidemark restate --bronze B --corrections C --entity employees \\
        (--employee-id E | --key COLUMN=VALUE ...) --start 2025-01 --end 2025-03 --triggered-by NAME --out O
    python -m tidemark review (--log PATH | --out O) [--show 50]
    python -m tidemark vacuum --out O [--keep 2]

Uses the session the cluster provides (``spark-submit``) or a local one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tidemark.session import apply_conf


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="bronze -> silver -> gate -> gold -> review")
    r.add_argument("--landing", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--rules")
    r.add_argument("--period")
    r.add_argument("--incremental", action="store_true")
    r.add_argument("--no-gate", action="store_true")
    r.add_argument("--one-contract-per-employee", action="store_true")
    s = sub.add_parser("restate", help="replace the rows of an employee, or of any key, for a period range")
    for a in ("--bronze", "--corrections", "--entity", "--start", "--end", "--triggered-by", "--out"):
        s.add_argument(a, required=True)
    who = s.add_mutually_exclusive_group(required=True)
    who.add_argument("--employee-id")
    who.add_argument("--key", nargs="+", metavar="COLUMN=VALUE")
    v = sub.add_parser("review", help="open quality issues")
    which = v.add_mutually_exclusive_group(required=True)
    which.add_argument("--log")
    which.add_argument("--out", help="the log that the last run published")
    c = sub.add_parser("vacuum", help="delete folders that the last published runs do not name")
    c.add_argument("--out", required=True)
    c.add_argument("--keep", type=int, default=2)
    v.add_argument("--show", type=int, default=50)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tidemark-{args.cmd}").getOrCreate()
    apply_conf(spark)
    from tidemark.plans import hr
    from tidemark.sources.rules import RuleSet

    if args.cmd == "run":
        rules = RuleSet.load(spark, args.rules) if args.rules else None
        res = hr.run_warehouse(spark, args.landing, args.out, rules=rules, period=args.period,
                               gate=not args.no_gate, incremental=args.incremental,
                               one_contract_per_employee=args.one_contract_per_employee)
        print(json.dumps({"tables": res.tables, "gate": res.gate, "review": res.review},
                         default=str, indent=2))
    elif args.cmd == "restate":
        path, audit = hr.restate_bronze(spark, args.bronze, args.corrections, args.entity,
                                        args.employee_id or dict(k.split("=", 1) for k in args.key), args.start, args.end,
                                        args.triggered_by, args.out)
        print(json.dumps({"bronze": path, "audit": audit}, default=str, indent=2))
    elif args.cmd == "vacuum":
        from tidemark.sources.manifest import vacuum
        print(json.dumps({"deleted": vacuum(spark, f"{args.out}/_published", args.keep)}, indent=2))
    else:
        from tidemark.operators.quality import steward_review
        from tidemark.sources.manifest import load, read_entry
        log = spark.read.parquet(args.log) if args.log else read_entry(spark, load(spark, f"{args.out}/_published").tables["data_quality_log"])
        counts, top = steward_review(log, args.show)
        print(json.dumps(counts, indent=2))
        top.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
