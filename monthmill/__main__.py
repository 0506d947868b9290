"""Command line: ``python -m monthmill credit|metadata|reports --data ... --out ...``."""

from __future__ import annotations

import argparse

from monthmill.plans.customer_meta import customer_metadata
from monthmill.plans.medallion import run_pipeline
from monthmill.plans.reports import write_reports
from monthmill.plans.retail import clean_sales
from monthmill.session import build_session
from monthmill.sinks.writers import write_csv
from monthmill.sources.readers import read_transactions
from monthmill.staging import staging_scope


def main() -> None:
    parser = argparse.ArgumentParser(prog="monthmill")
    jobs = parser.add_subparsers(dest="job", required=True)
    credit = jobs.add_parser("credit", help="source files to label store and feature store")
    credit.add_argument("--data", required=True)
    credit.add_argument("--out", required=True)
    credit.add_argument("--start", default="2023-01-01")
    credit.add_argument("--end", default="2024-12-01")
    credit.add_argument("--dpd", type=int, default=30)
    credit.add_argument("--mob", type=int, default=6)
    credit.add_argument("--mode", choices=["asof", "exact"], default="asof")
    for name, text in (
        ("metadata", "transaction file to customer metadata"),
        ("reports", "transaction file to all retail reports"),
    ):
        job = jobs.add_parser(name, help=text)
        job.add_argument("--data", required=True)
        job.add_argument("--out", required=True)
    args = parser.parse_args()

    spark = build_session()
    if args.job == "credit":
        run_pipeline(
            spark, args.data, args.out, args.start, args.end, args.dpd, args.mob, mode=args.mode
        )
    elif args.job == "reports":
        write_reports(read_transactions(spark, args.data), args.out)
    else:
        with staging_scope(spark):
            sales = clean_sales(read_transactions(spark, args.data))
            write_csv(customer_metadata(sales), args.out)


if __name__ == "__main__":
    main()
