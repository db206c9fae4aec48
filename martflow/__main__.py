"""Command line: load a warehouse, run a named query, or run SQL.

    python -m martflow load --customers C.csv --products P.csv \
        --transactions DIR --warehouse WH [--stream] [--max-files-per-trigger N]
    python -m martflow query q05_season_category --warehouse WH [--show 20]
    python -m martflow sql "SELECT ... FROM FactSales ..." --warehouse WH
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="martflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load delivered CSV files into a warehouse")
    ld.add_argument("--customers", required=True)
    ld.add_argument("--products", required=True)
    ld.add_argument("--transactions", required=True, help="file or drop folder")
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--stream", action="store_true",
                    help="drain the folder with Structured Streaming (micro-batches)")
    ld.add_argument("--checkpoint", help="stream checkpoint (default: <warehouse>/_stream)")
    ld.add_argument("--max-files-per-trigger", type=int, default=None)
    ld.add_argument("--lines", action="store_true", help="files carry line number and supplier")
    ld.add_argument("--batch-id", default="batch")
    q = sub.add_parser("query", help="run a named query")
    q.add_argument("name")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--show", type=int, default=20)
    s = sub.add_parser("sql", help="run SQL over the star-schema views")
    s.add_argument("text")
    s.add_argument("--warehouse", required=True)
    s.add_argument("--show", type=int, default=20)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    from martflow.plans.warehouse import Warehouse, load_feed
    from martflow.session import attach_session
    spark = spark or attach_session(f"martflow-{args.cmd}")
    wh = Warehouse(spark, args.warehouse)
    if args.cmd == "load":
        from martflow.sources.csv_files import (
            csv_feed, read_customer_master, read_product_master,
        )
        if args.stream:
            from martflow.sources.feed import Feed
            from martflow.streaming.ingest import run_ingest
            masters = Feed(transactions=None,
                           customers=read_customer_master(spark, args.customers),
                           products=read_product_master(spark, args.products))
            totals = run_ingest(spark, wh, args.transactions, masters,
                                  args.checkpoint or f"{args.warehouse}/_stream",
                                  max_files_per_trigger=args.max_files_per_trigger,
                                  lines=args.lines, dedupe_masters=True)
            print(json.dumps(totals))
        else:
            feed = csv_feed(spark, args.customers, args.products, args.transactions, lines=args.lines)
            result = load_feed(wh, feed, batch=args.batch_id, dedupe_masters=True)
            if result is not None:
                result.report(spark).show(truncate=False)
        return 0
    if args.cmd == "query":
        from martflow.plans import olap
        if args.name not in olap.QUERIES:
            print(f"unknown query; choose from: {', '.join(olap.QUERIES)}", file=sys.stderr)
            return 2
        olap.QUERIES[args.name](wh).show(args.show, truncate=False)
        return 0
    from martflow.plans.views import register_views
    register_views(wh)
    spark.sql(args.text).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
