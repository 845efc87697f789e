"""Command line for the scheduled daily jobs.

    python -m tallyspark ingest   --messages DIR --date YYYY-MM-DD --out RAW
    python -m tallyspark features --raw RAW --date YYYY-MM-DD --out FEATURES
    python -m tallyspark ingest   --topic T --servers HOSTS --date YYYY-MM-DD --out RAW
    python -m tallyspark backfill --raw RAW --start D0 --end D1 --out FEATURES
    python -m tallyspark materialize --views MODULE:NAME --date YYYY-MM-DD --out ONLINE

Exit code 1 on a malformed date or when the completeness gate fails, so a
scheduler marks the run failed and retries or catches up later.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import sys

from pyspark.sql import SparkSession

log = logging.getLogger("tallyspark")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest", help="one day of the raw table from change messages")
    src = a.add_mutually_exclusive_group(required=True)
    src.add_argument("--messages", help="folder of change messages (one per line)")
    src.add_argument("--topic", help="topic of change messages")
    a.add_argument("--servers", help="bootstrap servers of the topic")
    a.add_argument("--date", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--format", default="parquet")
    a.add_argument("--deletes", default="any", choices=("any", "latest"))
    f = sub.add_parser("features", help="one run date of the feature table")
    f.add_argument("--raw", required=True)
    f.add_argument("--date", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--format", default="parquet")
    f.add_argument("--days-back", type=int, default=7)
    f.add_argument("--min-dates", type=int, default=7)
    b = sub.add_parser("backfill", help="many run dates of the feature table in one job")
    b.add_argument("--raw", required=True)
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--format", default="parquet")
    b.add_argument("--days-back", type=int, default=7)
    b.add_argument("--min-dates", type=int, default=7)
    b.add_argument("--incomplete", default="error", choices=("error", "skip"))
    m = sub.add_parser("materialize", help="feature views into their online tables")
    m.add_argument("--views", required=True, help="module:name of a list of feature views")
    m.add_argument("--date", required=True)
    m.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from . import jobs
    from .functions.dates import parse_run_date
    from .operators.quality import IncompleteInputError
    from .session import get_session
    from .sources.connectors import TopicConfig, read_messages

    args = parser().parse_args(argv)
    if args.cmd == "ingest" and args.topic and not args.servers:
        log.error("--topic needs --servers")
        return 1
    try:
        if args.cmd == "backfill":
            parse_run_date(args.start), parse_run_date(args.end)
        else:
            parse_run_date(args.date)
    except ValueError as exc:
        log.error("%s", exc)
        return 1
    spark = spark or get_session(app=f"tallyspark-{args.cmd}")
    try:
        if args.cmd == "ingest":
            messages = read_messages(spark, TopicConfig(args.servers, args.topic) if args.topic else args.messages)
            jobs.daily_ingest(messages, args.date, args.out, args.format, args.deletes)
        elif args.cmd == "features":
            jobs.daily_features(spark, args.raw, args.date, args.out, args.format,
                                days_back=args.days_back, min_dates=args.min_dates)
        elif args.cmd == "backfill":
            jobs.backfill_feature_days(spark, args.raw, args.start, args.end, args.out, args.format,
                                       days_back=args.days_back, min_dates=args.min_dates,
                                       incomplete=args.incomplete)
        else:
            module, _, name = args.views.partition(":")
            views = list(getattr(importlib.import_module(module), name))
            jobs.materialize_day(spark, views, args.date, args.out)
    except IncompleteInputError as exc:
        log.error("%s", exc)
        return 1
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
