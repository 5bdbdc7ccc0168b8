"""Command line: from a delivery to its report and an exit code (0 clear, 1 a check failed, 2 bad input)."""

from __future__ import annotations

import argparse
import os
import sys

from . import profiles
from .operators.rows import resolve_labels, rows_of
from .plans.evaluate import evaluate
from .report import html, text
from .sources import local, objectstore, probe


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="polyvant", description="Checks how varied a delivery of recorded episodes is.")
    p.add_argument("root", help="directory of the delivery, on any file system that Spark reads, or s3://bucket/prefix")
    p.add_argument("--out", default="qa_out", help="folder for the reports")
    p.add_argument("--profile", choices=list(profiles.PROFILES), default="generic")
    p.add_argument("--s3-layout", choices=("folder", "paired"), default="folder", help="how an object store's delivery is laid out")
    p.add_argument("--limit", type=int, help="at most so many episodes, in natural order")
    p.add_argument("--factory-dynamic", action="store_true", help="2 h instead of 1 h for factory pairs")
    p.add_argument("--quiet", action="store_true")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None, prober: probe.Prober | None = None) -> int:
    args = options(argv)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("polyvant").getOrCreate()
    profile = profiles.get(args.profile)
    sign = None
    try:
        if args.root.startswith("s3://"):
            found, sign = objectstore.delivery(spark, objectstore.Store.from_env(), args.root, args.s3_layout, profile, args.limit)
        else:
            found = local.episodes(spark, args.root, profile, args.limit)
        found = found.cache()  # sidecars are fetched once
        empty = found.isEmpty()
    except (OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    if empty:
        print(f"error: {args.root} holds no episode", file=sys.stderr)
        return 2
    rows = rows_of(resolve_labels(probe.measure(found, prober, sign=sign), profile)).cache()
    try:
        report = evaluate(rows, dynamic=args.factory_dynamic)
        os.makedirs(args.out, exist_ok=True)
        text.write_json(report, args.out)
        html.write_html(report, args.out)
        text.console(report, args.quiet)
        report.close()
    finally:
        rows.unpersist()
        found.unpersist()
    return 1 if report.summary["any_fail"] else 0


if __name__ == "__main__":
    sys.exit(main())
