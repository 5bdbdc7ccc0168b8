"""JSON and console output."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.evaluate import Report

ROW = ("stem", "hours", "duration_source", "task_id", "operator_id", "environment_id", "environment_l1", "environment_l2", "environment_l3", "difficulty", "business_size", "worker_type", "human_interaction", "warnings")


def episode_rows(rows: DataFrame) -> DataFrame:
    """The rows as they are published, in delivery order: hours to four places, warnings of the row."""
    return rows.orderBy("ord").select("stem", F.col("hours_4dp").alias("hours"), *ROW[2:-1], F.col("row_warnings").alias("warnings"), "ingest_warnings")


def write_json(report: Report, outdir: str, name: str = "diversity_report.json") -> str:
    """One indented document. Rows and offenders stream through; none are collected at once."""
    path = os.path.join(outdir, name)

    def put(f, items, indent: str) -> None:
        first = True
        for x in items:
            f.write(("" if first else ",") + "\n" + indent + json.dumps(x, ensure_ascii=False))
            first = False
        f.write("" if first else "\n" + indent[:-2])

    with open(path, "w", encoding="utf-8") as f:
        f.write('{\n  "checks": [')
        for i, c in enumerate(report.checks):
            f.write(("," if i else "") + f'\n    {{\n      "name": {json.dumps(c.name)},\n      "status": {json.dumps(c.status)},\n      "detail": {json.dumps(c.detail, ensure_ascii=False)},\n      "offenders": [')
            put(f, c.offender_rows(), " " * 8)
            f.write("]" + (f',\n      "extra": {json.dumps(c.extra, ensure_ascii=False)}' if c.extra else "") + "\n    }")
        f.write(f'\n  ],\n  "summary": {json.dumps(report.summary)},\n  "rows": [')
        put(f, (r.asDict() for r in episode_rows(report.rows).toLocalIterator()), " " * 4)
        f.write("]\n}\n")
    return path


def write_rows(report: Report, path: str) -> None:
    """The rows alone, distributed: for deliveries too large for one document."""
    episode_rows(report.rows).write.mode("overwrite").json(path)


def console(report: Report, quiet: bool = False, out: Callable[[str], None] = print) -> None:
    out("=== Diversity ===")
    out(f"Episodes: {report.summary['episodes']}  total hours: {report.summary['total_hours']:.2f}")
    for c in report.checks:
        out(f"  [{c.status:<14}] {c.name}: {c.detail}")
        if not quiet:
            for o in c.offender_rows(5):
                out(f"       - {o}")
            if c.n_offenders > 5:
                out(f"       ... {c.n_offenders - 5} more")
