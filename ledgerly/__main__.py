"""Command line: ``python -m ledgerly STORE --input PATH``."""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import SparkSession

from .config import load
from .plans import logs, reports
from .plans.runner import CRITICAL, OK, Runner
from .sources.snapshots import SnapshotError


log = logging.getLogger("ledgerly")


def main(argv: list[str] | None = None) -> int:
    """0: applied or skipped, 1: critical, 2: inconsistent, 3: a guard said no."""
    p = argparse.ArgumentParser(prog="ledgerly", description=main.__doc__)
    p.add_argument("store")
    p.add_argument("--input", "--input-directory", required=True, help="a snapshot or a folder of them")
    p.add_argument("--snapshot-date", type=date.fromisoformat)
    p.add_argument("--config")
    p.add_argument("--force", action="store_true")
    p.add_argument("--skip-analytics", action="store_true")
    p.add_argument("--reports", help="a folder for reports")
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--log-format", choices=("text", "json"), default="text")
    p.add_argument("--log-file")
    a = p.parse_args(argv)
    logs.configure(a.log_level, a.log_format, a.log_file)
    spark = SparkSession.builder.appName("ledgerly").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    runner = Runner(spark, a.store, load(a.config))
    try:
        results = runner.run(a.input, a.snapshot_date, a.force)
    except SnapshotError as e:
        log.error("%s", e)
        return CRITICAL
    for r in results:
        log.info("%s %s %s %s %s", r.snapshot_date, r.source_file, r.status, r.run_id, r.counts or r.reason)
    code = max((r.exit_code for r in results), default=OK)
    if not code and not a.skip_analytics:
        runner.detect()
        if a.reports:
            reports.write_csv(runner, a.reports)
            reports.write_insights(runner, f"{a.reports}/insights.md")
    return code


if __name__ == "__main__":
    raise SystemExit(main())
