"""Command line: ``python -m ledgerly.profiling --input-dir FOLDER --output-dir FOLDER``."""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings, load
from .operators import profile, silver
from .plans import logs
from .plans.reports import markdown
from .sources import snapshots
from .sources.scratch import written

log = logging.getLogger("ledgerly.profiling")

#: A report for each part of a profile.
PARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "data_profile_summary.csv": ("Summary", profile.summary),
    "data_quality_summary.csv": ("Quality", profile.quality),
    "duplicate_analysis.csv": ("Duplicates", profile.duplicates),
    "column_profile.csv": ("Columns", profile.columns),
    "categorical_values.csv": ("Categories", profile.categories),
}


def tables(spark: SparkSession, where: str, s: Settings) -> dict[str, tuple[str, DataFrame]]:
    """Title and rows of each report over all snapshots under a path."""
    found = snapshots.candidates(spark, where, s)
    normal = {f.name: written(silver.normalise(snapshots.read(spark, f.path), s, f.snapshot_date), "profile") for f in found}

    def each(part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [part(rows).select(F.lit(name).alias("snapshot"), "*") for name, rows in normal.items()])

    out = {file: (title, each(part)) for file, (title, part) in PARTS.items()}
    kinds = "snapshot string, column string, actual_type string, contract_type string, in_contract boolean, required boolean"
    columns = [{"snapshot": f.name, **row} for f in found for row in profile.schema(f.types, s.contract.families)]
    out["schema_comparison.csv"] = ("Schema", spark.createDataFrame(columns, kinds))
    sides = [profile.compare(normal[a], normal[b]).select(F.lit(a).alias("snapshot_a"), F.lit(b).alias("snapshot_b"), "*") for a, b in pairwise(normal)]
    if sides:
        out["snapshot_comparison.csv"] = ("Comparison", reduce(DataFrame.unionByName, sides))
    return out


def main(argv: list[str] | None = None) -> int:
    """0: written, 1: no snapshot, or one that can't be read."""
    p = argparse.ArgumentParser(prog="ledgerly.profiling", description=main.__doc__)
    p.add_argument("--input-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--config")
    p.add_argument("--log-level", default="INFO")
    a = p.parse_args(argv)
    logs.configure(a.log_level)
    spark = SparkSession.builder.appName("ledgerly-profiling").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        found = tables(spark, a.input_dir, load(a.config))
    except snapshots.SnapshotError as e:
        log.error("%s", e)
        return 1
    os.makedirs(a.output_dir, exist_ok=True)
    text = "# Data profile\n\n"
    for file, (title, rows) in found.items():
        small = rows.toPandas()  # totals, columns and the most frequent values of each snapshot
        small.to_csv(os.path.join(a.output_dir, file), index=False)
        text += markdown(title, small.columns, small.itertuples(index=False))
    with open(os.path.join(a.output_dir, "data_profile.md"), "w", encoding="utf-8") as out:
        out.write(text)
    log.info("profile of %s written to %s", a.input_dir, a.output_dir)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
