"""Small named files from aggregates: CSV reports, reconciliation and insights."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import views
from .runner import Runner


class ReportError(Exception):
    """Some reports of a package could not be made."""


def _tables(r: Runner) -> dict[str, Callable[[], DataFrame]]:
    gold, audit = r.gold.read, r.audit.read
    return {
        "change_summary.csv": lambda: views.daily_changes(gold("movement_changes"), gold("pipeline_runs")).orderBy("snapshot_date", "change_type"),
        "financial_summary.csv": lambda: views.financial_summary(gold("movements_current")),
        "daily_metrics.csv": lambda: views.daily_movements(gold("movements_current")).orderBy("movement_date"),
        "data_quality_metrics.csv": lambda: views.quality_by_run(gold("pipeline_runs")).orderBy("snapshot_date"),
        "rejections_by_code.csv": lambda: views.rejections_by_code(audit("rejected_records")).orderBy(F.desc("rows_rejected")),
        "quality_flags.csv": lambda: views.quality_flags_summary(audit("data_quality_flags")).orderBy(F.desc("occurrences")),
        "field_change_frequency.csv": lambda: views.field_change_frequency(gold("movement_change_fields")).orderBy(F.desc("changes")),
        "snapshot_summary.csv": lambda: views.snapshot_summary(gold("pipeline_runs")).orderBy("snapshot_date"),
        "anomalies.csv": lambda: gold("anomalies").orderBy("category", "anomaly_code", F.abs(F.coalesce("observed", F.lit(0.0))).desc()),
        "top_movements.csv": lambda: views.top_movements(gold("movements_current"), 200),
        "top_changes_by_impact.csv": lambda: views.top_changes_by_impact(gold("movement_changes"), gold("movements_current"), 200),
        "reconciliation_all_runs.csv": lambda: gold("reconciliation_results").orderBy("run_id", "check_id"),
    }


def write_csv(r: Runner, folder: str) -> list[str]:
    """All twelve reports, or an error that names those that failed."""
    os.makedirs(folder, exist_ok=True)
    done, failed = [], []
    for name, table in _tables(r).items():
        try:
            table().toPandas().to_csv(os.path.join(folder, name), index=False)  # aggregates and top-200 lists
            done.append(name)
        except Exception as e:  # the rest is still worth writing
            failed.append(f"{name}: {type(e).__name__}: {e}")
    if failed:
        raise ReportError("; ".join(failed))
    return done


def _markdown(title: str, df: DataFrame, limit: int = 50) -> str:
    return markdown(title, df.columns, df.limit(limit).collect())


def markdown(title: str, columns: Iterable[str], rows: Iterable[Sequence]) -> str:
    """A section with one table."""
    names = list(columns)
    head = f"## {title}\n\n| {' | '.join(names)} |\n|{'---|' * len(names)}\n"
    return head + "".join(f"| {' | '.join('' if v is None else str(v) for v in row)} |\n" for row in rows) + "\n"


def write_reconciliation(r: Runner, run_id: str, folder: str) -> None:
    """Checks and sums by dimension of one run."""
    os.makedirs(folder, exist_ok=True)
    found = r.gold.read("reconciliation_results").where(F.col("run_id") == run_id).orderBy("check_id")
    sums = views.aggregates_by_dimension(r.gold.read("movements_current")).orderBy("dimension", F.desc("amount_total"))
    found.toPandas().to_csv(os.path.join(folder, f"reconciliation_{run_id}.csv"), index=False)
    sums.toPandas().to_csv(os.path.join(folder, f"aggregates_{run_id}.csv"), index=False)
    with open(os.path.join(folder, f"reconciliation_{run_id}.md"), "w", encoding="utf-8") as out:
        out.write(f"# Run {run_id}\n\n" + _markdown("Checks", found.select("check_id", "check_name", "left_value", "right_value", "passed")) + _markdown("Sums", sums))


def write_insights(r: Runner, path: str) -> None:
    """Seven sections over the present state."""
    gold = r.gold.read
    parts = {
        "Snapshots": views.snapshot_summary(gold("pipeline_runs")).orderBy("snapshot_date"),
        "Changes": views.daily_changes(gold("movement_changes"), gold("pipeline_runs")).orderBy("snapshot_date", "change_type"),
        "Funds": views.summary_by_fund(gold("movements_current")).orderBy(F.desc("amount_total")),
        "Products": views.summary_by_product(gold("movements_current")).orderBy(F.desc("amount_total")),
        "Directions": views.summary_by_type(gold("movements_current")),
        "Corrected fields": views.field_change_frequency(gold("movement_change_fields")),
        "Anomalies": gold("anomalies").groupBy("anomaly_code", "severity").count(),
    }
    with open(path, "w", encoding="utf-8") as out:
        out.write("# Insights\n\n" + "".join(_markdown(t, df) for t, df in parts.items()))
