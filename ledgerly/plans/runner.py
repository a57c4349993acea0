"""One snapshot after the other: decide, stage, guard, apply, verify, publish."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import anomalies, checks, diff, gold, guards, silver
from ..schemas import ddl, names
from ..sources import snapshots
from ..sources.scratch import folder, together, written
from . import logs
from .store import Store

log = logging.getLogger("ledgerly")
OK, CRITICAL, INCONSISTENT, GUARDED = 0, 1, 2, 3


@dataclass
class Result:
    run_id: str | None
    source_file: str
    snapshot_date: date
    status: str
    counts: dict[str, int] = field(default_factory=dict)
    exit_code: int = OK
    reason: str = ""


class Failure(Exception):
    def __init__(self, code: str, message: str, exit_code: int):
        super().__init__(message)
        self.code, self.exit_code = code, exit_code


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Runner:
    """Gold state, runs and registry share one manifest; what must outlive a rollback
    (alerts, quarantine, flags, failed runs) goes to the audit manifest."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings | None = None):
        self.spark, self.s = spark, settings or Settings()
        self.gold = Store(spark, path, self.s.contract.amount_type)
        self.audit = Store(spark, path, self.s.contract.amount_type, ledger="audit")

    # ---- decisions

    def decide(self, file: snapshots.SnapshotFile, force: bool = False) -> tuple[str, str, str | None]:
        """process, skip or reject, why, and the run that holds the content already.
        A cut is its content and its date; names and paths don't matter."""
        registry = self.gold.read("file_registry").where("status = 'PROCESSED'")
        same = registry.where((F.col("source_file_hash") == file.sha256) & (F.col("snapshot_date") == F.lit(file.snapshot_date))).first()
        if same:
            if force or self.s.known_hash == "force":
                log.warning("content of run %s is applied again", same["run_id"])
                return "process", f"applied again after {same['run_id']}", None
            return "skip", f"content already applied by {same['run_id']}", same["run_id"]
        named = registry.where((F.col("source_file") == file.name) & (F.col("source_file_hash") != file.sha256)).first()
        if named:
            action = "reject" if self.s.same_name_new_hash == "reject" else "process"
            return action, f"{file.name} had other content in {named['run_id']}", None
        if not self.s.allow_out_of_order:
            last = self.runs().agg(F.max("snapshot_date")).first()[0]
            if last and file.snapshot_date < last:
                return "reject", f"cut {file.snapshot_date} is older than the last one, {last}", None
        return "process", "new cut", None

    def history(self):
        """All versions, closed and open."""
        return self.gold.read("movements_history").unionByName(self.gold.read("movements_open"))

    def runs(self):
        return self.gold.read("pipeline_runs").where("status = 'SUCCESS'")

    def _run_id(self, file: snapshots.SnapshotFile) -> str:
        base = f"{file.snapshot_date:%Y%m%d}__{file.sha256[:12]}"
        mine = F.col("run_id").startswith(base)
        n = self.gold.read("pipeline_runs").where(mine).count() + self.audit.read("pipeline_runs").where(mine).count()
        return base if not n else f"{base}__{n + 1}"

    # ---- records

    def alert(self, run_id: str | None, found: list[guards.Alert]) -> None:
        if found:
            rows = [(run_id, a.code, a.severity, a.message, float(a.observed), float(a.threshold), _now()) for a in found]
            self.audit.append("run_alerts", self.spark.createDataFrame(rows, ddl("run_alerts")).coalesce(1))

    def _registry(self, file: snapshots.SnapshotFile, status: str, run_id: str | None, reason: str) -> dict:
        return {
            "source_file": file.name, "source_file_hash": file.sha256, "source_path": file.path, "size_bytes": file.size_bytes, "row_count": file.row_count,
            "column_names": list(file.types), "schema_fingerprint": file.fingerprint, "snapshot_date": file.snapshot_date, "date_source": file.date_source,
            "status": status, "run_id": run_id, "first_seen_at": _now(), "processed_at": _now(), "reason": reason,
        }

    # ---- one cut

    def process(self, file: snapshots.SnapshotFile, force: bool = False) -> Result:
        action, why, prior = self.decide(file, force)
        key = ["source_file_hash", "snapshot_date"]
        if action == "skip":
            self.gold.upsert("file_registry", self._registry(file, "PROCESSED", prior, why), key)
            return Result(prior, file.name, file.snapshot_date, "SKIPPED", reason=why)
        if action == "reject":
            self.audit.upsert("file_registry", self._registry(file, "REJECTED", None, why), key)
            self.alert(None, [guards.Alert("FILE_OUT_OF_ORDER" if "older" in why else "FILE_REJECTED", "CRITICAL", why, 0, 0)])
            return Result(None, file.name, file.snapshot_date, "REJECTED", exit_code=CRITICAL, reason=why)
        run_id = self._run_id(file)
        with logs.within(run_id):
            return self._run(run_id, file, why, key)

    def _run(self, run_id: str, file: snapshots.SnapshotFile, why: str, key: list[str]) -> Result:
        began, clock = _now(), time.monotonic()
        log.info("cut %s of %s: %s rows, %s", file.snapshot_date, file.name, file.row_count, why, extra={"event": "run_started"})
        run = {
            "run_id": run_id, "snapshot_date": file.snapshot_date, "status": "RUNNING", "input_file": file.name, "source_file_hash": file.sha256,
            "contract_version": self.s.contract.version, "contract_hash": self.s.contract.digest, "started_at": began, "rows_read": file.row_count,
        }
        counts: dict[str, int] = {}
        try:
            problems = snapshots.check_schema(file.types, self.s.contract)
            if problems:
                raise Failure("INVALID_SCHEMA", "; ".join(problems), CRITICAL)
            counts = self._apply(file, run, clock, key)
            log.info("applied: %s", counts, extra={"event": "run_applied"})
            return Result(run_id, file.name, file.snapshot_date, "SUCCESS", counts, reason=why)
        except Exception as e:
            code, exit_code = (e.code, e.exit_code) if isinstance(e, Failure) else ("UNEXPECTED_ERROR", CRITICAL)
            log.error("run %s failed: %s: %s", run_id, code, e, extra={"event": "run_failed", "error_code": code})
            run |= {"status": "FAILED", "finished_at": _now(), "duration_seconds": time.monotonic() - clock, "exit_code": exit_code, "error_code": code, "error_message": str(e)[:2000]}
            self.audit.upsert("pipeline_runs", run, ["run_id"])
            self.alert(run_id, [guards.Alert(code, "CRITICAL", str(e)[:500], 0, 0)])
            return Result(run_id, file.name, file.snapshot_date, "FAILED", counts, exit_code, str(e))

    def _apply(self, file: snapshots.SnapshotFile, run: dict, clock: float, key: list[str]) -> dict[str, int]:
        s, now, run_id = self.s, _now(), run["run_id"]
        cut = silver.Cut(run_id, file.snapshot_date, file.name, file.sha256)
        folder(self.spark, "run")  # names the shared folder before threads ask for it
        # normalised twice, by the staged rows and by the rejected ones: cheaper than writing it, which is wider than the input
        normal = silver.normalise(snapshots.read(self.spark, file.path), s, cut.snapshot_date)
        part = silver.from_normal(normal, s, cut, lambda df: written(df, "staged"))
        current, live = self.gold.read("movements_current"), self.gold.read("movements_open")
        amount = F.coalesce(F.sum("amount"), F.lit(0)).cast(s.contract.amount_type)
        kept, flagged, staged, before, d = together(
            lambda: self.audit.write("rejected_records", part.rejected),
            lambda: self.audit.write("data_quality_flags", part.flags),
            lambda: part.staged.agg(F.count(F.lit(1)).alias("valid"), F.coalesce(F.sum(F.col("exact_duplicate_count") - 1), F.lit(0)).alias("dupes"), amount.alias("amount")).first(),
            lambda: gold.summary(current),
            lambda: written(diff.classify(part.staged, current, s, cut.snapshot_date), "diff"),
        )
        audited = {t: [*self.audit.tables.get(t, []), new] for t, new in (("rejected_records", kept), ("data_quality_flags", flagged))}
        self.audit.publish(audited)
        rejected = self.audit.read("rejected_records", audited["rejected_records"][-1:])
        run |= {"rows_valid": staged["valid"], "rows_rejected": rejected.count(), "rows_exact_dupes": staged["dupes"]}
        verdict = guards.rejection(s, file.row_count, run["rows_rejected"])
        self.alert(run_id, verdict.alerts)
        if not verdict.passed:
            raise Failure("REJECTION_RATE_EXCEEDED", "; ".join(verdict.breaches), CRITICAL)

        counts = diff.counts(d)
        last = self.runs().orderBy(F.desc("snapshot_date"), F.desc("started_at")).select("rows_valid").first()
        verdict = guards.evaluate(s, counts, staged["valid"], before["active_rows"], last["rows_valid"] if last else None, before["amount_total"], staged["amount"])
        self.alert(run_id, verdict.alerts)
        if not verdict.passed:
            raise Failure("GUARD_BREACH", "; ".join(verdict.breaches), GUARDED)

        # events are numbered without a gap, so the runs tell how many there are
        kinds = [F.coalesce(F.sum(f"rows_{t.lower()}"), F.lit(0)) for t in diff.EVENTS]
        offset = sum(self.runs().agg(*kinds).first())

        def log() -> list[str]:
            numbered = written(gold.events(d, s, cut, now, offset), "events")
            return together(
                lambda: self.gold.write("movement_changes", gold.changes(numbered, s, cut, now)),
                lambda: self.gold.write("movement_change_fields", gold.fields(numbered, s, cut)),
            )

        # closed versions are only added to, unless a retention purges some of them
        ended, opened, state, (changed, fields) = together(
            lambda: self.gold.write("movements_history", gold.closed(d, live, cut)),
            lambda: self.gold.write("movements_open", gold.still_open(d, live).unionByName(gold.opened(d, cut, now))),
            lambda: self.gold.write("movements_current", gold.current(d, cut, now)),
            log,
        )
        closed = [*self.gold.tables.get("movements_history", []), ended]
        purged = 0
        if s.retention_days:
            every = self.gold.read("movements_history", closed).unionByName(self.gold.read("movements_open", [opened]))
            kept, gone = gold.purge(every, d, cut.snapshot_date, s.retention_days)
            purged = gone.count()
            closed = [self.gold.write("movements_history", kept.where("NOT is_current"))] if purged else closed
        made = {
            "movements_current": [state],
            "movements_history": closed,
            "movements_open": [opened],
            "movement_changes": [changed],
            "movement_change_fields": [fields],
        }
        # what was written is verified, not what was planned
        new = {t: self.gold.read(t, folders) for t, folders in made.items()}
        new["movements_history"] = new["movements_history"].unionByName(new.pop("movements_open"))
        checked = [new[t] for t in ("movements_current", "movements_history", "movement_changes", "movement_change_fields")]
        measured = written(checks.measure(*checked[:2], part.staged), "measured")
        broken, found = together(
            lambda: {r["invariant"]: r["violations"] for r in checks.invariants(*checked, measured).where("violations > 0").collect()},
            lambda: written(checks.reconcile(part.staged, rejected, d, *checked, file.row_count, before["active_rows"], Decimal(before["amount_total"]), measured), "reconciliation"),
        )
        after = measured.first()
        if broken:
            raise Failure("STRUCTURAL_VIOLATION", str(broken), INCONSISTENT)
        failed = [r["check_id"] for r in found.where("NOT passed").collect()]  # twelve at most
        if failed:
            raise Failure("RECONCILIATION_FAILED", ", ".join(failed), INCONSISTENT)

        run |= {f"rows_{t.lower()}": counts[t] for t in ("NEW", "UPDATED", "DELETED", "UNCHANGED", "REACTIVATED")}
        run |= {
            "status": "SUCCESS", "finished_at": _now(), "duration_seconds": time.monotonic() - clock, "rows_current_before": before["active_rows"], "rows_current_after": after["active"],
            "amount_before": Decimal(before["amount_total"]), "amount_current": Decimal(after["amount"]), "rows_purged": purged, "exit_code": OK,
        }
        labels = self.spark.createDataFrame([(k, *v) for k, v in checks.CHECKS.items()], "check_id string, check_group string, check_name string, left_label string, right_label string")
        report = found.join(F.broadcast(labels), "check_id").withColumns({"run_id": F.lit(run_id), "snapshot_date": F.lit(cut.snapshot_date), "tolerance": F.lit(0).cast("decimal(38,4)")})
        registry = self.spark.createDataFrame([tuple(self._registry(file, "PROCESSED", run_id, "")[n] for n in names("file_registry"))], ddl("file_registry"))
        known = self.gold.read("file_registry").where(~((F.col("source_file_hash") == file.sha256) & (F.col("snapshot_date") == F.lit(file.snapshot_date))))
        run_row = self.spark.createDataFrame([tuple(run.get(n) for n in names("pipeline_runs"))], ddl("pipeline_runs", s.contract.amount_type))
        last_tables = (("file_registry", known.unionByName(registry)), ("pipeline_runs", run_row), ("reconciliation_results", report))
        written_last = together(*[lambda t=t, rows=rows: self.gold.write(t, rows.coalesce(1)) for t, rows in last_tables])
        for (t, _), new_folder in zip(last_tables, written_last):
            made[t] = [new_folder] if t == "file_registry" else [*self.gold.tables.get(t, []), new_folder]
        for t in ("movement_changes", "movement_change_fields"):
            made[t] = [*self.gold.tables.get(t, []), *made[t]]
        self.gold.publish(made)
        return counts

    def run(self, where: str, given: date | None = None, force: bool = False) -> list[Result]:
        """All snapshots under a path, until the first that fails."""
        out = []
        for file in snapshots.candidates(self.spark, where, self.s, given):
            out.append(self.process(file, force))
            if out[-1].exit_code:
                break
        return out

    def detect(self) -> int:
        """Computes the anomalies anew; returns how many there are."""
        rows = anomalies.detect(self.gold.read("movements_current"), self.audit.read("data_quality_flags"), self.gold.read("pipeline_runs"), self.s)
        self.gold.publish({"anomalies": [self.gold.write("anomalies", rows)]})
        return self.gold.read("anomalies").count()
