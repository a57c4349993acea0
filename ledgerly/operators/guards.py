"""Two-level limits over figures that are already on the driver; they veto a write."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from ..config import Limit, Settings


@dataclass(frozen=True)
class Alert:
    code: str
    severity: str
    message: str
    observed: float
    threshold: float


@dataclass
class Verdict:
    alerts: list[Alert] = field(default_factory=list)
    breaches: list[str] = field(default_factory=list)
    passed: bool = True

    def hold(self, code: str, observed: float, limit: Limit, what: str) -> None:
        if observed >= limit.fail:
            self.alerts.append(Alert(code, "CRITICAL", f"{what}: {observed:.2%}, limit {limit.fail:.2%}", observed, limit.fail))
            self.breaches.append(f"{code}={observed:.4f}")
        elif observed >= limit.warn:
            self.alerts.append(Alert(code, "WARNING", f"{what}: {observed:.2%}, notice from {limit.warn:.2%}", observed, limit.warn))


def ratios(counts: dict[str, int], rows_valid: int, previous_active: int, previous_rows: int | None, before: Decimal | None, after: Decimal | None) -> dict[str, float | None]:
    """Share of deletions, drop of volume and variation of the amount; null where nothing was before."""
    return {
        "HIGH_DELETION_RATE": counts.get("DELETED", 0) / previous_active if previous_active else None,
        "VOLUME_DROP": max(0.0, (previous_rows - rows_valid) / previous_rows) if previous_rows else None,
        "AMOUNT_VARIATION": abs(float(after or 0) - float(before)) / abs(float(before)) if before else None,
    }


def evaluate(s: Settings, counts: dict[str, int], rows_valid: int, previous_active: int, previous_rows: int | None, before: Decimal | None, after: Decimal | None) -> Verdict:
    """All guards of a cut.  Below ``ratio_rows`` rows ratios say nothing and only the least number of rows counts, whatever on_breach says."""
    out = Verdict()
    if not s.guards:
        return out
    if rows_valid < s.min_valid_rows:
        out.alerts.append(Alert("MIN_VALID_ROWS", "CRITICAL", f"{rows_valid} valid rows, at least {s.min_valid_rows} expected", rows_valid, s.min_valid_rows))
        out.breaches.append(f"MIN_VALID_ROWS={rows_valid}")
    if max(previous_active, rows_valid) < s.ratio_rows:
        out.passed = not out.breaches
        return out
    found = ratios(counts, rows_valid, previous_active, previous_rows, before, after)
    for code, limit, what in (("HIGH_DELETION_RATE", s.deleted, "deletions among active movements"), ("VOLUME_DROP", s.volume_drop, "drop of rows since the last cut"), ("AMOUNT_VARIATION", s.amount_variation, "variation of the active amount")):
        if found[code] is not None:
            out.hold(code, found[code], limit, what)
    out.passed = not out.breaches or s.on_breach == "warn_only"
    return out


def rejection(s: Settings, rows_read: int, rows_rejected: int) -> Verdict:
    """The share of quarantined rows."""
    out = Verdict()
    if rows_read >= s.ratio_rows:
        out.hold("REJECTION_RATE_EXCEEDED", rows_rejected / rows_read, s.rejection_rate, "rejected rows")
    out.passed = not out.breaches
    return out
