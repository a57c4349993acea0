"""Change detection: one full outer join of a snapshot with the current state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..schemas import names

TYPES = ("NEW", "UPDATED", "DELETED", "UNCHANGED", "REACTIVATED", "STILL_DELETED")
EVENTS = ("NEW", "UPDATED", "DELETED", "REACTIVATED")
INCOMING = ("id_cliente", "movement_date", "product", "type", "fund", "amount", "description", "commercial_name", "date_original", "type_original", "amount_original", "occurrence_ordinal", "is_key_ambiguous", "row_hash", "source_file", "source_file_hash")


def classify(staged: DataFrame, current: DataFrame, s: Settings, snapshot_date: date) -> DataFrame:
    """movement_key, change_type, new_version, changed_columns, and both sides as structs ``i`` and ``c``.

    The one shuffle of a run: every table of the result is a projection of it.
    """
    if not s.allow_reactivation:
        current = current.where("is_active")  # a key that comes back is new to such a ledger
    incoming = staged.select("movement_key", F.struct(*INCOMING).alias("i"))
    before = current.select("movement_key", F.struct(*[n for n in names("movements_current") if n != "movement_key"]).alias("c"))
    i, c = F.col("i"), F.col("c")
    kind = (
        F.when(c.isNull(), "NEW")
        .when(i.isNull() & F.col("c.is_active"), "DELETED")
        .when(i.isNull(), "STILL_DELETED")
        .when(~F.col("c.is_active"), "REACTIVATED")
        .when(X.differs(F.col("i.row_hash"), F.col("c.row_hash")), "UPDATED")
        .otherwise("UNCHANGED")
    )
    changed = F.array_compact(F.array(*[F.when(X.differs(F.col(f"i.{n}"), F.col(f"c.{n}")), F.lit(n)) for n in s.contract.mutable]))
    return incoming.join(before, "movement_key", "full_outer").select(
        "movement_key",
        kind.alias("change_type"),
        F.col("c.version").alias("old_version"),
        (F.coalesce(F.col("c.version"), F.lit(0)) + 1).alias("new_version"),
        F.when(i.isNotNull() & c.isNotNull(), changed).alias("changed_columns"),
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        "i",
        "c",
    )


def counts(diff: DataFrame) -> dict[str, int]:
    found = {r["change_type"]: r["count"] for r in diff.groupBy("change_type").count().collect()}  # six rows
    return {t: found.get(t, 0) for t in TYPES}
