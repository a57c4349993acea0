"""The next state as projections of the diff: current, history, events and fields."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..schemas import names
from .diff import EVENTS
from .silver import Cut

_CONTENT = ("id_cliente", "movement_date", "product", "type", "fund", "amount", "description", "commercial_name")
_TAKEN = (*_CONTENT, "date_original", "type_original", "amount_original", "occurrence_ordinal", "is_key_ambiguous", "row_hash", "source_file", "source_file_hash")


def _at(now: datetime) -> Column:
    return F.lit(now).cast("timestamp")


def current(diff: DataFrame, cut: Cut, now: datetime) -> DataFrame:
    """The whole next current state: one row for each key ever seen."""
    kind = F.col("change_type")
    takes, seen, gone = kind.isin("NEW", "UPDATED", "REACTIVATED"), F.col("i").isNotNull(), kind == "DELETED"

    def pick(test: Column, new: Column, name: str) -> Column:
        return F.when(test, new).otherwise(F.col(f"c.{name}")).alias(name)

    day = F.lit(cut.snapshot_date).cast("date")
    made = {n: pick(takes, F.col(f"i.{n}"), n) for n in _TAKEN}
    made |= {
        "movement_key": F.col("movement_key"),
        "version": pick(takes, F.col("new_version"), "version"),
        "is_active": F.when(takes, True).when(gone, False).otherwise(F.col("c.is_active")).alias("is_active"),
        "first_seen_at": pick(kind == "NEW", _at(now), "first_seen_at"),
        "first_snapshot_date": pick(kind == "NEW", day, "first_snapshot_date"),
        "last_seen_at": pick(seen, _at(now), "last_seen_at"),
        "last_snapshot_date": pick(seen, day, "last_snapshot_date"),
        "updated_at": pick(takes | gone, _at(now), "updated_at"),
        "deleted_at": F.when(takes, None).when(gone, _at(now)).otherwise(F.col("c.deleted_at")).alias("deleted_at"),
        "run_id": pick(takes | gone, F.lit(cut.run_id), "run_id"),
    }
    return diff.select(*[made[n] for n in names("movements_current")])


def opened(diff: DataFrame, cut: Cut, now: datetime) -> DataFrame:
    """New versions."""
    rows = diff.where(F.col("change_type").isin("NEW", "UPDATED", "REACTIVATED"))
    day = F.lit(cut.snapshot_date).cast("date")
    made = {n: F.col(f"i.{n}").alias(n) for n in (*_CONTENT, "row_hash", "source_file", "source_file_hash")}
    made |= {
        "movement_key": F.col("movement_key"),
        "version": F.col("new_version").alias("version"),
        "change_type": F.col("change_type"),
        "valid_from": day.alias("valid_from"),
        "valid_to": F.lit(None).cast("date").alias("valid_to"),
        "is_current": F.lit(True).alias("is_current"),
        "is_deleted": F.lit(False).alias("is_deleted"),
        "snapshot_date": day.alias("snapshot_date"),
        "closed_by_run_id": F.lit(None).cast("string").alias("closed_by_run_id"),
        "run_id": F.lit(cut.run_id).alias("run_id"),
        "created_at": _at(now).alias("created_at"),
    }
    return rows.select(*[made[n] for n in names("movements_history")])


def closed(diff: DataFrame, open_history: DataFrame, cut: Cut) -> DataFrame:
    """Open versions of corrected and deleted keys, closed."""
    ended = diff.where(F.col("change_type").isin("UPDATED", "DELETED")).select("movement_key", (F.col("change_type") == "DELETED").alias("_gone"))
    rows = open_history.join(ended, "movement_key")
    new = {"valid_to": F.lit(cut.snapshot_date).cast("date"), "is_current": F.lit(False), "is_deleted": F.col("_gone"), "closed_by_run_id": F.lit(cut.run_id)}
    return rows.withColumns(new).select(*names("movements_history"))


def still_open(diff: DataFrame, open_history: DataFrame) -> DataFrame:
    """Open versions that stay open."""
    ended = diff.where(F.col("change_type").isin("UPDATED", "DELETED")).select("movement_key")
    return open_history.join(ended, "movement_key", "left_anti")


def history(diff: DataFrame, before: DataFrame, cut: Cut, now: datetime) -> DataFrame:
    """All versions after a cut: closed ones are only ever added to."""
    live = before.where("is_current")
    return before.where("NOT is_current").unionByName(closed(diff, live, cut)).unionByName(still_open(diff, live)).unionByName(opened(diff, cut, now))


def purge(rows: DataFrame, current_keys: DataFrame, snapshot_date: date, days: int | None) -> tuple[DataFrame, DataFrame]:
    """History without closed versions that ended more than ``days`` ago, and those versions.

    The latest version of a key that is still in the current state stays, so a
    deleted movement keeps the history that its current row points to.
    """
    if not days:
        return rows, rows.limit(0)
    old = ~F.col("is_current") & F.col("valid_to").isNotNull() & (F.col("valid_to") < F.date_sub(F.lit(snapshot_date).cast("date"), days))
    latest = rows.groupBy("movement_key").agg(F.max("version").alias("version")).join(current_keys.select("movement_key"), "movement_key", "left_semi").withColumn("_last", F.lit(True))
    marked = rows.join(latest, ["movement_key", "version"], "left").withColumn("_old", old & F.col("_last").isNull())
    return marked.where("NOT _old").select(*names("movements_history")), marked.where("_old").select(*names("movements_history"))


def events(diff: DataFrame, s: Settings, cut: Cut, now: datetime, offset: int = 0) -> DataFrame:
    """Numbered events with both sides.

    Numbers are dense within a slice of keys and slices follow each other by
    their counts, so no task numbers all events.
    """
    rows = diff.where(F.col("change_type").isin(*EVENTS)).withColumn("_slice", F.substring("movement_key", 1, 3))
    sizes = rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))  # 4,096 slices at most
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    number = F.row_number().over(Window.partitionBy("_slice").orderBy("movement_key"))
    return rows.withColumn("_number", number).join(F.broadcast(bases), "_slice").withColumn("change_id", F.col("_base") + F.col("_number") + offset).drop("_slice", "_base", "_number")


def changes(numbered: DataFrame, s: Settings, cut: Cut, now: datetime) -> DataFrame:
    """The event log with the monetary impact of each event on the active state."""
    kind, new, old, money = F.col("change_type"), F.col("i.amount"), F.col("c.amount"), s.contract.amount_type
    zero = F.lit(0).cast(money)
    delta = (
        F.when(kind.isin("NEW", "REACTIVATED"), new.cast(money))
        .when(kind == "UPDATED", (F.coalesce(new, zero) - F.coalesce(old, zero)).cast(money))
        .otherwise((-F.coalesce(old, zero)).cast(money))
    )
    return numbered.select(
        "change_id",
        F.lit(cut.run_id).alias("run_id"),
        F.lit(cut.snapshot_date).cast("date").alias("snapshot_date"),
        "movement_key",
        "change_type",
        F.col("old_version").alias("from_version"),
        F.when(kind == "DELETED", F.col("old_version")).otherwise(F.col("new_version")).alias("to_version"),
        "changed_columns",
        old.alias("amount_before"),
        F.when(kind != "DELETED", new).alias("amount_after"),
        delta.alias("amount_delta"),
        _at(now).alias("detected_at"),
    )


def fields(numbered: DataFrame, s: Settings, cut: Cut) -> DataFrame:
    """Old and new text of each corrected column."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"c.{n}").cast("string").alias("old_value"), F.col(f"i.{n}").cast("string").alias("new_value")) for n in s.contract.mutable])
    rows = numbered.where("change_type = 'UPDATED'").select("change_id", F.lit(cut.run_id).alias("run_id"), "movement_key", F.inline(pairs))
    return rows.where(X.differs(F.col("old_value"), F.col("new_value")))


def summary(state: DataFrame) -> dict:
    """Totals of a current state."""
    row = state.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("is_active").alias("active_rows"), F.sum(F.when(F.col("is_active"), F.col("amount"))).alias("amount_total")).first()
    return row.asDict() | {"amount_total": row["amount_total"] or 0}
