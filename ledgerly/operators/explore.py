"""Read-only queries of the explorer: totals, trends, bands, change search, events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from . import views

# The bands of amounts.
NEGATIVE, ZERO = "1. negativo", "2. cero"
BANDS = ((1_000_000, "3. < 1M"), (10_000_000, "4. 1M - 10M"), (25_000_000, "5. 10M - 25M"))
LAST_BAND = "6. >= 25M"


def totals(current: DataFrame) -> DataFrame:
    active = F.col("is_active")
    return current.agg(
        F.count_if(active).alias("active"),
        F.count_if(~active).alias("inactive"),
        F.coalesce(F.sum(F.when(active, F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("amount"),
        F.countDistinct(F.when(active, F.col("id_cliente"))).alias("clients"),
    )


def amount_bands(current: DataFrame) -> DataFrame:
    amount = F.col("amount")
    band = F.coalesce(F.when(amount < 0, F.lit(NEGATIVE)), F.when(amount == 0, F.lit(ZERO)), *[F.when(amount < top, F.lit(name)) for top, name in BANDS], F.lit(LAST_BAND))
    return views.movements_active(current).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("movements"), F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(38,2)").alias("amount_total"))


def changes_by_type(changes: DataFrame, runs: DataFrame) -> DataFrame:
    """A column of counts for each kind of event."""
    kinds = ["NEW", "UPDATED", "DELETED", "REACTIVATED"]
    rows = views.daily_changes(changes, runs).groupBy("snapshot_date").pivot("change_type", kinds).agg(F.sum("movements"))
    return rows.na.fill(0, kinds)


def find_changes(changes: DataFrame, current: DataFrame, *, types: Sequence[str] = (), dates: Sequence[date] = (), funds: Sequence[str] = (), products: Sequence[str] = (), directions: Sequence[str] = (), names: Sequence[str] = (), client: str | None = None, key: str | None = None, impact: tuple[float, float] | None = None, no_name: str = "(sin nombre)", limit: int = 500) -> DataFrame:
    """Events that meet every given filter, the largest impact first; ties by key and date."""
    c = F.col
    given = [(c("change_type"), types), (c("snapshot_date"), dates), (c("fund"), funds), (c("product"), products), (c("type"), directions), (F.coalesce("commercial_name", F.lit(no_name)), names)]
    terms = [column.isin(*values) for column, values in given if values]
    terms += [c("id_cliente") == client] if client else []
    terms += [c("movement_key") == key] if key else []
    size = F.abs(F.coalesce("amount_delta", F.lit(0)))
    terms += [size.between(*impact)] if impact else []
    return views.change_detail(changes, current).where(X.conjunction(terms)).orderBy(size.desc(), "movement_key", "snapshot_date").limit(limit)


def fields_of(found: DataFrame, fields: DataFrame) -> DataFrame:
    """Field changes of found events."""
    return fields.join(found.select("change_id"), "change_id", "left_semi")


def key_history(history: DataFrame, key: str) -> DataFrame:
    return history.where(F.col("movement_key") == key).orderBy("version")


def deleted_with_amount(changes: DataFrame, current: DataFrame) -> DataFrame:
    rows = changes.where("change_type = 'DELETED'").select("movement_key", "snapshot_date", "amount_before", "amount_delta")
    return rows.join(current.select("movement_key", "id_cliente", "fund", "product"), "movement_key", "left")


def corrections_of(fields: DataFrame, changes: DataFrame, day: date) -> DataFrame:
    return views.change_fields(fields, changes).where(F.col("snapshot_date") == F.lit(day).cast("date")).select("movement_key", "column_name", "old_value", "new_value")


# ---- overview, quality and events


def overview(current: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: the present state, and what all cuts together brought."""
    kinds = ("rows_new", "rows_updated", "rows_deleted", "rows_rejected")
    came, went = F.col("amount_in"), F.col("amount_out")
    state = views.summary_by(current.withColumn("all", F.lit(1)), F.col("all"), "all").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("movements", "clients")],
        *[F.coalesce(F.sum(n), F.lit(0)).cast("decimal(38,2)").alias(n) for n in ("amount_total", "amount_in", "amount_out")],
    )
    brought = views.snapshot_summary(runs).agg(F.count(F.lit(1)).alias("cuts"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in kinds])
    return state.withColumn("net_flow", (came - went).cast("decimal(38,2)")).crossJoin(brought)  # a row by a row


def last_run(runs: DataFrame, success: bool = False) -> DataFrame:
    """The run that started last, of all or of the successful ones."""
    rows = runs.where("status = 'SUCCESS'") if success else runs
    return rows.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)


def alerts(raised: DataFrame) -> DataFrame:
    return raised.select("raised_at", "run_id", "code", "severity", "message").orderBy(F.desc("raised_at"), "run_id", "code")


def checks_by_run(results: DataFrame) -> DataFrame:
    columns = ("run_id", "check_group", "check_id", "check_name", "left_value", "right_value", "difference", "passed")
    return results.select(*columns).orderBy("run_id", "check_group", "check_id")


def last_checks(results: DataFrame, runs: DataFrame) -> DataFrame:
    """The checks of the last successful run, failed ones first."""
    last = F.broadcast(last_run(runs, success=True).select("run_id"))  # one row
    return checks_by_run(results.join(last, "run_id", "left_semi")).orderBy("passed", "check_group", "check_id")


def quality_totals(runs: DataFrame) -> DataFrame:
    rows = views.quality_by_run(runs)
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("rows_read", "rows_valid", "rows_rejected")]
    return rows.agg(*sums, F.avg("rejection_rate").alias("mean_rejection_rate"))


def rejections(rejected: DataFrame) -> DataFrame:
    rows = rejected.groupBy("error_code", "error_severity").agg(F.count(F.lit(1)).alias("rows"))
    return rows.orderBy(F.desc("rows"), "error_code")


def flags(found: DataFrame) -> DataFrame:
    rows = found.groupBy("flag_code", "severity", "column_name").agg(F.count(F.lit(1)).alias("occurrences"))
    return rows.orderBy(F.desc("occurrences"), "flag_code", "column_name")


def quarantine(rejected: DataFrame, limit: int = 200) -> DataFrame:
    """The first rejected rows, with their original content."""
    order = ("snapshot_date", "source_file", "source_row_number")
    return rejected.orderBy(*order).limit(limit).select(*order, "id_cliente", "error_code", "error_description", "raw_record")


def quarantine_examples(rejected: DataFrame) -> DataFrame:
    """Rejected rows of each cut and code, with the first of them."""
    first = F.min_by("raw_record", F.struct("source_file", "source_row_number"))
    return rejected.groupBy("snapshot_date", "error_code").agg(F.count(F.lit(1)).alias("rows"), first.alias("example")).orderBy(F.desc("rows"), "snapshot_date", "error_code")


def files(registry: DataFrame) -> DataFrame:
    short = F.substring("source_file_hash", 1, 16).alias("short_hash")
    return registry.select("source_file", "snapshot_date", "row_count", "status", "run_id", short, "size_bytes").orderBy("snapshot_date", "source_file")


def anomaly_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("category", "anomaly_code").agg(F.count(F.lit(1)).alias("cases")).orderBy("category", "anomaly_code")


def anomaly_list(found: DataFrame, categories: Sequence[str] = (), limit: int = 500) -> DataFrame:
    """Anomalies of the given categories, or of all, the largest observations first."""
    rows = found.where(F.col("category").isin(*categories)) if categories else found
    return rows.orderBy("category", F.abs(F.coalesce("observed", F.lit(0.0))).desc(), "anomaly_code", "entity_id").limit(limit)


def ended(current: DataFrame) -> DataFrame:
    """Movements that are no longer active, the largest amounts first."""
    rows = current.where("NOT is_active").select("movement_key", "id_cliente", "fund", "product", "amount", "deleted_at")
    return rows.orderBy(F.desc_nulls_last("amount"), "movement_key")
