"""The sixteen analytical views, as functions of the persisted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X

NO_COMMERCIAL_NAME = "(sin nombre comercial)"


def _total(test: Column | None = None, name: str = "amount") -> Column:
    value = F.col(name) if test is None else F.when(test, F.col(name))
    return F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,2)")


def _in_out() -> tuple[Column, Column]:
    return _total(F.col("type") == "IN"), _total(F.col("type") == "OUT")


def movements_active(current: DataFrame) -> DataFrame:
    return current.where("is_active")


def daily_movements(current: DataFrame) -> DataFrame:
    """Per day; the last day is partial if it has under half the median number of movements."""
    came, went = _in_out()
    days = (
        movements_active(current)
        .groupBy("movement_date")
        .agg(
            F.count(F.lit(1)).alias("movements"),
            F.countDistinct("id_cliente").alias("clients"),
            came.alias("amount_in"),
            went.alias("amount_out"),
            (came - went).cast("decimal(38,2)").alias("net_flow"),
            F.count_if(F.col("type") == "IN").alias("movements_in"),
            F.count_if(F.col("type") == "OUT").alias("movements_out"),
            F.coalesce(X.mean(F.col("amount")), F.lit(0.0)).alias("avg_amount"),
            F.coalesce(F.percentile(F.col("amount").cast("double"), 0.5), F.lit(0.0)).alias("median_amount"),
        )
    )
    usual = days.agg(F.percentile("movements", 0.5).alias("_usual"), F.max("movement_date").alias("_last"))  # one row
    partial = (F.col("movement_date") == F.col("_last")) & (F.col("movements") < F.col("_usual") * 0.5)
    return days.crossJoin(F.broadcast(usual)).withColumn("is_partial", partial).drop("_usual", "_last")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last successful run of each snapshot."""
    own = Window.partitionBy("snapshot_date").orderBy(F.desc("started_at"), F.desc("run_id"))
    return runs.where("status = 'SUCCESS'").withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")


def daily_changes(changes: DataFrame, runs: DataFrame) -> DataFrame:
    size = F.coalesce(F.sum(F.abs("amount_delta")), F.lit(0)).cast("decimal(38,2)")
    rows = changes.join(latest_runs(runs).select("run_id"), "run_id")
    return rows.groupBy("snapshot_date", "change_type").agg(F.count(F.lit(1)).alias("movements"), _total(name="amount_delta").alias("amount_impact"), size.alias("amount_impact_abs"))


def _rate(a: Column, b: Column) -> Column:
    return F.coalesce(X.share(a, b), F.lit(0.0))


def snapshot_summary(runs: DataFrame) -> DataFrame:
    c = F.col
    seen = c("rows_new") + c("rows_updated") + c("rows_unchanged") + c("rows_reactivated")
    return latest_runs(runs).select(
        "snapshot_date", "run_id", "status", "input_file", "rows_read", "rows_valid", "rows_rejected",
        _rate(c("rows_rejected"), c("rows_read")).alias("rejection_rate"),
        "rows_new", "rows_updated", "rows_deleted", "rows_unchanged", "rows_reactivated",
        _rate(c("rows_updated"), seen).alias("updated_rate"),
        "rows_current_after", "amount_current", "duration_seconds",
    )


def summary_by(current: DataFrame, key: Column, name: str, net: bool = True) -> DataFrame:
    came, went = _in_out()
    flow = [(came - went).cast("decimal(38,2)").alias("net_flow")] if net else []
    return (
        movements_active(current)
        .groupBy(key.alias(name))
        .agg(
            F.count(F.lit(1)).alias("movements"),
            F.countDistinct("id_cliente").alias("clients"),
            _total().alias("amount_total"),
            came.alias("amount_in"),
            went.alias("amount_out"),
            *flow,
            F.coalesce(X.mean(F.col("amount")), F.lit(0.0)).alias("avg_amount"),
        )
    )


def summary_by_fund(current: DataFrame) -> DataFrame:
    return summary_by(current, F.col("fund"), "fund")


def summary_by_product(current: DataFrame) -> DataFrame:
    return summary_by(current, F.col("product"), "product")


def summary_by_commercial(current: DataFrame) -> DataFrame:
    return summary_by(current, F.coalesce("commercial_name", F.lit(NO_COMMERCIAL_NAME)), "commercial_name", net=False)


def summary_by_type(current: DataFrame) -> DataFrame:
    amount = F.col("amount")
    zero = F.lit(0)
    return (
        movements_active(current)
        .groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("movements"),
            _total().alias("amount_total"),
            F.coalesce(X.mean(amount), F.lit(0.0)).alias("avg_amount"),
            F.coalesce(F.min("amount"), zero).cast("decimal(20,2)").alias("min_amount"),
            F.coalesce(F.max("amount"), zero).cast("decimal(20,2)").alias("max_amount"),
            F.count_if(amount < 0).alias("negative_amounts"),
            F.count_if(amount == 0).alias("zero_amounts"),
        )
    )


def change_detail(changes: DataFrame, current: DataFrame) -> DataFrame:
    about = current.select("movement_key", "id_cliente", "movement_date", "product", "type", "fund", "commercial_name", "is_active", "source_file")
    return changes.join(about, "movement_key", "left")


def change_fields(fields: DataFrame, changes: DataFrame) -> DataFrame:
    head = changes.select("change_id", "change_type", "snapshot_date", "run_id")
    return fields.drop("run_id").join(head, "change_id")


def field_change_frequency(fields: DataFrame) -> DataFrame:
    return fields.groupBy("column_name").agg(F.count(F.lit(1)).alias("changes"), F.countDistinct("movement_key").alias("movements_affected"))


def quality_by_run(runs: DataFrame) -> DataFrame:
    c = F.col
    rates = [_rate(c("rows_valid"), c("rows_read")).alias("valid_rate"), _rate(c("rows_rejected"), c("rows_read")).alias("rejection_rate")]
    return runs.where("status = 'SUCCESS'").select("run_id", "snapshot_date", "rows_read", "rows_valid", "rows_rejected", "rows_exact_dupes", *rates)


def rejections_by_code(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("run_id", "snapshot_date", "error_code", "error_severity").agg(F.count(F.lit(1)).alias("rows_rejected"))


def quality_flags_summary(flags: DataFrame) -> DataFrame:
    return flags.groupBy("run_id", "snapshot_date", "flag_code", "severity", "column_name").agg(F.count(F.lit(1)).alias("occurrences"))


def top_movements(current: DataFrame, limit: int | None = None) -> DataFrame:
    """By absolute amount, ties by key."""
    rows = movements_active(current).select("movement_key", "id_cliente", "movement_date", "product", "fund", "type", "amount", "description", "commercial_name")
    rows = rows.orderBy(F.abs("amount").desc_nulls_last(), "movement_key")
    return rows.limit(limit) if limit else rows


def top_changes_by_impact(changes: DataFrame, current: DataFrame, limit: int | None = None) -> DataFrame:
    """By absolute impact, ties by key; a limit is taken before the join."""
    rows = changes.select("change_id", "snapshot_date", "change_type", "movement_key", "amount_before", "amount_after", "amount_delta")
    order = [F.abs("amount_delta").desc_nulls_last(), F.col("movement_key"), F.col("snapshot_date")]
    if limit:
        rows = rows.orderBy(*order).limit(limit)
    about = current.select("movement_key", "id_cliente", "fund", "product", "type", "commercial_name")
    return rows.join(about, "movement_key", "left").orderBy(*order)


def financial_summary(current: DataFrame) -> DataFrame:
    """All four dimensions in one table."""
    keep = ["movements", "amount_total", "amount_in", "amount_out"]

    def part(name: str, rows: DataFrame, net: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("dimension"), F.col(name).alias("value"), *keep, net.cast("decimal(38,2)").alias("net_flow"))

    none = F.lit(None).cast("decimal(38,2)")
    by_type = summary_by_type(current).select(F.lit("type").alias("dimension"), F.col("type").alias("value"), "movements", "amount_total", none.alias("amount_in"), none.alias("amount_out"), none.alias("net_flow"))
    return (
        part("fund", summary_by_fund(current), F.col("net_flow"))
        .unionByName(part("product", summary_by_product(current), F.col("net_flow")))
        .unionByName(part("commercial_name", summary_by_commercial(current), F.col("amount_in") - F.col("amount_out")))
        .unionByName(by_type)
    )


def aggregates_by_dimension(current: DataFrame, no_name: str = "(sin nombre)") -> DataFrame:
    """Sums per type, fund, product and commercial name in one pass over the active state."""
    rows = movements_active(current)
    came, went = _in_out()
    pairs = [("type", F.col("type")), ("fund", F.col("fund")), ("product", F.col("product")), ("commercial_name", F.coalesce("commercial_name", F.lit(no_name)))]
    cells = F.inline(F.array(*[F.struct(F.lit(n).alias("dimension"), c.alias("value")) for n, c in pairs]))
    return rows.select("amount", F.col("type"), cells).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("movements"), _total().alias("amount_total"), came.alias("amount_in"), went.alias("amount_out"))
