"""Five explainable detectors; the table is computed anew each time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..schemas import ddl, names
from . import views


def _row(run: tuple[Column, Column], code: str, category: str, severity: str, entity_type: Column, entity: Column, metric: str, observed: Column, expected: Column, threshold: Column, text: Column) -> list[Column]:
    values = (*run, F.lit(code), F.lit(category), F.lit(severity), entity_type, entity, F.lit(metric), observed.cast("double"), expected.cast("double"), threshold.cast("double"), text)
    return [v.alias(n) for v, n in zip(values, names("anomalies"), strict=True)]


def _none() -> Column:
    return F.lit(None).cast("double")


def amount_bounds(current: DataFrame, multiplier: float) -> DataFrame:
    """Quartiles and fences of each fund and direction."""
    rows = views.movements_active(current).groupBy("fund", "type").agg(X.quantile(F.col("amount"), 0.25).alias("q1"), X.quantile(F.col("amount"), 0.75).alias("q3"))
    reach = F.lit(multiplier) * (F.col("q3") - F.col("q1")).cast("double")
    return rows.where("q3 > q1").withColumns({"low": F.col("q1").cast("double") - reach, "high": F.col("q3").cast("double") + reach})


def amount_outliers(current: DataFrame, run: tuple[Column, Column], multiplier: float) -> DataFrame:
    rows = views.movements_active(current).join(amount_bounds(current, multiplier), ["fund", "type"])
    amount = F.col("amount").cast("double")
    text = F.concat(F.lit(f"Outside the quartile range x{multiplier} of "), "fund", F.lit(" / "), "type", F.lit(" ("), F.format_number("low", 2), F.lit(" .. "), F.format_number("high", 2), F.lit(")"))
    middle = (F.col("q1") + F.col("q3")).cast("double") / 2
    return rows.where((amount < F.col("low")) | (amount > F.col("high"))).select(*_row(run, "AMOUNT_OUTLIER", "OUTLIER", "INFO", F.lit("movement"), F.col("movement_key"), "amount", amount, middle, F.lit(multiplier), text))


def new_categories(flags: DataFrame) -> DataFrame:
    rows = flags.where(F.col("flag_code").isin("UNKNOWN_FUND", "UNKNOWN_PRODUCT")).groupBy("run_id", "snapshot_date", "column_name", "flag_code").agg(F.count(F.lit(1)).alias("n"))
    text = F.concat(F.lit("Values outside the catalogue of "), "column_name", F.lit(": "), F.col("n").cast("string"), F.lit(" rows"))
    run = (F.col("run_id"), F.col("snapshot_date"))
    return rows.select(*_row(run, "NEW_CATEGORY_VALUE", "QUALITY", "WARNING", F.col("column_name"), F.col("flag_code"), "occurrences", F.col("n"), F.lit(0), F.lit(0), text))


def volume_outliers(current: DataFrame, run: tuple[Column, Column], z: float) -> DataFrame:
    days = views.daily_movements(current).select("movement_date", "movements")
    usual = days.agg(F.avg("movements").alias("mu"), F.stddev_samp("movements").alias("sd"))  # one row
    score = (F.col("movements") - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0))
    rows = days.crossJoin(F.broadcast(usual)).withColumn("z", score).where((F.col("sd") > 0) & (F.abs("z") >= z))
    text = F.concat(F.lit("Day "), F.col("movement_date").cast("string"), F.lit(" has "), F.col("movements").cast("string"), F.lit(" movements, mean "), F.round("mu", 1).cast("string"), F.lit(", z "), F.round("z", 2).cast("string"))
    return rows.select(*_row(run, "DAILY_VOLUME_OUTLIER", "REVIEW", "INFO", F.lit("movement_date"), F.col("movement_date").cast("string"), "movements", F.col("movements"), F.col("mu"), F.lit(z), text))


def deletion_shares(runs: DataFrame, limit: float) -> DataFrame:
    share = X.share(F.col("rows_deleted"), F.col("rows_current_before"))
    text = F.concat(F.lit("The cut ended "), F.col("rows_deleted").cast("string"), F.lit(" of "), F.col("rows_current_before").cast("string"), F.lit(" active movements"))
    run = (F.col("run_id"), F.col("snapshot_date"))
    rows = runs.where((F.col("status") == "SUCCESS") & (share >= limit))
    return rows.select(*_row(run, "HIGH_DELETION_SHARE", "CHANGE", "WARNING", F.lit("snapshot"), F.col("snapshot_date").cast("string"), "deleted_share", share, F.lit(0), F.lit(limit), text))


def negative_amounts(current: DataFrame, run: tuple[Column, Column]) -> DataFrame:
    rows = views.summary_by_type(current).where("negative_amounts > 0")
    share = X.share(F.col("negative_amounts"), F.col("movements"))
    text = F.concat(F.col("negative_amounts").cast("string"), F.lit(" of "), F.col("movements").cast("string"), F.lit(" movements "), "type", F.lit(" are negative: reported, not corrected"))
    return rows.select(*_row(run, "NEGATIVE_AMOUNT_CONCENTRATION", "BUSINESS_RULE", "WARNING", F.lit("type"), F.col("type"), "negative_share", share, _none(), _none(), text))


def detect(current: DataFrame, flags: DataFrame, runs: DataFrame, s: Settings) -> DataFrame:
    """All anomalies; those of the state belong to the last successful run."""
    last = runs.where("status = 'SUCCESS'").orderBy(F.desc("snapshot_date"), F.desc("started_at")).select("run_id", "snapshot_date").first()
    run = (F.lit(last["run_id"] if last else None).cast("string"), F.lit(last["snapshot_date"] if last else None).cast("date"))
    parts = [volume_outliers(current, run, s.volume_zscore), deletion_shares(runs, s.deletion_share), negative_amounts(current, run)]
    if s.outlier_method == "iqr":
        parts.append(amount_outliers(current, run, s.iqr_multiplier))
    if s.new_category_alert:
        parts.append(new_categories(flags))
    return reduce(DataFrame.unionByName, parts, current.sparkSession.createDataFrame([], ddl("anomalies")))
