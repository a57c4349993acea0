"""From raw rows to fit, identified movements; the rest to quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import COLUMNS, Settings
from ..functions import expressions as X

CONTENT = ("id_cliente", "movement_date", "product", "type", "fund", "amount", "description", "commercial_name")
RAW = ("date_raw", "product_raw", "type_raw", "fund_raw", "amount_raw", "description_raw", "commercial_name_raw")


@dataclass(frozen=True)
class Cut:
    """Which snapshot rows come from."""

    run_id: str
    snapshot_date: date
    source_file: str = ""
    source_file_hash: str = ""

    def columns(self) -> list[Column]:
        return [F.lit(self.run_id).alias("run_id"), F.lit(self.source_file).alias("source_file"), F.lit(self.source_file_hash).alias("source_file_hash"), F.lit(self.snapshot_date).cast("date").alias("snapshot_date")]


def normalise(raw: DataFrame, s: Settings, snapshot_date: date) -> DataFrame:
    """Typed and normalised columns beside the raw ones, with error_code and quality_flags.

    ``raw`` may bring source_row_number; file scans get it from the reader's row index.
    """
    c, kind = s.contract, dict(raw.dtypes)["amount"]
    number = F.col("source_row_number") if "source_row_number" in raw.columns else F.lit(None).cast("long")
    texts = raw.select(
        number.cast("long").alias("source_row_number"),
        *[F.col(n).cast("string").alias(f"{n}_raw") for n in COLUMNS if n != "amount"],
        F.col("amount").cast("string").alias("amount_text"),
        X.double_of(F.col("amount"), kind).alias("amount_raw"),
    )
    typed = texts.withColumns(
        {
            "id_cliente": X.blank_to_null(F.col("id_cliente_raw")),
            "movement_date": X.parsed_date(F.col("date_raw"), c),
            "product": X.canonical(F.col("product_raw"), c.products),
            "type": X.direction(F.col("type_raw"), c),
            "fund": X.canonical(F.col("fund_raw"), c.funds),
            "amount": X.exact(F.col("amount_raw"), c),
            "description": X.blank_to_null(F.col("description_raw")),
            "commercial_name": X.collapsed(F.col("commercial_name_raw")),
        }
    )
    return typed.withColumns({"error_code": X.first_error(s.rejects_null_amount), "quality_flags": X.quality_flags(c, F.lit(snapshot_date).cast("date"), s.rejects_null_amount)})


def rejected(rows: DataFrame, cut: Cut) -> DataFrame:
    """Quarantine: unfit rows with their original content."""
    original = F.struct(*[(F.col("amount_text") if n == "amount" else F.col(f"{n}_raw")).alias(n) for n in COLUMNS])
    return rows.where(F.col("error_code").isNotNull()).select(
        *cut.columns(),
        "source_row_number",
        F.col("id_cliente_raw").alias("id_cliente"),
        "error_code",
        X.lookup(F.col("error_code"), X.ERRORS).alias("error_description"),
        F.lit("RECORD_ERROR").alias("error_severity"),
        F.to_json(original, {"ignoreNullFields": "false"}).alias("raw_record"),
    )


def deduplicated(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row for each distinct content, with the number of its copies.

    The partitioning by business key serves this aggregation and the identity window after it.
    """
    fit = rows.where(F.col("error_code").isNull()).repartition(*key)
    lowest = F.min_by(F.struct(*RAW), "source_row_number") if "source_row_number" in rows.columns else F.first(F.struct(*RAW))
    return fit.groupBy(*CONTENT).agg(
        F.min("source_row_number").alias("source_row_number"),
        F.coalesce(lowest, F.first(F.struct(*RAW))).alias("raw"),
        F.count(F.lit(1)).cast("int").alias("exact_duplicate_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("quality_flags")))).alias("quality_flags"),
    )


def identified(distinct: DataFrame, s: Settings, cut: Cut) -> DataFrame:
    """Ordinal within the business key, movement_key, row_hash and final flags."""
    c = s.contract
    key = [X.staged_name(k) for k in c.business_key]
    rest = [n for n in CONTENT if n not in key and n not in ("amount", "description", "commercial_name")]
    order = [F.col(n).asc_nulls_last() for n in ("amount", "description", "commercial_name", *rest, "source_row_number")]
    own = Window.partitionBy(*key)
    rows = distinct.withColumns({"occurrence_ordinal": F.row_number().over(own.orderBy(*order)), "is_key_ambiguous": F.count(F.lit(1)).over(own) > 1})
    ordered = [f for f in X.FLAGS if f != "KEY_AMBIGUOUS"]
    flags = F.filter(F.array(*map(F.lit, ordered)), lambda f: F.array_contains("quality_flags", f))
    return rows.select(
        *cut.columns(),
        "source_row_number",
        X.digest(c, [*[X.text_of(k) for k in c.business_key], F.col("occurrence_ordinal")]).alias("movement_key"),
        "occurrence_ordinal",
        "is_key_ambiguous",
        *CONTENT,
        F.col("raw.date_raw").alias("date_original"),
        F.col("raw.product_raw").alias("product_original"),
        F.col("raw.type_raw").alias("type_original"),
        F.col("raw.fund_raw").alias("fund_original"),
        F.col("raw.amount_raw").alias("amount_original"),
        F.col("raw.description_raw").alias("description_original"),
        F.col("raw.commercial_name_raw").alias("commercial_name_original"),
        X.digest(c, [X.text_of(n) for n in CONTENT]).alias("row_hash"),
        "exact_duplicate_count",
        F.when(F.size("quality_flags") == 0, "VALID").otherwise("WARN").alias("validation_status"),
        F.when(F.col("is_key_ambiguous"), F.array_append(flags, F.lit("KEY_AMBIGUOUS"))).otherwise(flags).alias("quality_flags"),
    )


def flags(staged: DataFrame) -> DataFrame:
    """One row for each flag of a movement."""
    rows = staged.select("run_id", "snapshot_date", "movement_key", F.explode("quality_flags").alias("flag_code"))
    severity, column = ({k: v[i] for k, v in X.FLAGS.items()} for i in (0, 1))
    return rows.select("*", X.lookup(F.col("flag_code"), severity).alias("severity"), X.lookup(F.col("flag_code"), column).alias("column_name"), F.lit(None).cast("string").alias("detail"))


@dataclass
class Silver:
    normal: DataFrame
    staged: DataFrame
    rejected: DataFrame
    flags: DataFrame


def from_normal(normal: DataFrame, s: Settings, cut: Cut, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Silver:
    """All Silver tables of normalised rows; ``keep`` materialises the staged ones, which are read often."""
    staged = keep(identified(deduplicated(normal, [X.staged_name(k) for k in s.contract.business_key]), s, cut))
    return Silver(normal, staged, rejected(normal, cut), flags(staged))


def build(raw: DataFrame, s: Settings, cut: Cut) -> Silver:
    return from_normal(normalise(raw, s, cut.snapshot_date), s, cut)
