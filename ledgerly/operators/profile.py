"""Profile of raw snapshots: totals, duplicates, columns, categories, quality, comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COLUMNS
from ..functions import expressions as X

CATEGORICAL = ("product", "type", "fund", "commercial_name")
# the candidate keys, each a prefix of the business key
_KEYS = {"k_id_date": 2, "k_id_date_prod": 3, "k4": 4, "k5": 5}
_PARTS = ("id_cliente_raw", "movement_date", "product", "fund", "type")


def _raw(name: str) -> str:
    return "amount_raw" if name == "amount" else f"{name}_raw"


def summary(normal: DataFrame) -> DataFrame:
    """One row of totals, in one pass."""
    c, text = F.col, F.col("fund_raw")
    finite = ~X.non_finite(c("amount_raw"))
    return normal.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("id_cliente_raw").alias("distinct_id_cliente"),
        F.count_if(c("id_cliente_raw").isNull()).alias("null_id"),
        F.count_if(F.trim(F.coalesce("id_cliente_raw", F.lit(""))) == "").alias("empty_id"),
        F.count_if(c("movement_date").isNull()).alias("unparseable_date"),
        F.min("movement_date").alias("date_min"),
        F.max("movement_date").alias("date_max"),
        F.countDistinct("movement_date").alias("distinct_dates"),
        F.count_if(c("amount_text").isNull()).alias("null_amount"),
        F.count_if(c("amount_text").isNotNull() & c("amount_raw").isNull()).alias("invalid_amount_format"),
        F.count_if(c("amount_raw").isNotNull() & finite & c("amount").isNull()).alias("amount_out_of_range"),
        F.count_if(~finite).alias("non_finite_amount"),
        F.count_if(c("amount_raw") < 0).alias("negative_amount"),
        F.count_if(c("amount_raw") == 0).alias("zero_amount"),
        F.min("amount_raw").alias("amount_min"),
        F.max("amount_raw").alias("amount_max"),
        F.avg("amount_raw").alias("amount_avg"),
        F.count_if(c("type").isNull()).alias("unmappable_type"),
        F.countDistinct("type_raw").alias("distinct_type_raw"),
        F.countDistinct("fund_raw").alias("distinct_fund_raw"),
        F.countDistinct("fund").alias("distinct_fund_norm"),
        F.count_if(text != F.trim(text)).alias("fund_with_outer_spaces"),
        F.count_if(text.rlike(r"[ \t\n\f\r]{2}")).alias("fund_with_double_spaces"),
    )


def duplicates(normal: DataFrame) -> DataFrame:
    """Exact copies and the worth of each candidate key; a key with nulls still counts."""
    exact = normal.groupBy(*[_raw(n) for n in COLUMNS]).count().where("count > 1").agg(F.count(F.lit(1)).alias("exact_dup_groups"))
    ids = normal.groupBy("id_cliente_raw").count().where("count > 1").agg(F.count(F.lit(1)).alias("id_cliente_repeated"))
    five = normal.groupBy(*_PARTS).agg(F.count(F.lit(1)).alias("n"))  # all keys come from the finest one
    keys = five.agg(
        *[F.countDistinct(F.struct(*_PARTS[:n])).alias(name) for name, n in _KEYS.items()],
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("k5_collision_rows"),
    )
    one = exact.crossJoin(ids).crossJoin(keys)  # a row by a row
    return one.withColumn("k5_uniqueness", F.coalesce(X.share(F.col("k5"), F.col("rows")), F.lit(0.0)))


def columns(normal: DataFrame) -> DataFrame:
    """Nulls and distinct values of each column."""
    flat = normal.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(_raw(n)).cast("string").alias("value")) for n in COLUMNS])))
    out = flat.groupBy("column").agg(F.count_if(F.col("value").isNull()).alias("nulls"), F.countDistinct("value").alias("distinct_values"), F.count(F.lit(1)).alias("_n"))
    return out.select("column", "nulls", X.share(F.col("nulls"), F.col("_n")).alias("null_pct"), "distinct_values")


def categories(normal: DataFrame, limit: int = 60) -> DataFrame:
    """The most frequent values of each categorical column; ties by value."""
    parts = []
    for n in CATEGORICAL:
        counted = normal.groupBy(F.col(_raw(n)).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.orderBy(F.desc("rows"), F.asc_nulls_last("value")).limit(limit).select(F.lit(n).alias("column"), "value", "rows"))
    return reduce(DataFrame.unionByName, parts)


# The sixteen quality checks, with the severity of a finding.
QUALITY = {
    "filas": ("rows", "INFO", "INFO"),
    "id_cliente nulos": ("null_id", "CRITICAL", "OK"),
    "id_cliente vacios": ("empty_id", "CRITICAL", "OK"),
    "id_cliente distintos": ("distinct_id_cliente", "INFO", "INFO"),
    "fechas no parseables": ("unparseable_date", "CRITICAL", "OK"),
    "montos nulos": ("null_amount", "RECORD_ERROR", "OK"),
    "montos con formato invalido": ("invalid_amount_format", "RECORD_ERROR", "OK"),
    "montos fuera de DECIMAL(20,2)": ("amount_out_of_range", "RECORD_ERROR", "OK"),
    "montos no finitos": ("non_finite_amount", "RECORD_ERROR", "OK"),
    "montos negativos": ("negative_amount", "INFO", "INFO"),
    "montos cero": ("zero_amount", "INFO", "INFO"),
    "type no mapeables a IN/OUT": ("unmappable_type", "RECORD_ERROR", "OK"),
    "variantes textuales de type": ("distinct_type_raw", "WARNING", "WARNING"),
    "variantes textuales de fund": ("distinct_fund_raw", "WARNING", "WARNING"),
    "fund con espacios externos": ("fund_with_outer_spaces", "WARNING", "WARNING"),
    "fund con dobles espacios": ("fund_with_double_spaces", "WARNING", "WARNING"),
}


def quality(normal: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(c).alias("observed"), F.when(F.col(c) > 0, found).otherwise(none).alias("severity"))
        for name, (c, found, none) in QUALITY.items()
    ]
    out = summary(normal).select("rows", F.inline(F.array(*rows)))
    return out.select("check", "observed", F.coalesce(X.share(F.col("observed"), F.col("rows")), F.lit(0.0)).alias("pct_of_rows"), "severity")


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows and business keys of two snapshots, shared and not; keys with nulls match nothing."""
    key = list(_PARTS)
    ka, kb = a.select(*key).distinct(), b.select(*key).distinct()

    def n(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias(name))

    parts = [n(a, "rows_a"), n(b, "rows_b"), n(ka, "keys_a"), n(kb, "keys_b"), n(ka.join(kb, key, "left_semi"), "keys_both"), n(ka.join(kb, key, "left_anti"), "keys_only_a"), n(kb.join(ka, key, "left_anti"), "keys_only_b")]
    return reduce(lambda x, y: x.crossJoin(y), parts)  # a row by a row


def schema(actual: dict[str, str], wanted: dict[str, tuple[str, ...]]) -> list[dict]:
    """Columns of a file beside those of the contract."""
    rows = [{"column": c, "actual_type": t, "contract_type": "|".join(wanted.get(c, ())) or "(no declarada)", "in_contract": c in wanted, "required": c in wanted} for c, t in actual.items()]
    return rows + [{"column": c, "actual_type": "(ausente)", "contract_type": "|".join(t), "in_contract": True, "required": True} for c, t in wanted.items() if c not in actual]


