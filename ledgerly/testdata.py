"""Snapshots of movements derived from the driver's ``orders`` table.

One SQL text serves both engines, so a query and its oracle start from the same
rows.  Three cuts hold new, corrected, deleted, unchanged and reactivated
movements, exact duplicates, ambiguous keys and every kind of bad row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .config import FUNDS, PRODUCTS
from .operators.silver import Cut

DATES = {"a": date(2001, 8, 5), "b": date(2001, 8, 6), "c": date(2001, 8, 7)}
TYPES = ("entrada", "ENTRADA", "Entrada", "in", "IN", "salida", "SALIDA", "Salida", "out", "OUT")
NAMES = ("Bancolombia", "Davivienda", "Banco  de Bogotá", " Nequi ", "BBVA", "Itaú", "Scotiabank", "Popular", "Av Villas", "Colpatria")
_MEMBERS = {"a": "g % 9 <> 3", "b": "g % 5 <> 0", "c": "g % 5 <> 0 AND g % 7 <> 2 OR g % 10 = 5"}


def cut(name: str) -> Cut:
    return Cut(f"run_{name}", DATES[name], f"cut_{name}.parquet", f"hash_{name}")


def _pick(key: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


def sql(name: str, dialect: str, orders: str = "orders") -> str:
    """A cut as SQL for ``spark`` or ``duckdb``."""
    spark = dialect == "spark"
    text = "string" if spark else "varchar"
    group = "k div 10" if spark else "k // 10"
    iso = "date_format(d, 'yyyy-MM-dd')" if spark else "strftime(d, '%Y-%m-%d')"
    dmy = "date_format(d, 'dd/MM/yyyy')" if spark else "strftime(d, '%d/%m/%Y')"
    fund = _pick("k", FUNDS)
    later = name != "a"
    amount = "p + 1.25" if later else "p"
    description = f"CASE WHEN k % 11 = 0 THEN NULL {'WHEN k % 17 = 0 THEN ' + chr(39) + 'Ajuste' + chr(39) if later else ''} ELSE concat('Movimiento ', CAST(k % 5 AS {text})) END"
    return f"""
        SELECT k * 4 + copy AS source_row_number,
            CASE WHEN k % 997 = 1 THEN NULL WHEN k % 991 = 1 THEN '   ' WHEN k % 983 = 1 THEN concat('X-', CAST(k AS {text}))
                ELSE concat('CLI', lpad(CAST(c AS {text}), 6, '0')) END AS id_cliente,
            CASE WHEN k % 499 = 1 THEN '2024-13-45' WHEN k % 503 = 1 THEN NULL WHEN k % 509 = 1 THEN '2030-01-01' WHEN k % 14 = 0 THEN {dmy} ELSE {iso} END AS date,
            CASE WHEN k % 487 = 1 THEN NULL WHEN k % 479 = 1 THEN 'Producto Nuevo' ELSE {_pick('k', PRODUCTS)} END AS product,
            CASE WHEN k % 467 = 1 THEN 'transferencia' WHEN k % 463 = 1 THEN NULL ELSE {_pick('k', TYPES)} END AS type,
            CASE WHEN k % 461 = 1 THEN NULL WHEN k % 457 = 1 THEN 'Fondo Nuevo' WHEN k % 23 = 1 THEN upper({fund}) WHEN k % 23 = 2 THEN replace({fund}, ' ', '  ')
                WHEN k % 23 = 3 THEN concat(' ', {fund}, ' ') ELSE {fund} END AS fund,
            CASE WHEN k % 33 = 0 THEN NULL WHEN k % 53 = 0 THEN CAST(0 AS double) WHEN k % 443 = 1 THEN CAST(1e30 AS double)
                ELSE CAST((CASE WHEN k % 13 = 0 THEN {amount} ELSE p END) * (CASE WHEN k % 47 = 0 THEN -1 ELSE 1 END) + extra AS double) END AS amount,
            {description} AS description,
            CASE WHEN k % 6 = 0 THEN NULL ELSE {_pick('c', NAMES)} END AS commercial_name
        FROM (
            SELECT k, c, d, p, {group} AS g, 0 AS copy, 0 AS extra FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_totalprice AS p FROM {orders}) o0
            UNION ALL
            SELECT k, c, d, p, {group} AS g, 1 AS copy, 0 AS extra FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_totalprice AS p FROM {orders}) o1 WHERE k % 101 = 0
            UNION ALL
            SELECT k, c, d, p, {group} AS g, 2 AS copy, 7 AS extra FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_totalprice AS p FROM {orders}) o2 WHERE k % 89 = 0
        ) o WHERE {_MEMBERS[name]}
    """


def snapshot(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A cut as raw rows with the contract's eight columns and source_row_number."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return spark.sql(sql(name, "spark", "{orders}"), orders=orders)
