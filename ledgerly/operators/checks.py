"""Structural invariants and reconciliation of a staged state."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups, names and labels of the twelve checks.
CHECKS = {
    "R1": ("INGESTA", "filas_leidas = validas + rechazadas", "rows_read", "valid+rejected"),
    "R2": ("CAMBIOS", "new+updated+deleted+unchanged+reactivated+ya_dados_de_baja = claves del FULL OUTER JOIN", "suma_por_tipo", "claves_join"),
    "R3": ("CAMBIOS", "new+updated+unchanged+reactivated = claves distintas del corte", "clasificadas_del_corte", "staging_distintas"),
    "R4": ("ESTADO", "vigentes_despues = vigentes_antes + nuevos + reactivados - eliminados", "esperado", "observado"),
    "R5": ("ESTADO", "todas las claves del corte estan en el estado vigente y activas", "sin_reflejo", "cero"),
    "R6": ("ESTADO", "como maximo una fila vigente por movement_key", "claves_duplicadas", "cero"),
    "R7": ("HISTORICO", "como maximo una version marcada como vigente por movement_key", "versiones_vigentes_duplicadas", "cero"),
    "R8": ("HISTORICO", "versiones consecutivas sin huecos", "claves_con_hueco", "cero"),
    "R9": ("MONETARIA", "monto_vigente_despues = monto_vigente_antes + suma(impacto de los cambios)", "esperado", "observado"),
    "R10": ("MONETARIA", "suma de montos del corte = suma de montos de sus claves en el estado vigente", "staging", "vigente"),
    "R11": ("BITACORA", "eventos registrados = cambios reales detectados", "movement_changes", "cambios_reales"),
    "R12": ("BITACORA", "toda correccion tiene al menos una columna modificada registrada", "correcciones_sin_detalle", "cero"),
}


def undocumented(changes: DataFrame, fields: DataFrame) -> DataFrame:
    """Corrections without a field."""
    return changes.where("change_type = 'UPDATED'").join(fields, "change_id", "left_anti")


def measure(current: DataFrame, history: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row with what the checks ask of a state: each table is read and shuffled once, by key.

    ``keys`` are those of a cut; without them nothing counts as missing or kept.
    """
    c = F.col
    open_wrong = c("is_current") & (c("valid_to").isNotNull() | c("is_deleted"))
    state = current.groupBy("movement_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_active").alias("active"),
        F.sum("amount").alias("amount"),
        F.sum(F.when(c("is_active"), c("amount"))).alias("active_amount"),
    )
    versions = history.groupBy("movement_key").agg(
        (F.max("version") - F.min("version") + 1).alias("span"),
        F.count(F.lit(1)).alias("versions"),
        F.count_if("is_current").alias("open"),
        F.count_if(open_wrong).alias("wrong"),
    )
    both = state.join(versions, "movement_key", "full")
    both = both.join(keys.select("movement_key", F.lit(True).alias("cut")), "movement_key", "full") if keys is not None else both.withColumn("cut", F.lit(False))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return both.agg(
        F.count_if(c("rows") > 1).alias("twice"),
        F.count_if(c("open") > 1).alias("open_twice"),
        F.count_if(c("span") != c("versions")).alias("gaps"),
        total(F.when(c("versions").isNull(), c("rows"))).alias("uncovered"),
        total(F.when(c("active") > 0, c("wrong"))).alias("wrong"),
        total("active").alias("active"),
        total("active_amount").alias("amount"),
        F.count_if(c("cut") & (F.coalesce(c("active"), F.lit(0)) == 0)).alias("missing"),
        total(F.when(c("cut"), c("amount"))).alias("kept_amount"),
    )


def invariants(current: DataFrame, history: DataFrame, changes: DataFrame, fields: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """invariant and violations of all six; ``measured`` is the state's measure where it is known."""
    one = measure(current, history) if measured is None else measured
    one = one.crossJoin(undocumented(changes, fields).agg(F.count(F.lit(1)).alias("silent")))  # a row by a row
    found = {
        "unique_current_row_per_key": "twice",
        "single_current_version_per_key": "open_twice",
        "history_covers_current": "uncovered",
        "no_version_gaps": "gaps",
        "active_current_matches_open_version": "wrong",
        "changes_have_events": "silent",
    }
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("invariant"), F.col(v).cast("long").alias("violations")) for k, v in found.items()])))


def reconcile(staged: DataFrame, rejected: DataFrame, diff: DataFrame, current: DataFrame, history: DataFrame, changes: DataFrame, fields: DataFrame, rows_read: int, active_before: int, amount_before: Decimal, measured: DataFrame | None = None) -> DataFrame:
    """check_id, left_value, right_value, difference and passed of the twelve checks.

    ``changes`` and ``fields`` are those of the run; ``measured`` is the state's
    measure with the cut's keys where it is known.  One-row results are combined.
    """
    big = "decimal(38,4)"
    kinds = diff.agg(F.count(F.lit(1)).alias("keys"), *[F.count_if(F.col("change_type") == t).alias(t) for t in ("NEW", "UPDATED", "DELETED", "UNCHANGED", "REACTIVATED", "STILL_DELETED")])
    parts = [
        kinds,
        staged.agg(F.coalesce(F.sum("exact_duplicate_count"), F.lit(0)).alias("valid"), F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("amount"), F.lit(0)).alias("staged_amount")),
        rejected.agg(F.count(F.lit(1)).alias("rejected")),
        measure(current, history, staged) if measured is None else measured,
        changes.agg(F.count(F.lit(1)).alias("events"), F.coalesce(F.sum("amount_delta"), F.lit(0)).alias("delta")),
        undocumented(changes, fields).agg(F.count(F.lit(1)).alias("silent")),
    ]
    one = reduce(lambda a, b: a.crossJoin(b), parts)  # a row by a row
    c, zero = F.col, F.lit(0)
    real = c("NEW") + c("UPDATED") + c("DELETED") + c("REACTIVATED")
    sides = {
        "R1": (F.lit(rows_read), c("valid") + c("rejected")),
        "R2": (real + c("UNCHANGED") + c("STILL_DELETED"), c("keys")),
        "R3": (c("NEW") + c("UPDATED") + c("UNCHANGED") + c("REACTIVATED"), c("distinct")),
        "R4": (F.lit(active_before) + c("NEW") + c("REACTIVATED") - c("DELETED"), c("active")),
        "R5": (c("missing"), zero),
        "R6": (c("twice"), zero),
        "R7": (c("open_twice"), zero),
        "R8": (c("gaps"), zero),
        "R9": (F.lit(amount_before).cast(big) + c("delta"), c("amount")),
        "R10": (c("staged_amount"), c("kept_amount")),
        "R11": (c("events"), real),
        "R12": (c("silent"), zero),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("check_id"), a.cast(big).alias("left_value"), b.cast(big).alias("right_value")) for k, (a, b) in sides.items()])
    out = one.select(F.inline(rows))
    return out.withColumn("difference", (c("left_value") - c("right_value")).cast(big)).withColumn("passed", c("difference") == 0)
