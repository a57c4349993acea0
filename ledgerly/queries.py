"""The engine's operators as queries over three cuts, and the SQL each is held to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testdata
from .config import Settings
from .functions import expressions
from .operators import anomalies, checks, diff, explore, gold, guards, profile, silver, views
from .schemas import ddl
from .sources.scratch import folder, together, written

S = Settings()
NOW = datetime(2001, 8, 8)



@dataclass
class State:
    """What a cut leaves, and how it came about."""

    silver: silver.Silver
    diff: DataFrame
    current: DataFrame
    history: DataFrame
    changes: DataFrame
    fields: DataFrame


_known: dict[tuple[str, str], dict[str, State]] = {}


def states(spark: SparkSession, sf_dir: str) -> dict[str, State]:
    """The states after the cuts a, b and c; shared by the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _known:
        return _known[key]
    folder(spark, "cuts")  # names the shared folder before threads ask for it

    def stage(name: str) -> silver.Silver:
        cut = testdata.cut(name)
        normal = written(silver.normalise(testdata.snapshot(spark, sf_dir, name), S, cut.snapshot_date), f"normal-{name}")
        return silver.from_normal(normal, S, cut, lambda staged: written(staged, f"staged-{name}"))

    parts = dict(zip("abc", together(*[partial(stage, n) for n in "abc"])))
    current = spark.createDataFrame([], ddl("movements_current"))
    diffs, currents = {}, {}
    for i, name in enumerate("abc"):
        diffs[name] = written(diff.classify(parts[name].staged, current, S, testdata.cut(name).snapshot_date), f"diff-{name}")
        # the next state is a projection of the diff: nothing is written twice
        current = currents[name] = gold.current(diffs[name], testdata.cut(name), NOW + timedelta(hours=i))

    def histories() -> dict[str, DataFrame]:
        """Closed versions are only added to; the open ones are written anew."""
        closed, live, made = [], spark.createDataFrame([], ddl("movements_history")), {}
        for i, name in enumerate("abc"):
            cut, now, d = testdata.cut(name), NOW + timedelta(hours=i), diffs[name]
            ended, live = together(
                lambda live=live: written(gold.closed(d, live, cut), f"closed-{name}"),
                lambda live=live: written(gold.still_open(d, live).unionByName(gold.opened(d, cut, now)), f"open-{name}"),
            )
            closed.append(ended)
            made[name] = reduce(DataFrame.unionByName, closed, live)
        return made

    def events() -> dict[str, DataFrame]:
        made, offset = {}, 0
        for i, name in enumerate("abc"):
            made[name] = written(gold.events(diffs[name], S, testdata.cut(name), NOW + timedelta(hours=i), offset), f"events-{name}")
            offset += made[name].count()
        return made

    history, numbered = together(histories, events)
    out = {}
    for i, name in enumerate("abc"):
        cut, now = testdata.cut(name), NOW + timedelta(hours=i)
        out[name] = State(parts[name], diffs[name], currents[name], history[name], gold.changes(numbered[name], S, cut, now), gold.fields(numbered[name], S, cut))
    _known[key] = out
    return out


def _all(spark: SparkSession, sf_dir: str, part: Callable[[State], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [part(s) for s in states(spark, sf_dir).values()])


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One successful run for each cut."""
    rows, before = [], None
    for i, (name, s) in enumerate(states(spark, sf_dir).items()):
        cut = testdata.cut(name)
        kinds = s.diff.agg(*[F.count_if(F.col("change_type") == t).alias(f"rows_{t.lower()}") for t in ("NEW", "UPDATED", "DELETED", "UNCHANGED", "REACTIVATED")])
        read = s.silver.normal.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("error_code").isNotNull()).alias("rows_rejected"))
        valid = s.silver.staged.agg(F.count(F.lit(1)).alias("rows_valid"), F.coalesce(F.sum(F.col("exact_duplicate_count") - 1), F.lit(0)).alias("rows_exact_dupes"))
        after = s.current.agg(F.count_if("is_active").alias("rows_current_after"), F.coalesce(F.sum(F.when(F.col("is_active"), F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("amount_current"))
        was = before.agg(F.count_if("is_active").alias("rows_current_before")) if before is not None else spark.range(1).select(F.lit(0).cast("long").alias("rows_current_before"))
        one = reduce(lambda a, b: a.crossJoin(b), [kinds, read, valid, after, was])  # a row by a row
        rows.append(one.select("*", F.lit(cut.run_id).alias("run_id"), F.lit(cut.snapshot_date).cast("date").alias("snapshot_date"), F.lit("SUCCESS").alias("status"), F.lit(cut.source_file).alias("input_file"), F.lit(NOW + timedelta(hours=i)).alias("started_at"), F.lit(1.0).alias("duration_seconds")))
        before = s.current
    return reduce(DataFrame.unionByName, rows)


def _without_times(df: DataFrame) -> DataFrame:
    """Lists as text, no wall-clock columns, no surrogate ids."""
    drop = ("first_seen_at", "last_seen_at", "updated_at", "deleted_at", "created_at", "detected_at", "change_id")
    lists = {f.name: F.array_join(f.name, ",") for f in df.schema if f.dataType.typeName() == "array"}
    return df.drop(*drop).withColumns(lists)


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def note(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return note





# ---------------------------------------------------------------- oracle parts


def _norm(n: str) -> str:
    c = S.contract
    catalogue = lambda col, values: f"coalesce(CASE lower(nullif(regexp_replace(trim({col}), '\\s+', ' ', 'g'), '')) " + " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in values) + f" END, nullif(regexp_replace(trim({col}), '\\s+', ' ', 'g'), ''))"
    words = " ".join(f"WHEN lower(trim(type)) IN ({', '.join(repr(w) for w in ws)}) THEN '{k}'" for k, ws in c.synonyms.items())
    listed = lambda values: ", ".join(f"'{v}'" for v in values)
    return f"""raw_{n} AS ({testdata.sql(n, "duckdb")}),
    typed_{n} AS (SELECT source_row_number, id_cliente AS id_raw, date AS date_raw, product AS product_raw, type AS type_raw, fund AS fund_raw, amount AS amount_raw,
        description AS description_raw, commercial_name AS commercial_name_raw, CAST(amount AS VARCHAR) AS amount_text,
        nullif(trim(id_cliente), '') AS id_cliente,
        CASE WHEN regexp_matches(trim(date), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN CAST(try_strptime(trim(date), '%Y-%m-%d') AS DATE)
             WHEN regexp_matches(trim(date), '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN CAST(try_strptime(trim(date), '%d/%m/%Y') AS DATE) END AS movement_date,
        {catalogue("product", c.products)} AS product, CASE {words} END AS type, {catalogue("fund", c.funds)} AS fund,
        TRY_CAST(amount AS DECIMAL(20,2)) AS amount, nullif(trim(description), '') AS description,
        nullif(regexp_replace(trim(commercial_name), '\\s+', ' ', 'g'), '') AS commercial_name FROM raw_{n}),
    norm_{n} AS MATERIALIZED (SELECT *, CASE WHEN id_raw IS NULL THEN 'NULL_ID' WHEN id_cliente IS NULL THEN 'EMPTY_ID' WHEN date_raw IS NULL THEN 'NULL_DATE'
        WHEN movement_date IS NULL THEN 'INVALID_DATE' WHEN product IS NULL THEN 'NULL_PRODUCT' WHEN type_raw IS NULL THEN 'NULL_TYPE' WHEN type IS NULL THEN 'UNKNOWN_TYPE'
        WHEN fund IS NULL THEN 'NULL_FUND' WHEN amount_raw IS NULL THEN 'NULL_AMOUNT' WHEN amount IS NULL THEN 'AMOUNT_OUT_OF_RANGE' END AS error_code,
        concat_ws(',', CASE WHEN NOT regexp_matches(id_cliente, '{c.id_pattern}') THEN 'INVALID_ID_FORMAT' END,
        CASE WHEN product NOT IN ({listed(c.products)}) THEN 'UNKNOWN_PRODUCT' END, CASE WHEN fund NOT IN ({listed(c.funds)}) THEN 'UNKNOWN_FUND' END,
        CASE WHEN movement_date > DATE '{testdata.DATES[n]}' + 1 THEN 'DATE_OUT_OF_RANGE' END,
        CASE WHEN abs(amount_raw * 100 - round(amount_raw * 100)) > 1e-6 THEN 'AMOUNT_PRECISION_LOSS' END,
        CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END, CASE WHEN amount = 0 THEN 'ZERO_AMOUNT' END,
        CASE WHEN description IS NULL THEN 'NULL_DESCRIPTION' END, CASE WHEN commercial_name IS NULL THEN 'NULL_COMMERCIAL_NAME' END) AS flags FROM typed_{n}),
    one_{n} AS (SELECT id_cliente, movement_date, product, type, fund, amount, description, commercial_name, min(source_row_number) AS source_row_number,
        arg_min(date_raw, source_row_number) AS date_original, arg_min(type_raw, source_row_number) AS type_original, CAST(count(*) AS INTEGER) AS exact_duplicate_count, min(flags) AS flags
        FROM norm_{n} WHERE error_code IS NULL GROUP BY id_cliente, movement_date, product, type, fund, amount, description, commercial_name),
    two_{n} AS (SELECT *, CAST(row_number() OVER (PARTITION BY id_cliente, movement_date, product, type, fund ORDER BY amount NULLS LAST, description NULLS LAST, commercial_name NULLS LAST) AS INTEGER) AS occurrence_ordinal,
        count(*) OVER (PARTITION BY id_cliente, movement_date, product, type, fund) > 1 AS is_key_ambiguous FROM one_{n}),
    stg_{n} AS MATERIALIZED (SELECT 'run_{n}' AS run_id, DATE '{testdata.DATES[n]}' AS snapshot_date, sha256(concat_ws(chr(31), 'v1', id_cliente, strftime(movement_date, '%Y-%m-%d'), product, type, fund, CAST(occurrence_ordinal AS VARCHAR))) AS movement_key,
        * EXCLUDE (flags), sha256(concat_ws(chr(31), 'v1', id_cliente, strftime(movement_date, '%Y-%m-%d'), product, type, fund, CAST(amount AS VARCHAR), coalesce(description, chr(30) || 'NULL'), coalesce(commercial_name, chr(30) || 'NULL'))) AS row_hash,
        CASE WHEN flags = '' THEN 'VALID' ELSE 'WARN' END AS validation_status,
        CASE WHEN is_key_ambiguous THEN concat_ws(',', nullif(flags, ''), 'KEY_AMBIGUOUS') ELSE flags END AS quality_flags FROM two_{n})"""


_MUTABLE = ("amount", "description", "commercial_name")
_BODY = "id_cliente, movement_date, product, type, fund, amount, description, commercial_name"
_CUR = "movement_key, id_cliente, movement_date, product, type, fund, amount, description, commercial_name, date_original, type_original, occurrence_ordinal, is_key_ambiguous, row_hash, version, is_active, first_snapshot_date, last_snapshot_date, source_file, source_file_hash, run_id"


def _step(n: str, before: str | None) -> str:
    empty = f"(SELECT * FROM (SELECT {_CUR} FROM cur_seed) WHERE false)"
    was = f"cur_{before}" if before else empty
    day = f"DATE '{testdata.DATES[n]}'"
    changed = ", ".join(f"CASE WHEN i.{m} IS DISTINCT FROM c.{m} THEN '{m}' END" for m in _MUTABLE)
    take = "d.change_type IN ('NEW', 'UPDATED', 'REACTIVATED')"
    fresh = ", ".join(f"CASE WHEN {take} THEN d.i_{x} ELSE d.c_{x} END AS {x}" for x in (*_BODY.split(", "), "date_original", "type_original", "occurrence_ordinal", "is_key_ambiguous", "row_hash"))
    sides = ", ".join(f"i.{x} AS i_{x}, c.{x} AS c_{x}" for x in (*_BODY.split(", "), "date_original", "type_original", "occurrence_ordinal", "is_key_ambiguous", "row_hash"))
    hist = f"hist_{before}" if before else f"(SELECT * FROM hist_seed WHERE false)"
    return f"""diff_{n} AS MATERIALIZED (SELECT coalesce(i.movement_key, c.movement_key) AS movement_key,
        CASE WHEN c.movement_key IS NULL THEN 'NEW' WHEN i.movement_key IS NULL AND c.is_active THEN 'DELETED' WHEN i.movement_key IS NULL THEN 'STILL_DELETED'
             WHEN NOT c.is_active THEN 'REACTIVATED' WHEN i.row_hash IS DISTINCT FROM c.row_hash THEN 'UPDATED' ELSE 'UNCHANGED' END AS change_type,
        c.version AS old_version, CAST(coalesce(c.version, 0) + 1 AS INTEGER) AS new_version, CASE WHEN i.movement_key IS NOT NULL AND c.movement_key IS NOT NULL THEN concat_ws(',', {changed}) END AS changed_columns,
        {day} AS snapshot_date, {sides}, c.version AS c_version, c.is_active AS c_is_active, c.first_snapshot_date AS c_first, c.last_snapshot_date AS c_last, c.source_file AS c_file, c.source_file_hash AS c_hash, c.run_id AS c_run, i.movement_key IS NOT NULL AS seen
        FROM stg_{n} i FULL OUTER JOIN {was} c ON i.movement_key = c.movement_key),
    cur_{n} AS MATERIALIZED (SELECT movement_key, {fresh}, CASE WHEN {take} THEN new_version ELSE c_version END AS version,
        CASE WHEN {take} THEN true WHEN change_type = 'DELETED' THEN false ELSE c_is_active END AS is_active,
        CASE WHEN change_type = 'NEW' THEN {day} ELSE c_first END AS first_snapshot_date, CASE WHEN seen THEN {day} ELSE c_last END AS last_snapshot_date,
        CASE WHEN {take} THEN 'cut_{n}.parquet' ELSE c_file END AS source_file, CASE WHEN {take} THEN 'hash_{n}' ELSE c_hash END AS source_file_hash,
        CASE WHEN {take} OR change_type = 'DELETED' THEN 'run_{n}' ELSE c_run END AS run_id FROM diff_{n} d),
    hist_{n} AS MATERIALIZED (SELECT h.* REPLACE (CASE WHEN h.is_current AND d.change_type IN ('UPDATED', 'DELETED') THEN {day} ELSE h.valid_to END AS valid_to,
            h.is_current AND coalesce(d.change_type, '') NOT IN ('UPDATED', 'DELETED') AS is_current,
            CASE WHEN h.is_current AND d.change_type IN ('UPDATED', 'DELETED') THEN d.change_type = 'DELETED' ELSE h.is_deleted END AS is_deleted,
            CASE WHEN h.is_current AND d.change_type IN ('UPDATED', 'DELETED') THEN 'run_{n}' ELSE h.closed_by_run_id END AS closed_by_run_id)
        FROM {hist} h LEFT JOIN diff_{n} d USING (movement_key)
        UNION ALL SELECT movement_key, new_version, {", ".join(f"i_{x}" for x in _BODY.split(", "))}, i_row_hash, change_type, {day}, NULL, true, false, {day}, NULL, 'cut_{n}.parquet', 'hash_{n}', 'run_{n}' FROM diff_{n} d WHERE {take}),
    chg_{n} AS (SELECT 'run_{n}' AS run_id, snapshot_date, movement_key, change_type, old_version AS from_version, CASE WHEN change_type = 'DELETED' THEN old_version ELSE new_version END AS to_version, changed_columns,
        c_amount AS amount_before, CASE WHEN change_type <> 'DELETED' THEN i_amount END AS amount_after,
        CAST(CASE WHEN change_type IN ('NEW', 'REACTIVATED') THEN i_amount WHEN change_type = 'UPDATED' THEN coalesce(i_amount, 0) - coalesce(c_amount, 0) ELSE -coalesce(c_amount, 0) END AS DECIMAL(20,2)) AS amount_delta
        FROM diff_{n} WHERE change_type IN ('NEW', 'UPDATED', 'DELETED', 'REACTIVATED')),
    fld_{n} AS (SELECT * FROM (SELECT 'run_{n}' AS run_id, movement_key, unnest(['amount', 'description', 'commercial_name']) AS column_name,
        unnest([CAST(c_amount AS VARCHAR), c_description, c_commercial_name]) AS old_value, unnest([CAST(i_amount AS VARCHAR), i_description, i_commercial_name]) AS new_value
        FROM diff_{n} WHERE change_type = 'UPDATED') WHERE old_value IS DISTINCT FROM new_value)"""


def _with(body: str, last: str = "c") -> str:
    """A statement with everything that the cuts up to ``last`` leave."""
    cuts = "abc"[: "abc".index(last) + 1]
    seed = """cur_seed AS (SELECT movement_key, id_cliente, movement_date, product, type, fund, amount, description, commercial_name, date_original, type_original, occurrence_ordinal, is_key_ambiguous, row_hash,
        CAST(0 AS INTEGER) AS version, false AS is_active, snapshot_date AS first_snapshot_date, snapshot_date AS last_snapshot_date, '' AS source_file, '' AS source_file_hash, run_id FROM stg_a),
    hist_seed AS (SELECT movement_key, CAST(0 AS INTEGER) AS version, id_cliente, movement_date, product, type, fund, amount, description, commercial_name, row_hash, '' AS change_type, snapshot_date AS valid_from, CAST(NULL AS DATE) AS valid_to,
        true AS is_current, false AS is_deleted, snapshot_date, CAST(NULL AS VARCHAR) AS closed_by_run_id, '' AS source_file, '' AS source_file_hash, run_id FROM stg_a)"""
    parts = [_norm(n) for n in cuts] + [seed] + [_step(n, p) for n, p in zip(cuts, [None, *cuts])]
    every = [f"{name} AS ({' UNION ALL '.join(f'SELECT * FROM {part}_{n}' for n in cuts)})" for name, part in (("stg", "stg"), ("chg", "chg"), ("fld", "fld"))]
    counts = lambda n: ", ".join(f"(SELECT count(*) FROM diff_{n} WHERE change_type = '{t}') AS rows_{t.lower()}" for t in ("NEW", "UPDATED", "DELETED", "UNCHANGED", "REACTIVATED"))
    run = [
        f"SELECT 'run_{n}' AS run_id, DATE '{testdata.DATES[n]}' AS snapshot_date, 'SUCCESS' AS status, 'cut_{n}.parquet' AS input_file, (SELECT count(*) FROM norm_{n}) AS rows_read, (SELECT count(*) FROM norm_{n} WHERE error_code IS NOT NULL) AS rows_rejected, "
        f"(SELECT count(*) FROM stg_{n}) AS rows_valid, (SELECT CAST(coalesce(sum(exact_duplicate_count - 1), 0) AS BIGINT) FROM stg_{n}) AS rows_exact_dupes, {counts(n)}, (SELECT count(*) FROM cur_{n} WHERE is_active) AS rows_current_after, "
        f"(SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) FROM cur_{n} WHERE is_active) AS amount_current, {f'(SELECT count(*) FROM cur_{p} WHERE is_active)' if p else 'CAST(0 AS BIGINT)'} AS rows_current_before, CAST(1.0 AS DOUBLE) AS duration_seconds"
        for n, p in zip(cuts, [None, *cuts])
    ]
    final = [f"runs AS ({' UNION ALL '.join(run)})", f"cur AS (SELECT * FROM cur_{last})", f"act AS (SELECT * FROM cur_{last} WHERE is_active)", f"hist AS (SELECT * FROM hist_{last})"]
    return "WITH " + ",\n".join(parts + every + final) + "\n" + body


# ------------------------------------------------------------------ the queries

_STG = "movement_key, occurrence_ordinal, is_key_ambiguous, id_cliente, movement_date, product, type, fund, amount, description, commercial_name, row_hash, exact_duplicate_count, validation_status, quality_flags"


@_query(_with(f"SELECT {_STG} FROM stg_a", "a"))
def stg_valid(spark, sf):
    return _without_times(states(spark, sf)["a"].silver.staged).select(*_STG.split(", "))


@_query(_with("SELECT error_code, count(*) AS n FROM norm_a WHERE error_code IS NOT NULL GROUP BY error_code", "a"))
def stg_rejected_by_code(spark, sf):
    return states(spark, sf)["a"].silver.rejected.groupBy("error_code").agg(F.count(F.lit(1)).alias("n"))


@_query(_with("SELECT source_row_number, error_code, amount_raw AS amount, CAST(to_json({'id_cliente': id_raw, 'date': date_raw, 'product': product_raw, 'type': type_raw, 'fund': fund_raw, 'amount': CASE WHEN amount_text IS NOT NULL THEN '#' END, 'description': description_raw, 'commercial_name': commercial_name_raw}) AS VARCHAR) AS raw_record FROM norm_a WHERE error_code IS NOT NULL", "a"))
def stg_rejected_json(spark, sf):
    """Every rejected row; the engines write large doubles differently, so the amount is compared as a number."""
    rows = states(spark, sf)["a"].silver.rejected
    text = F.regexp_replace("raw_record", '"amount":"[^"]*"', '"amount":"#"')
    return rows.select("source_row_number", "error_code", F.get_json_object("raw_record", "$.amount").cast("double").alias("amount"), text.alias("raw_record"))


#: Amounts as text: well formed, not finite, too large, and in formats that are none.
_TEXTS = ("1234.56", "-500", "0", "1.234,56", "no-es-numero", "NaN", "inf", "-Infinity", "1e30", "  77.7 ", "1_000", None)


def _text_amounts(dialect: str) -> str:
    div, text = ("div", "string") if dialect == "spark" else ("//", "varchar")
    arms = " ".join(f"WHEN {i} THEN {'NULL' if t is None else repr(t)}" for i, t in enumerate(_TEXTS))
    return f"SELECT k AS source_row_number, concat('CLI', lpad(CAST(k % 1000000 AS {text}), 6, '0')) AS id_cliente, '2001-08-01' AS date, 'Bonos' AS product, 'in' AS type, 'Renta Fija' AS fund, CASE k {div} 7 % {len(_TEXTS)} {arms} END AS amount, 'd' AS description, 'BBVA' AS commercial_name FROM (SELECT o_orderkey AS k FROM orders) o"


_TYPED = f"""WITH raw AS ({_text_amounts('duckdb')}), seen AS (SELECT *, CASE WHEN regexp_matches(trim(amount), '^[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?|[iI]nf(inity)?|Infinity|[nN]a[nN])$') THEN TRY_CAST(trim(amount) AS DOUBLE) END AS x FROM raw),
    typed AS (SELECT *, CASE WHEN amount IS NULL THEN 'NULL_AMOUNT' WHEN x IS NULL THEN 'INVALID_AMOUNT_FORMAT' WHEN isnan(x) OR isinf(x) THEN 'NON_FINITE_AMOUNT' WHEN TRY_CAST(x AS DECIMAL(20,2)) IS NULL THEN 'AMOUNT_OUT_OF_RANGE' END AS error_code,
        CASE WHEN NOT (isnan(x) OR isinf(x)) THEN TRY_CAST(x AS DECIMAL(20,2)) END AS value FROM seen)"""


def _typed(spark, sf, settings):
    spark.read.parquet(f"{sf}/orders.parquet").createOrReplaceTempView("_ledgerly_orders")
    raw = spark.sql(_text_amounts("spark").replace("FROM orders", "FROM _ledgerly_orders"))
    return silver.normalise(raw, settings, testdata.DATES["a"])


@_query(_TYPED + " SELECT error_code, " + "CASE error_code WHEN 'NULL_AMOUNT' THEN '{}' WHEN 'INVALID_AMOUNT_FORMAT' THEN '{}' WHEN 'NON_FINITE_AMOUNT' THEN '{}' ELSE '{}' END".format(*(expressions.ERRORS[k] for k in ("NULL_AMOUNT", "INVALID_AMOUNT_FORMAT", "NON_FINITE_AMOUNT", "AMOUNT_OUT_OF_RANGE"))) + " AS error_description, amount AS amount_text, count(*) AS n FROM typed WHERE error_code IS NOT NULL GROUP BY ALL")
def stg_text_amounts_rejected(spark, sf):
    """Text amounts that are null, no numbers, not finite or out of range, with the codes' descriptions."""
    rows = silver.rejected(_typed(spark, sf, S), testdata.cut("a"))
    return rows.groupBy("error_code", "error_description", F.get_json_object("raw_record", "$.amount").alias("amount_text")).agg(F.count(F.lit(1)).alias("n"))


@_query(_TYPED + " SELECT value AS amount, concat_ws(',', CASE WHEN value < 0 THEN 'NEGATIVE_AMOUNT' END, CASE WHEN value = 0 THEN 'ZERO_AMOUNT' END, CASE WHEN value IS NULL THEN 'NULL_AMOUNT_KEPT' END) AS quality_flags, count(*) AS n FROM typed WHERE error_code IS NULL OR error_code = 'NULL_AMOUNT' GROUP BY ALL")
def stg_text_amounts_kept(spark, sf):
    """Text amounts under the policy that keeps null ones with a warning."""
    rows = _typed(spark, sf, replace(S, null_amount_policy="keep_with_warning")).where("error_code IS NULL")
    return rows.groupBy("amount", F.array_join("quality_flags", ",").alias("quality_flags")).agg(F.count(F.lit(1)).alias("n"))


@_query(_with("SELECT movement_key, flag_code FROM (SELECT movement_key, unnest(string_split(quality_flags, ',')) AS flag_code FROM stg_a WHERE quality_flags <> '')", "a"))
def stg_flags(spark, sf):
    return states(spark, sf)["a"].silver.flags.select("movement_key", "flag_code")


@_query(_with("SELECT movement_key, exact_duplicate_count FROM stg_a WHERE exact_duplicate_count > 1", "a"))
def dedup_exact(spark, sf):
    return states(spark, sf)["a"].silver.staged.where("exact_duplicate_count > 1").select("movement_key", "exact_duplicate_count")


@_query(_with("SELECT id_cliente, movement_date, product, type, fund, amount, occurrence_ordinal FROM stg_a WHERE is_key_ambiguous", "a"))
def identity_ordinal(spark, sf):
    return states(spark, sf)["a"].silver.staged.where("is_key_ambiguous").select("id_cliente", "movement_date", "product", "type", "fund", "amount", "occurrence_ordinal")


@_query(_with("SELECT source_row_number, movement_date, product, type, fund, amount, description, commercial_name FROM norm_a", "a"))
def normalised_values(spark, sf):
    return states(spark, sf)["a"].silver.normal.select("source_row_number", "movement_date", "product", "type", "fund", "amount", "description", "commercial_name")


def _diff_counts(name):
    return lambda spark, sf: states(spark, sf)[name].diff.groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


def _current_after(name):
    return lambda spark, sf: _without_times(states(spark, sf)[name].current).drop("amount_original")


def _history_after(name):
    return lambda spark, sf: _without_times(states(spark, sf)[name].history)


for _n in "abc":
    Q[f"diff_counts_{_n}"], SQL[f"diff_counts_{_n}"] = _diff_counts(_n), _with(f"SELECT change_type, count(*) AS n FROM diff_{_n} GROUP BY change_type", _n)
for _n in "bc":
    Q[f"current_after_{_n}"], SQL[f"current_after_{_n}"] = _current_after(_n), _with("SELECT * FROM cur", _n)
    Q[f"history_after_{_n}"], SQL[f"history_after_{_n}"] = _history_after(_n), _with("SELECT * FROM hist", _n)


@_query(_with("SELECT movement_key, change_type, old_version, new_version, changed_columns FROM diff_c"))
def diff_rows(spark, sf):
    return _without_times(states(spark, sf)["c"].diff.select("movement_key", "change_type", "old_version", "new_version", "changed_columns"))


@_query(_with("SELECT * FROM chg"))
def change_events(spark, sf):
    return _without_times(_all(spark, sf, lambda s: s.changes))


@_query(_with("SELECT * FROM fld"))
def change_field_log(spark, sf):
    return _without_times(_all(spark, sf, lambda s: s.fields))


@_query(_with("SELECT row_number() OVER (ORDER BY run_id, movement_key) AS change_id, run_id, movement_key FROM chg"))
def change_ids(spark, sf):
    """Surrogate ids: dense over all runs, in the order of the keys within a run."""
    return _all(spark, sf, lambda s: s.changes).select("change_id", "run_id", "movement_key")


_PURGED = "SELECT h.movement_key, h.version FROM hist h JOIN (SELECT movement_key, max(version) AS last FROM hist GROUP BY movement_key) l USING (movement_key) WHERE NOT (NOT is_current AND valid_to < DATE '2001-08-08' - 1 AND version <> last)"


@_query(_with(_PURGED))
def retention_purge(spark, sf):
    s = states(spark, sf)["c"]
    return gold.purge(s.history, s.current, datetime(2001, 8, 8).date(), 1)[0].select("movement_key", "version")


def _reconciled(spark, sf) -> DataFrame:
    every = states(spark, sf)
    before, s = every["b"].current, every["c"]
    was = gold.summary(before)
    return checks.reconcile(s.silver.staged, s.silver.rejected, s.diff, s.current, s.history, s.changes, s.fields, s.silver.normal.count(), was["active_rows"], was["amount_total"])


_KINDS = ", ".join(f"count(*) FILTER (WHERE change_type = '{t}') AS {t.lower()}" for t in diff.TYPES)
_RECON = f"""SELECT check_id, CAST(l AS DECIMAL(38,4)) AS left_value, CAST(r AS DECIMAL(38,4)) AS right_value, CAST(l - r AS DECIMAL(38,4)) AS difference, l = r AS passed FROM (
    WITH k AS (SELECT count(*) AS keys, {_KINDS} FROM diff_c)
    SELECT 'R1' AS check_id, CAST((SELECT count(*) FROM norm_c) AS DECIMAL(30,2)) AS l, CAST((SELECT sum(exact_duplicate_count) FROM stg_c) + (SELECT count(*) FROM norm_c WHERE error_code IS NOT NULL) AS DECIMAL(30,2)) AS r
    UNION ALL SELECT 'R2', new + updated + deleted + unchanged + reactivated + still_deleted, keys FROM k
    UNION ALL SELECT 'R3', new + updated + unchanged + reactivated, (SELECT count(*) FROM stg_c) FROM k
    UNION ALL SELECT 'R4', (SELECT count(*) FROM cur_b WHERE is_active) + new + reactivated - deleted, (SELECT count(*) FROM act) FROM k
    UNION ALL SELECT 'R5', (SELECT count(*) FROM stg_c s WHERE NOT EXISTS (SELECT 1 FROM act a WHERE a.movement_key = s.movement_key)), 0
    UNION ALL SELECT 'R6', (SELECT count(*) FROM (SELECT 1 FROM cur GROUP BY movement_key HAVING count(*) > 1)), 0
    UNION ALL SELECT 'R7', (SELECT count(*) FROM (SELECT 1 FROM hist WHERE is_current GROUP BY movement_key HAVING count(*) > 1)), 0
    UNION ALL SELECT 'R8', (SELECT count(*) FROM (SELECT 1 FROM hist GROUP BY movement_key HAVING max(version) - min(version) + 1 <> count(*))), 0
    UNION ALL SELECT 'R9', (SELECT coalesce(sum(amount), 0) FROM cur_b WHERE is_active) + (SELECT coalesce(sum(amount_delta), 0) FROM chg_c), (SELECT coalesce(sum(amount), 0) FROM act)
    UNION ALL SELECT 'R10', (SELECT coalesce(sum(amount), 0) FROM stg_c), (SELECT coalesce(sum(amount), 0) FROM cur WHERE movement_key IN (SELECT movement_key FROM stg_c))
    UNION ALL SELECT 'R11', (SELECT count(*) FROM chg_c), new + updated + deleted + reactivated FROM k
    UNION ALL SELECT 'R12', (SELECT count(*) FROM chg_c WHERE change_type = 'UPDATED' AND movement_key NOT IN (SELECT movement_key FROM fld_c)), 0)"""


@_query(_with(_RECON))
def reconciliation(spark, sf):
    return _reconciled(spark, sf)


@_query(
    "SELECT unnest(['unique_current_row_per_key', 'single_current_version_per_key', 'history_covers_current', 'no_version_gaps', 'active_current_matches_open_version', 'changes_have_events']) AS invariant, CAST(0 AS BIGINT) AS violations"
)
def invariants(spark, sf):
    s = states(spark, sf)["c"]
    return checks.invariants(s.current, s.history, _all(spark, sf, lambda x: x.changes), _all(spark, sf, lambda x: x.fields))


_PLANTED = """, badcur AS MATERIALIZED (SELECT * FROM cur UNION ALL SELECT * FROM cur WHERE movement_key LIKE '0%'),
    badhist AS MATERIALIZED (SELECT * REPLACE (CASE WHEN movement_key LIKE '4%' AND is_current THEN snapshot_date ELSE valid_to END AS valid_to) FROM (
        SELECT * FROM hist WHERE movement_key NOT LIKE '1%' AND NOT (movement_key LIKE '2%' AND version = 2) UNION ALL SELECT * FROM hist WHERE movement_key LIKE '3%' AND is_current)),
    badfld AS (SELECT * FROM fld WHERE movement_key NOT LIKE '5%')"""
_VIOLATED = """ SELECT 'unique_current_row_per_key' AS invariant, count(*) AS violations FROM (SELECT 1 FROM badcur GROUP BY movement_key HAVING count(*) > 1)
    UNION ALL SELECT 'single_current_version_per_key', count(*) FROM (SELECT 1 FROM badhist WHERE is_current GROUP BY movement_key HAVING count(*) > 1)
    UNION ALL SELECT 'history_covers_current', count(*) FROM badcur WHERE movement_key NOT IN (SELECT movement_key FROM badhist)
    UNION ALL SELECT 'no_version_gaps', count(*) FROM (SELECT 1 FROM badhist GROUP BY movement_key HAVING max(version) - min(version) + 1 <> count(*))
    UNION ALL SELECT 'active_current_matches_open_version', count(*) FROM badhist WHERE is_current AND (valid_to IS NOT NULL OR is_deleted) AND movement_key IN (SELECT movement_key FROM badcur WHERE is_active)
    UNION ALL SELECT 'changes_have_events', count(*) FROM chg WHERE change_type = 'UPDATED' AND (run_id, movement_key) NOT IN (SELECT (run_id, movement_key) FROM badfld)"""


@_query(_with("").rstrip() + _PLANTED + _VIOLATED)
def invariants_violated(spark, sf):
    """The six invariants over a state in which each is broken for the keys of one first digit."""
    s, key = states(spark, sf)["c"], F.col("movement_key")
    changes, fields = (_all(spark, sf, f) for f in (lambda x: x.changes, lambda x: x.fields))
    current = s.current.unionByName(s.current.where(key.startswith("0")))
    cut = s.history.where(~key.startswith("1") & ~(key.startswith("2") & (F.col("version") == 2)))
    history = cut.unionByName(s.history.where(key.startswith("3") & F.col("is_current")))
    history = history.withColumn("valid_to", F.when(key.startswith("4") & F.col("is_current"), F.col("snapshot_date")).otherwise(F.col("valid_to")))
    return checks.invariants(current, history, changes, fields.where(~key.startswith("5")))


_RERUN = """, more AS (SELECT run_id, snapshot_date, status, started FROM (SELECT run_id, snapshot_date, status, 0 AS started FROM runs UNION ALL SELECT 'run_b2', snapshot_date, 'SUCCESS', 1 FROM runs WHERE run_id = 'run_b' UNION ALL SELECT 'run_c2', snapshot_date, 'FAILED', 1 FROM runs WHERE run_id = 'run_c')),
    latest AS (SELECT run_id FROM (SELECT run_id, row_number() OVER (PARTITION BY snapshot_date ORDER BY started DESC, run_id DESC) AS n FROM more WHERE status = 'SUCCESS') WHERE n = 1),
    log AS (SELECT run_id, snapshot_date, change_type, amount_delta FROM chg UNION ALL SELECT 'run_b2', snapshot_date, change_type, amount_delta FROM chg WHERE run_id = 'run_b' AND movement_key < '8' UNION ALL SELECT 'run_c2', snapshot_date, change_type, amount_delta FROM chg WHERE run_id = 'run_c')"""


@_query(_with("").rstrip() + _RERUN + " SELECT snapshot_date, change_type, count(*) AS movements, CAST(coalesce(sum(amount_delta), 0) AS DECIMAL(38,2)) AS amount_impact, CAST(coalesce(sum(abs(amount_delta)), 0) AS DECIMAL(38,2)) AS amount_impact_abs FROM log WHERE run_id IN (SELECT run_id FROM latest) GROUP BY ALL")
def v_daily_changes_reruns(spark, sf):
    """Cut b ran twice and the second run counts; a failed second run of cut c does not."""
    known, log = runs(spark, sf), _all(spark, sf, lambda s: s.changes)
    later = F.col("started_at") + F.expr("INTERVAL 1 DAY")

    def again(rows, run, **other):
        return rows.where(F.col("run_id") == run).withColumns({"run_id": F.lit(run + "2"), **other})

    more = known.unionByName(again(known, "run_b", started_at=later)).unionByName(again(known, "run_c", started_at=later, status=F.lit("FAILED")))
    log = log.unionByName(again(log.where("movement_key < '8'"), "run_b")).unionByName(again(log, "run_c"))
    return views.daily_changes(log, more)


@_query(
    _with("""SELECT deleted / active AS deletion_rate, greatest(0.0, (was - valid) / was) AS volume_drop, abs(after - before) / abs(before) AS amount_variation FROM (SELECT
        CAST((SELECT count(*) FROM diff_b WHERE change_type = 'DELETED') AS DOUBLE) AS deleted, CAST((SELECT count(*) FROM cur_a WHERE is_active) AS DOUBLE) AS active, CAST((SELECT count(*) FROM stg_a) AS DOUBLE) AS was, CAST((SELECT count(*) FROM stg_b) AS DOUBLE) AS valid,
        CAST((SELECT sum(amount) FROM stg_b) AS DOUBLE) AS after, CAST((SELECT sum(amount) FROM cur_a WHERE is_active) AS DOUBLE) AS before)""", "b")
)
def guard_ratios(spark, sf):
    every = states(spark, sf)
    a, b = every["a"], every["b"]
    was, valid = gold.summary(a.current), b.silver.staged.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")).first()
    found = guards.ratios(diff.counts(b.diff), valid["n"], was["active_rows"], a.silver.staged.count(), was["amount_total"], valid["amount"])
    return spark.createDataFrame([(found["HIGH_DELETION_RATE"], found["VOLUME_DROP"], found["AMOUNT_VARIATION"])], "deletion_rate double, volume_drop double, amount_variation double")


# ---- views

_SUMS = "count(*) AS movements, count(DISTINCT id_cliente) AS clients, CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) AS amount_total, CAST(coalesce(sum(amount) FILTER (WHERE type = 'IN'), 0) AS DECIMAL(38,2)) AS amount_in, CAST(coalesce(sum(amount) FILTER (WHERE type = 'OUT'), 0) AS DECIMAL(38,2)) AS amount_out"
_NET = ", CAST(coalesce(sum(amount) FILTER (WHERE type = 'IN'), 0) - coalesce(sum(amount) FILTER (WHERE type = 'OUT'), 0) AS DECIMAL(38,2)) AS net_flow"
_AVG = ", coalesce(CAST(sum(amount) AS DOUBLE) / count(amount), 0) AS avg_amount"


@_query(_with("SELECT * FROM act"))
def v_movements_active(spark, sf):
    return _without_times(views.movements_active(states(spark, sf)["c"].current)).drop("amount_original")


@_query(
    _with(f"""SELECT d.*, movement_date = last AND movements < usual * 0.5 AS is_partial FROM (SELECT movement_date, count(*) AS movements, count(DISTINCT id_cliente) AS clients,
        CAST(coalesce(sum(amount) FILTER (WHERE type = 'IN'), 0) AS DECIMAL(38,2)) AS amount_in, CAST(coalesce(sum(amount) FILTER (WHERE type = 'OUT'), 0) AS DECIMAL(38,2)) AS amount_out{_NET},
        count(*) FILTER (WHERE type = 'IN') AS movements_in, count(*) FILTER (WHERE type = 'OUT') AS movements_out{_AVG}, coalesce(median(CAST(amount AS DOUBLE)), 0) AS median_amount FROM act GROUP BY movement_date) d,
        (SELECT median(n) AS usual, max(movement_date) AS last FROM (SELECT movement_date, count(*) AS n FROM act GROUP BY movement_date))""")
)
def v_daily_movements(spark, sf):
    return views.daily_movements(states(spark, sf)["c"].current)


@_query(_with("SELECT snapshot_date, change_type, count(*) AS movements, CAST(coalesce(sum(amount_delta), 0) AS DECIMAL(38,2)) AS amount_impact, CAST(coalesce(sum(abs(amount_delta)), 0) AS DECIMAL(38,2)) AS amount_impact_abs FROM chg GROUP BY ALL"))
def v_daily_changes(spark, sf):
    return views.daily_changes(_all(spark, sf, lambda s: s.changes), runs(spark, sf))


@_query(_with("SELECT snapshot_date, run_id, status, input_file, rows_read, rows_valid, rows_rejected, rows_rejected / CAST(rows_read AS DOUBLE) AS rejection_rate, rows_new, rows_updated, rows_deleted, rows_unchanged, rows_reactivated, rows_updated / CAST(rows_new + rows_updated + rows_unchanged + rows_reactivated AS DOUBLE) AS updated_rate, rows_current_after, amount_current, duration_seconds FROM runs"))
def v_snapshot_summary(spark, sf):
    return views.snapshot_summary(runs(spark, sf))


@_query(_with(f"SELECT fund, {_SUMS}{_NET}{_AVG} FROM act GROUP BY fund"))
def v_summary_by_fund(spark, sf):
    return views.summary_by_fund(states(spark, sf)["c"].current)


@_query(_with(f"SELECT product, {_SUMS}{_NET}{_AVG} FROM act GROUP BY product"))
def v_summary_by_product(spark, sf):
    return views.summary_by_product(states(spark, sf)["c"].current)


@_query(_with(f"SELECT coalesce(commercial_name, '{views.NO_COMMERCIAL_NAME}') AS commercial_name, {_SUMS}{_AVG} FROM act GROUP BY 1"))
def v_summary_by_commercial(spark, sf):
    return views.summary_by_commercial(states(spark, sf)["c"].current)


@_query(_with(f"SELECT type, count(*) AS movements, CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) AS amount_total{_AVG}, min(amount) AS min_amount, max(amount) AS max_amount, count(*) FILTER (WHERE amount < 0) AS negative_amounts, count(*) FILTER (WHERE amount = 0) AS zero_amounts FROM act GROUP BY type"))
def v_summary_by_type(spark, sf):
    return views.summary_by_type(states(spark, sf)["c"].current)


@_query(_with("SELECT g.*, m.id_cliente, m.movement_date, m.product, m.type, m.fund, m.commercial_name, m.is_active, m.source_file FROM chg g LEFT JOIN cur m USING (movement_key)"))
def v_change_detail(spark, sf):
    return _without_times(views.change_detail(_all(spark, sf, lambda s: s.changes), states(spark, sf)["c"].current))


@_query(_with("SELECT f.movement_key, f.column_name, f.old_value, f.new_value, g.change_type, g.snapshot_date, g.run_id FROM fld f JOIN chg g USING (run_id, movement_key)"))
def v_change_fields(spark, sf):
    return _without_times(views.change_fields(_all(spark, sf, lambda s: s.fields), _all(spark, sf, lambda s: s.changes)))


@_query(_with("SELECT column_name, count(*) AS changes, count(DISTINCT movement_key) AS movements_affected FROM fld GROUP BY column_name"))
def v_field_change_frequency(spark, sf):
    return views.field_change_frequency(_all(spark, sf, lambda s: s.fields))


@_query(_with("SELECT run_id, snapshot_date, rows_read, rows_valid, rows_rejected, rows_exact_dupes, rows_valid / CAST(rows_read AS DOUBLE) AS valid_rate, rows_rejected / CAST(rows_read AS DOUBLE) AS rejection_rate FROM runs"))
def v_quality_by_run(spark, sf):
    return views.quality_by_run(runs(spark, sf))


_REJECTED = " UNION ALL ".join(f"SELECT 'run_{n}' AS run_id, DATE '{testdata.DATES[n]}' AS snapshot_date, error_code FROM norm_{n} WHERE error_code IS NOT NULL" for n in "abc")


@_query(_with(f"SELECT run_id, snapshot_date, error_code, 'RECORD_ERROR' AS error_severity, count(*) AS rows_rejected FROM ({_REJECTED}) GROUP BY ALL"))
def v_rejections_by_code(spark, sf):
    return views.rejections_by_code(_all(spark, sf, lambda s: s.silver.rejected))


_INFO = "('NEGATIVE_AMOUNT', 'ZERO_AMOUNT', 'NULL_DESCRIPTION', 'NULL_COMMERCIAL_NAME')"
_FLAG_COLUMNS = "CASE flag_code WHEN 'INVALID_ID_FORMAT' THEN 'id_cliente' WHEN 'UNKNOWN_PRODUCT' THEN 'product' WHEN 'UNKNOWN_FUND' THEN 'fund' WHEN 'DATE_OUT_OF_RANGE' THEN 'date' WHEN 'NULL_DESCRIPTION' THEN 'description' WHEN 'NULL_COMMERCIAL_NAME' THEN 'commercial_name' WHEN 'KEY_AMBIGUOUS' THEN 'movement_key' ELSE 'amount' END"
_FLAGS = "(SELECT run_id, snapshot_date, unnest(string_split(quality_flags, ',')) AS flag_code FROM stg WHERE quality_flags <> '')"


@_query(_with(f"SELECT run_id, snapshot_date, flag_code, CASE WHEN flag_code IN {_INFO} THEN 'INFO' ELSE 'WARNING' END AS severity, {_FLAG_COLUMNS} AS column_name, count(*) AS occurrences FROM {_FLAGS} GROUP BY ALL"))
def v_quality_flags_summary(spark, sf):
    return views.quality_flags_summary(_all(spark, sf, lambda s: s.silver.flags))


@_query(_with("SELECT movement_key, id_cliente, movement_date, product, fund, type, amount, description, commercial_name FROM act ORDER BY abs(amount) DESC NULLS LAST, movement_key LIMIT 200"))
def v_top_movements(spark, sf):
    return views.top_movements(states(spark, sf)["c"].current, 200)


@_query(_with("SELECT g.snapshot_date, g.change_type, g.movement_key, g.amount_before, g.amount_after, g.amount_delta, m.id_cliente, m.fund, m.product, m.type, m.commercial_name FROM chg g LEFT JOIN cur m USING (movement_key) ORDER BY abs(amount_delta) DESC NULLS LAST, movement_key, g.snapshot_date LIMIT 200"))
def v_top_changes_by_impact(spark, sf):
    return _without_times(views.top_changes_by_impact(_all(spark, sf, lambda s: s.changes), states(spark, sf)["c"].current, 200))


# ---- anomalies

_CUT_DOWN = "CAST(floor(quantile_cont(CAST(round(amount * 100) AS BIGINT), {}) ) / 100 AS DECIMAL(20,2))"


def _last():
    return F.lit("run_c"), F.lit(testdata.DATES["c"]).cast("date")


@_query(
    _with(f"""SELECT m.movement_key, CAST(m.amount AS DOUBLE) AS observed, CAST(q1 + q3 AS DOUBLE) / 2 AS expected FROM act m JOIN (SELECT fund, type, {_CUT_DOWN.format(0.25)} AS q1, {_CUT_DOWN.format(0.75)} AS q3 FROM act GROUP BY fund, type) b USING (fund, type)
        WHERE q3 > q1 AND (CAST(amount AS DOUBLE) < CAST(q1 AS DOUBLE) - 0.8 * CAST(q3 - q1 AS DOUBLE) OR CAST(amount AS DOUBLE) > CAST(q3 AS DOUBLE) + 0.8 * CAST(q3 - q1 AS DOUBLE))""")
)
def anom_amount_outlier(spark, sf):
    rows = anomalies.amount_outliers(states(spark, sf)["c"].current, _last(), 0.8)
    return rows.select(F.col("entity_id").alias("movement_key"), "observed", "expected")


_SCALED = "(SELECT * REPLACE (CAST(CASE WHEN movement_key LIKE '00%' THEN amount * 1000 ELSE amount END AS DECIMAL(20,2)) AS amount) FROM act)"


@_query(
    _with(f"""SELECT m.movement_key, CAST(m.amount AS DOUBLE) AS observed, CAST(q1 + q3 AS DOUBLE) / 2 AS expected FROM {_SCALED} m JOIN (SELECT fund, type, {_CUT_DOWN.format(0.25)} AS q1, {_CUT_DOWN.format(0.75)} AS q3 FROM {_SCALED} GROUP BY fund, type) b USING (fund, type)
        WHERE q3 > q1 AND (CAST(amount AS DOUBLE) < CAST(q1 AS DOUBLE) - 3.0 * CAST(q3 - q1 AS DOUBLE) OR CAST(amount AS DOUBLE) > CAST(q3 AS DOUBLE) + 3.0 * CAST(q3 - q1 AS DOUBLE))""")
)
def anom_amount_outlier_default(spark, sf):
    """The default fence, over a state with amounts planted beyond it."""
    money = F.when(F.col("movement_key").startswith("00"), F.col("amount") * 1000).otherwise(F.col("amount")).cast(S.contract.amount_type)
    rows = anomalies.amount_outliers(states(spark, sf)["c"].current.withColumn("amount", money), _last(), S.iqr_multiplier)
    return rows.select(F.col("entity_id").alias("movement_key"), "observed", "expected")


@_query(_with(f"SELECT run_id, snapshot_date, flag_code AS entity_id, CAST(count(*) AS DOUBLE) AS observed FROM {_FLAGS} WHERE flag_code IN ('UNKNOWN_FUND', 'UNKNOWN_PRODUCT') GROUP BY ALL"))
def anom_new_category(spark, sf):
    return anomalies.new_categories(_all(spark, sf, lambda s: s.silver.flags)).select("run_id", "snapshot_date", "entity_id", "observed")


@_query(_with("SELECT CAST(movement_date AS VARCHAR) AS entity_id, CAST(n AS DOUBLE) AS observed, round(mu, 6) AS expected FROM (SELECT movement_date, count(*) AS n FROM act GROUP BY movement_date), (SELECT avg(n) AS mu, stddev_samp(n) AS sd FROM (SELECT count(*) AS n FROM act GROUP BY movement_date)) WHERE sd > 0 AND abs((n - mu) / sd) >= 2"))
def anom_daily_volume(spark, sf):
    return anomalies.volume_outliers(states(spark, sf)["c"].current, _last(), 2.0).select("entity_id", "observed", F.round("expected", 6).alias("expected"))


@_query(_with("SELECT run_id, rows_deleted / CAST(rows_current_before AS DOUBLE) AS observed FROM runs WHERE rows_current_before > 0 AND rows_deleted / CAST(rows_current_before AS DOUBLE) >= 0.1"))
def anom_deletion_share(spark, sf):
    return anomalies.deletion_shares(runs(spark, sf), 0.1).select("run_id", "observed")


@_query(_with("SELECT type AS entity_id, count(*) FILTER (WHERE amount < 0) / CAST(count(*) AS DOUBLE) AS observed FROM act GROUP BY type HAVING count(*) FILTER (WHERE amount < 0) > 0"))
def anom_negative_amount(spark, sf):
    return anomalies.negative_amounts(states(spark, sf)["c"].current, _last()).select("entity_id", "observed")


# ---- profile

_KEY = "id_raw, movement_date, product, fund, type"


_TOTALS = """SELECT count(*) AS rows, count(DISTINCT id_raw) AS distinct_id_cliente, count(*) FILTER (WHERE id_raw IS NULL) AS null_id, count(*) FILTER (WHERE trim(coalesce(id_raw, '')) = '') AS empty_id, count(*) FILTER (WHERE movement_date IS NULL) AS unparseable_date,
        min(movement_date) AS date_min, max(movement_date) AS date_max, count(DISTINCT movement_date) AS distinct_dates, count(*) FILTER (WHERE amount_raw IS NULL) AS null_amount, CAST(0 AS BIGINT) AS invalid_amount_format,
        count(*) FILTER (WHERE amount_raw IS NOT NULL AND amount IS NULL) AS amount_out_of_range, CAST(0 AS BIGINT) AS non_finite_amount, count(*) FILTER (WHERE amount_raw < 0) AS negative_amount, count(*) FILTER (WHERE amount_raw = 0) AS zero_amount,
        min(amount_raw) AS amount_min, max(amount_raw) AS amount_max, count(*) FILTER (WHERE type IS NULL) AS unmappable_type, count(DISTINCT type_raw) AS distinct_type_raw, count(DISTINCT fund_raw) AS distinct_fund_raw, count(DISTINCT fund) AS distinct_fund_norm,
        count(*) FILTER (WHERE fund_raw <> trim(fund_raw)) AS fund_with_outer_spaces, count(*) FILTER (WHERE regexp_matches(fund_raw, '\\s\\s')) AS fund_with_double_spaces FROM norm_a"""


@_query(_with(_TOTALS, "a"))
def prof_summary(spark, sf):
    return profile.summary(states(spark, sf)["a"].silver.normal).drop("amount_avg")


@_query(
    _with(f"""SELECT (SELECT count(*) FROM (SELECT 1 FROM norm_a GROUP BY id_raw, date_raw, product_raw, type_raw, fund_raw, amount_raw, description_raw, commercial_name_raw HAVING count(*) > 1)) AS exact_dup_groups,
        (SELECT count(*) FROM (SELECT 1 FROM norm_a GROUP BY id_raw HAVING count(*) > 1)) AS id_cliente_repeated, count(DISTINCT (id_raw, movement_date)) AS k_id_date, count(DISTINCT (id_raw, movement_date, product)) AS k_id_date_prod,
        count(DISTINCT (id_raw, movement_date, product, fund)) AS k4, count(DISTINCT ({_KEY})) AS k5, count(*) AS rows, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM norm_a GROUP BY {_KEY} HAVING count(*) > 1)) AS k5_collision_rows,
        count(DISTINCT ({_KEY})) / CAST(count(*) AS DOUBLE) AS k5_uniqueness FROM norm_a""", "a")
)
def prof_duplicates(spark, sf):
    return profile.duplicates(states(spark, sf)["a"].silver.normal)


_COLUMNS = " UNION ALL ".join(f"SELECT '{n}' AS \"column\", count(*) FILTER (WHERE {r} IS NULL) AS nulls, count(*) FILTER (WHERE {r} IS NULL) / CAST(count(*) AS DOUBLE) AS null_pct, count(DISTINCT {r}) AS distinct_values FROM norm_a" for n, r in (("id_cliente", "id_raw"), ("date", "date_raw"), ("product", "product_raw"), ("type", "type_raw"), ("fund", "fund_raw"), ("amount", "amount_raw"), ("description", "description_raw"), ("commercial_name", "commercial_name_raw")))


@_query(_with(_COLUMNS, "a"))
def prof_columns(spark, sf):
    return profile.columns(states(spark, sf)["a"].silver.normal)


_CATEGORIES = " UNION ALL ".join(f"SELECT * FROM (SELECT '{n}' AS \"column\", {n}_raw AS value, count(*) AS rows FROM norm_a GROUP BY 2 ORDER BY rows DESC, value NULLS LAST LIMIT 60)" for n in profile.CATEGORICAL)


@_query(_with(_CATEGORIES, "a"))
def prof_categoricals(spark, sf):
    return profile.categories(states(spark, sf)["a"].silver.normal)


_QUALITY = " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", CAST({column} AS BIGINT) AS observed, {column} / CAST(rows AS DOUBLE) AS pct_of_rows, CASE WHEN {column} > 0 THEN '{found}' ELSE '{none}' END AS severity FROM totals"
    for name, (column, found, none) in profile.QUALITY.items()
)


@_query(_with("", "a").rstrip() + f", totals AS ({_TOTALS}) {_QUALITY}")
def prof_quality(spark, sf):
    return profile.quality(states(spark, sf)["a"].silver.normal)


_SIDES = "".join(f", k{n} AS (SELECT DISTINCT {_KEY} FROM norm_{n})" for n in "ab")
_MATCH = " AND ".join(f"x.{c} = y.{c}" for c in _KEY.split(", "))


@_query(
    _with("", "b").rstrip() + _SIDES + f""" SELECT (SELECT count(*) FROM norm_a) AS rows_a, (SELECT count(*) FROM norm_b) AS rows_b, (SELECT count(*) FROM ka) AS keys_a, (SELECT count(*) FROM kb) AS keys_b,
        (SELECT count(*) FROM ka x WHERE EXISTS (SELECT 1 FROM kb y WHERE {_MATCH})) AS keys_both, (SELECT count(*) FROM ka x WHERE NOT EXISTS (SELECT 1 FROM kb y WHERE {_MATCH})) AS keys_only_a,
        (SELECT count(*) FROM kb x WHERE NOT EXISTS (SELECT 1 FROM ka y WHERE {_MATCH})) AS keys_only_b"""
)
def prof_compare(spark, sf):
    every = states(spark, sf)
    return profile.compare(every["a"].silver.normal, every["b"].silver.normal)


# ---- explorer and reports


@_query(_with("SELECT count(*) FILTER (WHERE is_active) AS active, count(*) FILTER (WHERE NOT is_active) AS inactive, CAST(coalesce(sum(amount) FILTER (WHERE is_active), 0) AS DECIMAL(38,2)) AS amount, count(DISTINCT id_cliente) FILTER (WHERE is_active) AS clients FROM cur"))
def exp_totals(spark, sf):
    return explore.totals(states(spark, sf)["c"].current)


@_query(_with("SELECT CASE WHEN amount < 0 THEN '1. negativo' WHEN amount = 0 THEN '2. cero' WHEN amount < 1000000 THEN '3. < 1M' WHEN amount < 10000000 THEN '4. 1M - 10M' WHEN amount < 25000000 THEN '5. 10M - 25M' ELSE '6. >= 25M' END AS band, count(*) AS movements, CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) AS amount_total FROM act GROUP BY 1"))
def exp_amount_bands(spark, sf):
    return explore.amount_bands(states(spark, sf)["c"].current)


@_query(_with("SELECT snapshot_date, count(*) FILTER (WHERE change_type = 'NEW') AS \"NEW\", count(*) FILTER (WHERE change_type = 'UPDATED') AS \"UPDATED\", count(*) FILTER (WHERE change_type = 'DELETED') AS \"DELETED\", count(*) FILTER (WHERE change_type = 'REACTIVATED') AS \"REACTIVATED\" FROM chg GROUP BY snapshot_date"))
def exp_changes_by_type(spark, sf):
    return explore.changes_by_type(_all(spark, sf, lambda s: s.changes), runs(spark, sf))


_FOUND = "FROM chg g LEFT JOIN cur m USING (movement_key) WHERE change_type IN ('UPDATED', 'DELETED') AND m.fund IN ('Renta Fija', 'Balanceado') AND m.type IN ('IN') AND abs(coalesce(amount_delta, 0)) BETWEEN 1 AND 200000 ORDER BY abs(coalesce(amount_delta, 0)) DESC, movement_key, g.snapshot_date LIMIT 500"


def _found(spark, sf):
    return explore.find_changes(_all(spark, sf, lambda s: s.changes), states(spark, sf)["c"].current, types=["UPDATED", "DELETED"], funds=["Renta Fija", "Balanceado"], directions=["IN"], impact=(1, 200000))


@_query(_with(f"SELECT g.movement_key, g.snapshot_date, g.change_type, g.amount_delta, m.fund {_FOUND}"))
def exp_change_filter(spark, sf):
    return _found(spark, sf).select("movement_key", "snapshot_date", "change_type", "amount_delta", "fund")


@_query(_with(f"SELECT f.movement_key, f.column_name, f.old_value, f.new_value FROM fld f JOIN (SELECT g.run_id, g.movement_key {_FOUND}) x USING (run_id, movement_key)"))
def exp_change_fields(spark, sf):
    return explore.fields_of(_found(spark, sf), _all(spark, sf, lambda s: s.fields)).select("movement_key", "column_name", "old_value", "new_value")


@_query(_with("SELECT g.movement_key, g.snapshot_date, g.amount_before, g.amount_delta, m.id_cliente, m.fund, m.product FROM chg g LEFT JOIN cur m USING (movement_key) WHERE g.change_type = 'DELETED'"))
def exp_deleted_with_amount(spark, sf):
    return explore.deleted_with_amount(_all(spark, sf, lambda s: s.changes), states(spark, sf)["c"].current)



_LATEST = "(SELECT CAST(coalesce(sum(rows_new), 0) AS BIGINT) AS rows_new, CAST(coalesce(sum(rows_updated), 0) AS BIGINT) AS rows_updated, CAST(coalesce(sum(rows_deleted), 0) AS BIGINT) AS rows_deleted, CAST(coalesce(sum(rows_rejected), 0) AS BIGINT) AS rows_rejected, count(*) AS cuts FROM runs)"


@_query(_with(f"SELECT * FROM (SELECT {_SUMS}{_NET} FROM act), {_LATEST}"))
def exp_overview(spark, sf):
    return explore.overview(states(spark, sf)["c"].current, runs(spark, sf))


@_query(_with("SELECT CAST(sum(rows_read) AS BIGINT) AS rows_read, CAST(sum(rows_valid) AS BIGINT) AS rows_valid, CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected, round(avg(rows_rejected / CAST(rows_read AS DOUBLE)), 9) AS mean_rejection_rate FROM runs"))
def exp_quality_totals(spark, sf):
    rate = F.round("mean_rejection_rate", 9)
    return explore.quality_totals(runs(spark, sf)).withColumn("mean_rejection_rate", rate)


@_query(_with(f"SELECT error_code, 'RECORD_ERROR' AS error_severity, count(*) AS rows FROM ({_REJECTED}) GROUP BY ALL"))
def exp_rejections(spark, sf):
    return explore.rejections(_all(spark, sf, lambda s: s.silver.rejected))


@_query(_with(f"SELECT flag_code, CASE WHEN flag_code IN {_INFO} THEN 'INFO' ELSE 'WARNING' END AS severity, {_FLAG_COLUMNS} AS column_name, count(*) AS occurrences FROM {_FLAGS} GROUP BY ALL"))
def exp_flags(spark, sf):
    return explore.flags(_all(spark, sf, lambda s: s.silver.flags))


_REFUSED = " UNION ALL ".join(f"SELECT DATE '{testdata.DATES[n]}' AS snapshot_date, source_row_number, id_raw, error_code FROM norm_{n} WHERE error_code IS NOT NULL" for n in "abc")


@_query(_with(f"SELECT snapshot_date, source_row_number, id_raw AS id_cliente, error_code FROM ({_REFUSED}) ORDER BY snapshot_date, source_row_number LIMIT 200"))
def exp_quarantine(spark, sf):
    rows = explore.quarantine(_all(spark, sf, lambda s: s.silver.rejected))
    return rows.select("snapshot_date", "source_row_number", "id_cliente", "error_code")


@_query(_with(f"SELECT snapshot_date, error_code, count(*) AS rows, arg_min(coalesce(id_raw, '?'), source_row_number) AS example FROM ({_REFUSED}) GROUP BY ALL"))
def exp_quarantine_examples(spark, sf):
    """Of the example, which holds the whole row, the client is compared."""
    rows = explore.quarantine_examples(_all(spark, sf, lambda s: s.silver.rejected))
    return rows.withColumn("example", F.coalesce(F.get_json_object("example", "$.id_cliente"), F.lit("?")))


@_query(_with(f"SELECT 'run_c' AS run_id, * FROM ({_RECON})"))
def exp_last_checks(spark, sf):
    """Checks of the last successful run, beside those of an earlier and of a later, failed one."""
    labels = spark.createDataFrame([(k, group, name) for k, (group, name, *_) in checks.CHECKS.items()], "check_id string, check_group string, check_name string")
    one = _reconciled(spark, sf).join(F.broadcast(labels), "check_id")  # twelve rows
    names = F.explode(F.array(*map(F.lit, ("run_b", "run_c", "run_d"))))
    known = runs(spark, sf)
    failed = known.where("run_id = 'run_c'").withColumns({"run_id": F.lit("run_d"), "status": F.lit("FAILED"), "started_at": F.col("started_at") + F.expr("INTERVAL 1 DAY")})
    found = explore.last_checks(one.withColumn("run_id", names), known.unionByName(failed))
    return found.select("run_id", "check_id", "left_value", "right_value", "difference", "passed")


@_query(
    _with(f"""SELECT category, anomaly_code, count(*) AS cases FROM (
        SELECT 'OUTLIER' AS category, 'AMOUNT_OUTLIER' AS anomaly_code FROM act m JOIN (SELECT fund, type, {_CUT_DOWN.format(0.25)} AS q1, {_CUT_DOWN.format(0.75)} AS q3 FROM act GROUP BY fund, type) b USING (fund, type)
            WHERE q3 > q1 AND (CAST(amount AS DOUBLE) < CAST(q1 AS DOUBLE) - 3.0 * CAST(q3 - q1 AS DOUBLE) OR CAST(amount AS DOUBLE) > CAST(q3 AS DOUBLE) + 3.0 * CAST(q3 - q1 AS DOUBLE))
        UNION ALL SELECT 'QUALITY', 'NEW_CATEGORY_VALUE' FROM (SELECT DISTINCT run_id, flag_code FROM {_FLAGS} WHERE flag_code IN ('UNKNOWN_FUND', 'UNKNOWN_PRODUCT'))
        UNION ALL SELECT 'REVIEW', 'DAILY_VOLUME_OUTLIER' FROM (SELECT count(*) AS n FROM act GROUP BY movement_date), (SELECT avg(n) AS mu, stddev_samp(n) AS sd FROM (SELECT count(*) AS n FROM act GROUP BY movement_date)) WHERE sd > 0 AND abs((n - mu) / sd) >= 3
        UNION ALL SELECT 'CHANGE', 'HIGH_DELETION_SHARE' FROM runs WHERE rows_current_before > 0 AND rows_deleted / CAST(rows_current_before AS DOUBLE) >= 0.1
        UNION ALL SELECT 'BUSINESS_RULE', 'NEGATIVE_AMOUNT_CONCENTRATION' FROM (SELECT type FROM act WHERE amount < 0 GROUP BY type)) GROUP BY ALL""")
)
def exp_anomaly_counts(spark, sf):
    """All five detectors with the default settings."""
    return explore.anomaly_counts(anomalies.detect(states(spark, sf)["c"].current, _all(spark, sf, lambda s: s.silver.flags), runs(spark, sf), S))


@_query(_with("SELECT movement_key, id_cliente, fund, product, amount FROM cur WHERE NOT is_active"))
def exp_ended(spark, sf):
    return explore.ended(states(spark, sf)["c"].current).drop("deleted_at")


_DIM = "count(*) AS movements, CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) AS amount_total, CAST(coalesce(sum(amount) FILTER (WHERE type = 'IN'), 0) AS DECIMAL(38,2)) AS amount_in, CAST(coalesce(sum(amount) FILTER (WHERE type = 'OUT'), 0) AS DECIMAL(38,2)) AS amount_out"


@_query(
    _with(" UNION ALL ".join([f"SELECT '{d}' AS dimension, {c} AS value, {_DIM}{_NET} FROM act GROUP BY {c}" for d, c in (("fund", "fund"), ("product", "product"), ("commercial_name", f"coalesce(commercial_name, '{views.NO_COMMERCIAL_NAME}')"))] + ["SELECT 'type', type, count(*), CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)), NULL, NULL, NULL FROM act GROUP BY type"]))
)
def rep_financial_summary(spark, sf):
    return views.financial_summary(states(spark, sf)["c"].current)


@_query(_with(" UNION ALL ".join(f"SELECT '{d}' AS dimension, {c} AS value, {_DIM} FROM act GROUP BY {c}" for d, c in (("type", "type"), ("fund", "fund"), ("product", "product"), ("commercial_name", "coalesce(commercial_name, '(sin nombre)')")))))
def rep_aggregates_by_dimension(spark, sf):
    return views.aggregates_by_dimension(states(spark, sf)["c"].current)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by kind of change of the second cut against the first."""
    return Q["diff_counts_b"](spark, sf_dir)


