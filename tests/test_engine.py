"""Silver, diff, gold and the runner over small snapshots."""

import datetime as dt
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerly.config import ConfigError, Settings, load
from ledgerly.operators import diff, guards, silver
from ledgerly.plans import reports
from ledgerly.plans.runner import GUARDED, Runner
from ledgerly.plans.store import Store, StoreError
from ledgerly.sources import snapshots

DAY = dt.date(2024, 10, 15)
BASE = {"id_cliente": "CLI000001", "date": "2024-09-15", "product": "Bonos", "type": "entrada", "fund": "Renta Fija", "amount": 100.0, "description": "Deposito inicial", "commercial_name": "Bancolombia"}
SCHEMA = pa.schema([(c, pa.float64() if c == "amount" else pa.string()) for c in BASE])


def row(**more):
    return {**BASE, **more}


def raw(spark, rows):
    kinds = ", ".join(f"{c} {'double' if c == 'amount' else 'string'}" for c in BASE)
    return spark.createDataFrame([tuple(r[c] for c in BASE) for r in rows], kinds)


def save(path, rows):
    pq.write_table(pa.Table.from_pylist(rows, schema=SCHEMA), path)
    return str(path)


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"id_cliente": None}, "NULL_ID"),
        ({"id_cliente": "   "}, "EMPTY_ID"),
        ({"date": None}, "NULL_DATE"),
        ({"date": "2024-13-45"}, "INVALID_DATE"),
        ({"product": " "}, "NULL_PRODUCT"),
        ({"type": None}, "NULL_TYPE"),
        ({"type": "transferencia"}, "UNKNOWN_TYPE"),
        ({"fund": None}, "NULL_FUND"),
        ({"amount": None}, "NULL_AMOUNT"),
        ({"amount": float("inf")}, "NON_FINITE_AMOUNT"),
        ({"amount": float("nan")}, "NON_FINITE_AMOUNT"),
        ({"amount": 1e30}, "AMOUNT_OUT_OF_RANGE"),
    ],
)
def test_rejections(spark, change, code):
    found = silver.build(raw(spark, [row(**change)]), Settings(), silver.Cut("r", DAY))
    assert [r["error_code"] for r in found.rejected.collect()] == [code]
    assert found.staged.count() == 0


def test_text_amounts_dates_and_spellings(spark):
    rows = raw(spark, [row(amount=None)]).drop("amount").withColumn("amount", F.explode(F.array(*map(F.lit, ["1.234,56", "1234.56", "1_000"]))))
    n = silver.normalise(rows, Settings(), DAY).select("amount_text", "error_code", F.col("amount").cast("string").alias("a")).collect()
    assert {r["amount_text"]: (r["error_code"], r["a"]) for r in n} == {"1.234,56": ("INVALID_AMOUNT_FORMAT", None), "1234.56": (None, "1234.56"), "1_000": ("INVALID_AMOUNT_FORMAT", None)}
    spelled = [row(date="15/09/2024", type="IN ", fund=" renta  fija ")]
    assert silver.normalise(raw(spark, spelled), Settings(), DAY).select("movement_date", "type", "fund").first() == (dt.date(2024, 9, 15), "IN", "Renta Fija")


def test_duplicates_and_ordinals(spark):
    staged = silver.build(raw(spark, [row(), row(), row(amount=200.0)]), Settings(), silver.Cut("r", DAY)).staged.orderBy("amount").collect()
    assert [(r["occurrence_ordinal"], r["exact_duplicate_count"], r["is_key_ambiguous"]) for r in staged] == [(1, 2, True), (2, 1, True)]
    assert all("KEY_AMBIGUOUS" in r["quality_flags"] and r["validation_status"] == "VALID" for r in staged)


def test_flags(spark):
    staged = silver.build(raw(spark, [row(id_cliente="X-1", amount=-5.0, fund="Fondo Nuevo 2026", date="2024-10-17", description=None)]), Settings(), silver.Cut("r", DAY)).staged.first()
    assert staged["quality_flags"] == ["INVALID_ID_FORMAT", "UNKNOWN_FUND", "DATE_OUT_OF_RANGE", "NEGATIVE_AMOUNT", "NULL_DESCRIPTION"]


def test_empty_snapshot(spark):
    found = silver.build(raw(spark, []), Settings(), silver.Cut("r", DAY))
    assert found.staged.count() == found.rejected.count() == found.flags.count() == 0


def test_settings():
    assert load(environ={"LEDGERLY__DELETED__FAIL": "0.4", "LEDGERLY__GUARDS": "false"}).deleted.fail == 0.4
    with pytest.raises(ConfigError):
        load(environ={"LEDGERLY__NOPE": "1"})
    with pytest.raises(ConfigError):
        Settings(on_breach="skip_deletes")


def test_guards_below_scale_ignore_policy():
    assert not guards.evaluate(Settings(on_breach="warn_only"), {}, 0, 0, None, None, None).passed
    found = guards.evaluate(Settings(), {"DELETED": 40}, 100, 100, 140, None, None)
    assert not found.passed and found.breaches == ["HIGH_DELETION_RATE=0.4000"]
    assert guards.evaluate(Settings(on_breach="warn_only"), {"DELETED": 40}, 100, 100, 140, None, None).passed


def ids(numbers, **more):
    return [row(id_cliente=f"CLI{n:06d}", amount=float(a), **more) for n, a in numbers.items()]


def test_three_cuts(spark, tmp_path):
    r = Runner(spark, f"file://{tmp_path}/store")
    (tmp_path / "in").mkdir()
    cuts = [{1: 100, 2: 200, 3: 300}, {1: 100, 2: 275, 4: 400}, {1: 100, 2: 275, 3: 300}]
    for i, c in enumerate(cuts):
        save(tmp_path / f"in/m_2024-10-{15 + i}.parquet", ids(c))
    done = r.run(f"file://{tmp_path}/in")
    assert [x.exit_code for x in done] == [0, 0, 0], [x.reason for x in done]
    assert {k: v for k, v in done[1].counts.items() if v} == {"NEW": 1, "UPDATED": 1, "DELETED": 1, "UNCHANGED": 1}
    assert done[2].counts["REACTIVATED"] == 1 and done[2].counts["DELETED"] == 1
    versions = r.history().groupBy("movement_key").count().agg(F.sum("count"), F.max("count")).first()
    assert tuple(versions) == (6, 2)
    assert r.gold.read("reconciliation_results").where("NOT passed").count() == 0
    fields = r.gold.read("movement_change_fields").select("column_name", "old_value", "new_value").collect()
    assert [tuple(f) for f in fields] == [("amount", "200.00", "275.00")]
    # the same content for the same date is skipped, an older cut is refused
    again = r.run(f"file://{tmp_path}/in/m_2024-10-17.parquet")
    assert again[0].status == "SKIPPED" and again[0].exit_code == 0
    save(tmp_path / "m_2024-10-01.parquet", ids({9: 1}))
    assert r.run(f"file://{tmp_path}/m_2024-10-01.parquet")[0].status == "REJECTED"
    r.detect()
    assert len(reports.write_csv(r, str(tmp_path / "reports"))) == 12
    reports.write_reconciliation(r, done[0].run_id, str(tmp_path / "reports"))
    reports.write_insights(r, str(tmp_path / "reports/insights.md"))


def test_guard_stops_before_a_write(spark, tmp_path):
    r = Runner(spark, f"file://{tmp_path}/store")
    save(tmp_path / "a_2024-10-15.parquet", ids({n: n + 1 for n in range(150)}))
    save(tmp_path / "a_2024-10-16.parquet", ids({n: n + 1 for n in range(10)}))
    done = r.run(f"file://{tmp_path}/a_2024-10-15.parquet") + r.run(f"file://{tmp_path}/a_2024-10-16.parquet")
    assert [x.exit_code for x in done] == [0, GUARDED]
    assert r.gold.read("movements_current").where("is_active").count() == 150
    assert r.audit.read("pipeline_runs").first()["error_code"] == "GUARD_BREACH"


def test_retention_keeps_what_current_needs(spark, tmp_path):
    r = Runner(spark, f"file://{tmp_path}/store", Settings(retention_days=1))
    for i, c in enumerate([{1: 1, 2: 5}, {1: 2}, {1: 3}, {1: 4}]):
        done = r.process(snapshots.dated(spark, snapshots.inspect(spark, save(tmp_path / f"c_2024-10-{10 + 3 * i}.parquet", ids(c)), 1), r.s))
        assert done.exit_code == 0, done.reason
    kept = sorted((x["version"], x["is_current"]) for x in r.history().collect())
    assert kept == [(1, False), (3, False), (4, True)]


def test_arrivals_apply_once(spark, tmp_path):
    from ledgerly.streaming.arrivals import watch

    r = Runner(spark, f"file://{tmp_path}/store")
    (tmp_path / "in").mkdir()
    save(tmp_path / "in/m_2024-10-15.parquet", ids({1: 1, 2: 2}))
    for _ in range(2):
        watch(r, f"file://{tmp_path}/in", f"file://{tmp_path}/offsets", once=True).awaitTermination()
    assert r.runs().count() == 1 and r.gold.read("movements_current").count() == 2


def test_schema_problems_and_store_errors(spark, tmp_path):
    bad = save(tmp_path / "x_2024-10-15.parquet", [row()])
    assert snapshots.check_schema({c: "string" for c in BASE if c != "fund"}, Settings().contract) == ["missing column fund"]
    assert snapshots.content_hash(spark, bad) == __import__("hashlib").sha256(open(bad, "rb").read()).hexdigest()
    raw(spark, ids({1: 1, 2: 2})).repartition(2).write.parquet(f"file://{tmp_path}/folder_2024-10-15.parquet")
    found = snapshots.candidates(spark, f"file://{tmp_path}/folder_2024-10-15.parquet", Settings())
    assert [(f.row_count, f.snapshot_date, len(f.sha256)) for f in found] == [(2, DAY, 64)]
    with pytest.raises(StoreError):
        Store(spark, f"file://{tmp_path}/none", read_only=True)
    one, two = Store(spark, f"file://{tmp_path}/s"), Store(spark, f"file://{tmp_path}/s")
    one.publish({"anomalies": []})
    with pytest.raises(StoreError):
        two.publish({"anomalies": []})


def test_reactivation_can_be_off(spark):
    from ledgerly.schemas import ddl

    s = replace(Settings(), allow_reactivation=False)
    staged = silver.build(raw(spark, [row()]), s, silver.Cut("r", DAY)).staged
    assert diff.counts(diff.classify(staged, spark.createDataFrame([], ddl("movements_current")), s, DAY))["NEW"] == 1


def test_registry_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(set(e.oracle_sql()) <= set(e.queries()))"], capture_output=True, text=True, cwd=Path(__file__).parent.parent)
    assert said.stdout.strip() == "True", said.stderr
