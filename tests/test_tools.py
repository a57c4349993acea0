"""Log lines, the profiling command, store recovery, chart columns and explorer lists."""

import datetime as dt
import json
import logging

import pytest
from test_engine import ids, save

from ledgerly import profiling
from ledgerly.functions import presentation
from ledgerly.operators import explore
from ledgerly.plans import logs
from ledgerly.plans.runner import Runner
from ledgerly.plans.store import Store, StoreError


@pytest.fixture
def quiet():
    yield
    own = logging.getLogger("ledgerly")
    own.handlers.clear()
    own.propagate = True


def test_log_lines_name_their_run(tmp_path, quiet):
    logs.configure("info", "json", str(tmp_path / "deep" / "log.jsonl"))
    log = logging.getLogger("ledgerly.test")
    log.info("before")
    with logs.within("run-1"):
        log.warning("inside ñ", extra={"error_code": "X", "other": 1})
    log.debug("too low")
    lines = [json.loads(x) for x in (tmp_path / "deep" / "log.jsonl").read_text(encoding="utf-8").splitlines()]
    assert [(x["run_id"], x["level"], x["message"], x.get("error_code")) for x in lines] == [("-", "INFO", "before", None), ("run-1", "WARNING", "inside ñ", "X")]
    with pytest.raises(ValueError, match="format"):
        logs.configure(form="xml")


def test_text_lines(capsys, quiet):
    logs.configure()
    with logs.within("r9"):
        logging.getLogger("ledgerly.x").error("said")
    assert "ERROR [r9] ledgerly.x: said" in capsys.readouterr().out


def test_empty_manifest_is_removed_by_a_writer(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    Store(spark, path).publish({"anomalies": []})
    (tmp_path / "s" / "manifest-2.json").touch()
    with pytest.raises(StoreError):
        Store(spark, path, read_only=True)
    assert Store(spark, path).version == 1
    assert not (tmp_path / "s" / "manifest-2.json").exists()
    (tmp_path / "s" / "manifest-2.json").write_text("{")  # content, though invalid, is never removed
    with pytest.raises(StoreError):
        Store(spark, path)


def test_profile_command(spark, tmp_path):
    save(tmp_path / "m_2024-10-15.parquet", ids({1: 100, 2: -200, 3: 0}))
    save(tmp_path / "m_2024-10-16.parquet", ids({2: 100, 4: 5}))
    out = tmp_path / "out"
    assert profiling.main(["--input-dir", f"file://{tmp_path}", "--output-dir", str(out)]) == 0
    logging.getLogger("ledgerly").handlers.clear()
    logging.getLogger("ledgerly").propagate = True
    made = {p.name for p in out.iterdir()}
    assert made == {*profiling.PARTS, "schema_comparison.csv", "snapshot_comparison.csv", "data_profile.md"}
    compared = (out / "snapshot_comparison.csv").read_text().splitlines()
    assert compared[1] == "m_2024-10-15.parquet,m_2024-10-16.parquet,3,2,3,2,1,2,1"
    (tmp_path / "none").mkdir()
    assert profiling.main(["--input-dir", f"file://{tmp_path}/none", "--output-dir", str(out)]) == 1
    logging.getLogger("ledgerly").handlers.clear()
    logging.getLogger("ledgerly").propagate = True


def test_chart_columns(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 10, 16), 2e9, 7), (dt.datetime(2024, 10, 15), -5e8, 8)], "day timestamp, amount double, n long")
    assert [tuple(r) for r in presentation.in_units(presentation.by_day(rows, "day")).collect()] == [("2024-10-15", -0.5, 8), ("2024-10-16", 2.0, 7)]


def test_explorer_lists(spark, tmp_path):
    r = Runner(spark, f"file://{tmp_path}/store")
    for day, cut in ((15, {1: 100, 2: 200}), (16, {1: 100})):
        assert r.run(save(tmp_path / f"m_2024-10-{day}.parquet", ids(cut)))[0].exit_code == 0
    r.detect()
    runs, results = r.gold.read("pipeline_runs"), r.gold.read("reconciliation_results")
    last = explore.last_run(runs).first()
    assert last["snapshot_date"] == dt.date(2024, 10, 16)
    assert {x["run_id"] for x in explore.last_checks(results, runs).collect()} == {last["run_id"]}
    assert explore.checks_by_run(results).count() == 24
    assert [x["source_file"] for x in explore.files(r.gold.read("file_registry")).collect()] == ["m_2024-10-15.parquet", "m_2024-10-16.parquet"]
    assert [x["amount"] for x in explore.ended(r.gold.read("movements_current")).collect()] == [200]
    found = r.gold.read("anomalies")
    assert explore.anomaly_list(found, ["CHANGE"]).count() == explore.anomaly_counts(found).where("category = 'CHANGE'").first()["cases"] == 1
    assert explore.alerts(r.audit.read("run_alerts")).columns[:2] == ["raised_at", "run_id"]
