"""Runs that are started again."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cotejo.plans import run_all as stages
from cotejo.plans.ledger import Ledger
from test_plans import inputs  # noqa: F401  (a fixture)

SHEETS = ["loaded", "invoices", "accounts", "orders"]


@pytest.fixture
def from_files(spark, inputs, tmp_path):  # noqa: F811
    def stored(frame, name):
        frame.write.parquet(str(tmp_path / "in [x]" / name))
        return spark.read.schema(frame.schema).parquet(str(tmp_path / "in [x]" / name).replace("[", "\\[").replace("]", "\\]"))

    return stages.Inputs(
        stored(inputs.orders, "orders"), stored(inputs.accounts, "accounts"), stored(inputs.penalties, "penalties"),
        [stored(inputs.catalogs[0], "catalog")], stored(inputs.xml_lines, "xml"), stored(inputs.tax_status, "status"),
    )


def written(root):
    """When each stored sheet was written."""
    return {s: max((p.stat().st_mtime_ns for p in (root / s).rglob("*.parquet")), default=None) for s in SHEETS if (root / s).exists()}


def test_a_restart_runs_the_failed_stage_and_those_after_it(spark, from_files, tmp_path, monkeypatch):
    root = tmp_path / "out"
    args = (spark, from_files, str(root), "g", dt.datetime(2025, 9, 19, 8, 30), "ledger.historico")
    with monkeypatch.context() as broken:
        broken.setattr(stages, "enrich_orders", lambda priced, *_, **__: priced.withColumn("x", F.raise_error(F.lit("lost"))))
        with pytest.raises(PySparkException):
            stages.run_all(*args, resume=True)
    before = written(root)
    stages.run_all(*args, resume=True)
    after = written(root)
    assert [s for s in SHEETS if before.get(s) == after[s]] == ["loaded", "invoices", "accounts"]
    rows = sorted(map(tuple, spark.table("ledger.historico").select("numero_orden_suministro", "uuid").collect()))
    assert rows == [("A", "u1"), ("B", "no localizado")]
    stages.run_all(*args, resume=True)
    assert written(root) == after and spark.table("ledger.historico").count() == 2
    stages.run_all(*args)
    assert all(written(root)[s] != after[s] for s in SHEETS)


def test_changed_inputs_and_settings(spark, from_files, tmp_path):
    root = tmp_path / "out"
    run = {"root": str(root), "group_id": "g", "resume": True}
    stages.stored_orders(spark, from_files, file_date="2025-01-01", **run)
    first = written(root)
    stages.stored_orders(spark, from_files, file_date="2025-01-02", **run)
    second = written(root)
    assert [s for s in SHEETS if first[s] != second[s]] == ["orders"]
    for part in (tmp_path / "in [x]" / "accounts").glob("*.parquet"):
        os.utime(part, (1, 1))
    stages.stored_orders(spark, from_files, file_date="2025-01-02", **run)
    third = written(root)
    assert [s for s in SHEETS if second[s] != third[s]] == ["accounts", "orders"]
    stages.stored_orders(spark, from_files, file_date="2025-01-02", settings={"rules": 2}, **run)
    assert all(third[s] != t for s, t in written(root).items())


def test_tables_without_files_always_run(spark, rows, tmp_path):
    ledger, runs = Ledger(spark, str(tmp_path), "g"), []
    source = rows("k int", (1,))
    assert ledger.made_from([source], {}) is None
    for _ in range(2):
        ledger.stage("s", [source], {}, lambda: runs.append(1) or source)
    assert len(runs) == 2


def test_a_sheet_that_was_being_replaced_is_pending(spark, rows, tmp_path):
    rows("k int", (1,)).write.parquet(str(tmp_path / "in"))
    source, ledger, runs = spark.read.parquet(str(tmp_path / "in")), Ledger(spark, str(tmp_path), "g"), []
    build = lambda: runs.append(1) or source
    assert ledger.stage("s", [source], {"a": 1}, build).count() == 1
    with pytest.raises(ZeroDivisionError):
        ledger.stage("s", [source], {"a": 2}, lambda: 1 / 0)
    for _ in range(2):
        assert ledger.stage("s", [source], {"a": 1}, build).columns == ["k", "_row_no"]
    assert len(runs) == 2
