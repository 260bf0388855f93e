"""Appends that are all or nothing."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cotejo.session import shared_folder
from cotejo.sinks import snapshots
from cotejo.sinks.snapshots import CommitConflict, HistoryTable

D1, D2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2, 3)
KEY = ["id", "file_date"]
SCHEMA = "id string, file_date timestamp_ntz, v int"


@pytest.fixture
def table(spark, tmp_path):
    return HistoryTable(spark, str(tmp_path / "history"))


def held(df):
    return sorted((r["id"], r["file_date"], r["v"]) for r in df.collect())


def test_appends_and_versions(table, rows):
    assert table.read() is None and table.commits() == [] and table.unread() == []
    assert table.append(rows(SCHEMA, ("a", D1, 1), ("a", D1, 2), ("b", D2, 3)), KEY, "one")
    assert held(table.read()) == [("a", D1, 2), ("b", D2, 3)]
    assert table.append(rows(SCHEMA, ("a", D1, 9), ("a", D2, 4)), KEY, "two", keep="first")
    assert held(table.read()) == [("a", D1, 2), ("a", D2, 4), ("b", D2, 3)]
    assert held(table.read(version=0)) == [("a", D1, 2), ("b", D2, 3)]
    assert [(e["version"], e["batch_id"], e["rows"]) for e in table.commits()] == [(0, "one", 2), (1, "two", 1)]
    assert table.read().columns == ["id", "file_date", "v"] and table.read().schema["file_date"].dataType.typeName() == "timestamp_ntz"


def test_a_repeated_batch_adds_nothing(table, rows):
    batch = rows(SCHEMA, ("a", D1, 1))
    assert table.append(batch, KEY, "one")
    assert not table.append(rows(SCHEMA, ("c", D1, 7)), KEY, "one")
    assert table.append(batch, KEY, "other id, no new key") and table.commits()[-1]["rows"] == 0
    assert held(table.read()) == [("a", D1, 1)] and table.unread() == []


def test_columns(table, rows):
    table.append(rows(SCHEMA, ("a", D1, 1)), KEY, "one")
    table.append(rows("id string, file_date timestamp_ntz", ("b", D1)), KEY, "two")
    assert [(r["id"], r["v"]) for r in table.read().orderBy("id").collect()] == [("a", 1), ("b", None)]
    with pytest.raises(ValueError, match="extra"):
        table.append(rows(SCHEMA + ", extra int", ("c", D1, 1, 2)), KEY, "three")


def test_a_job_that_dies_leaves_the_old_snapshot(table, rows, monkeypatch):
    table.append(rows(SCHEMA, ("a", D1, 1)), KEY, "one")
    broken = rows(SCHEMA, *[(f"n{i}", D1, i) for i in range(40)]).repartition(8)
    dies = F.when(F.col("v") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int")
    with pytest.raises(PySparkException):  # between tasks: others have written by then
        table.append(broken.withColumn("v", dies), KEY, "two")
    assert held(table.read()) == [("a", D1, 1)] and len(table.commits()) == 1
    with monkeypatch.context() as patched:  # after the rows, before the entry
        patched.setattr(snapshots.HistoryTable, "_publish", lambda self, entry: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            table.append(broken, KEY, "two")
    assert held(table.read()) == [("a", D1, 1)] and len(table.unread()) >= 1
    assert table.append(broken, KEY, "two") and table.read().count() == 41


def test_of_two_writers_the_second_fails_and_changes_nothing(table, rows, monkeypatch):
    table.append(rows(SCHEMA, ("a", D1, 1)), KEY, "one")
    publish = HistoryTable._publish

    def late(self, entry):
        monkeypatch.setattr(HistoryTable, "_publish", publish)
        assert self.append(rows(SCHEMA, ("b", D1, 2)), KEY, "faster")
        publish(self, entry)

    monkeypatch.setattr(HistoryTable, "_publish", late)
    with pytest.raises(CommitConflict, match="version 1"):
        table.append(rows(SCHEMA, ("b", D1, 3), ("c", D1, 3)), KEY, "slower")
    assert held(table.read()) == [("a", D1, 1), ("b", D1, 2)]
    assert [e["batch_id"] for e in table.commits()] == ["one", "faster"] and len(table.unread()) == 1
    assert table.append(rows(SCHEMA, ("b", D1, 3), ("c", D1, 3)), KEY, "slower")
    assert held(table.read()) == [("a", D1, 1), ("b", D1, 2), ("c", D1, 3)]


def test_only_the_snapshots_of_the_batch_are_read(table, rows):
    table.append(rows(SCHEMA, *[("a", D1 + dt.timedelta(days=i), i) for i in range(20)]), KEY, "one")
    later = rows(SCHEMA, ("a", D1 + dt.timedelta(days=3), 0))
    target = snapshots.only_between(table.read(), later, "file_date")
    assert held(target) == [("a", D1 + dt.timedelta(days=3), 3)]
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_date" in plan and "subquery" in plan


def test_tables_without_snapshots(spark, tmp_path, rows):
    table = HistoryTable(spark, str(tmp_path / "plain"))
    table.append(rows("id string, v int", ("a", 1)), ["id"], "one")
    table.append(rows("id string, v int", ("a", 2), ("b", 2)), ["id"], "two")
    assert sorted((r["id"], r["v"]) for r in table.read().collect()) == [("a", 1), ("b", 2)]


def test_shared_folder(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
