"""Sums that appends leave, and the newest snapshot from the log."""

import datetime as dt
import random

import pytest

from conftest import plan_of
from cotejo.operators import report
from cotejo.sinks.snapshots import HistoryTable

KEY = ["id", "file_date"]
SCHEMA = "id string, file_date timestamp_ntz, estado string, importe {amount}, fechaaltatrunc date"
D = [dt.datetime(2025, 1, 1, 9) + dt.timedelta(days=i) for i in range(4)]


def batch(rows, seed, amount):
    rng = random.Random(seed)
    numbers = [None, 1, 2, 30, 400] if amount == "int" else [None, "1", "2.5", "x", ""]
    data = [
        (f"k{rng.randrange(90)}", rng.choice(D), rng.choice([None, "Pagado", "Cancelado"]), rng.choice(numbers), rng.choice([None, dt.date(2024, 6, 29), dt.date(2024, 6, 30)]))
        for _ in range(80)
    ]
    return rows(SCHEMA.format(amount=amount), *data)


def reports(df):
    split = report.status_split(df, "2024-06-30").collect()
    compared = report.snapshot_compare(df, D[0], D[2], "2024-06-30").collect()
    return sorted(map(tuple, split), key=repr), sorted(map(tuple, compared), key=repr)


@pytest.mark.parametrize("amount", ["int", "string"])
@pytest.mark.parametrize("with_sums", [(True, True, True), (False, True, True)])
def test_reports_on_sums_equal_reports_on_rows(spark, rows, tmp_path, amount, with_sums):
    for i, own in enumerate(with_sums):
        table = HistoryTable(spark, str(tmp_path / "h"), buckets=2 * (i % 2), sums={} if own else None)
        assert i or table.summaries() is None
        table.append(batch(rows, i, amount), KEY, str(i))
    # A repeated batch, and one without new rows, leave the sums as they are.
    assert not table.append(batch(rows, 1, amount), KEY, "1") and table.append(batch(rows, 1, amount), KEY, "again")
    assert reports(table.summaries()) == reports(table.read())
    assert table.summaries().agg({"rows": "sum"}).first()[0] == table.read().filter("estado is not null").count()


def test_a_comparison_reads_sums_only(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), sums={})
    for i in range(2):
        table.append(batch(rows, i, "int"), KEY, str(i))
    assert all("/sums/" in name for name in table.summaries().inputFiles())


def test_other_columns_are_other_sums(spark, rows, tmp_path):
    HistoryTable(spark, str(tmp_path / "h"), sums={}).append(batch(rows, 1, "int"), KEY, "1")
    halves = HistoryTable(spark, str(tmp_path / "h"), sums={"status": "id"})
    assert set(halves.summaries().columns) == {"id", "file_date", "fechaaltatrunc", "importe", "rows"}


def test_the_newest_snapshot_comes_from_the_log(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"))
    assert table.latest() is None
    schema = "id string, file_date timestamp_ntz, v int"
    table.append(rows(schema, ("a", D[3], 1), ("b", D[0], 2)), KEY, "1")
    table.append(rows(schema, ("a", D[1], 3), ("c", D[3], 4)), KEY, "2")
    table.append(rows(schema, ("c", D[3], 5)), KEY, "nothing new")
    assert sorted((r["id"], r["v"]) for r in table.latest().collect()) == [("a", 1), ("c", 4)]
    plan = plan_of(table.latest())
    assert "2025-01-04 09:00:00" in plan.split("PartitionFilters")[1] and "ubquery" not in plan and "Aggregate" not in plan
    assert table.commits()[-1]["newest"] is None and table.commits()[0]["newest"] == str(D[3])


def test_tables_without_rows(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), buckets=2, sums={})
    table.append(spark.createDataFrame([], SCHEMA.format(amount="int") + ", _row_no bigint"), KEY, "empty")
    assert table.latest().count() == 0 and table.summaries().count() == 0 and table.read().count() == 0
