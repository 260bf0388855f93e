import datetime as dt

import pytest
from pyspark.errors import PySparkException

from cotejo.operators import dedup, history
from cotejo.sinks import writers
from cotejo.values import HISTORY_KEY

D1, D2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)


def values(df, key="k", value="v"):
    return {r[key]: r[value] for r in df.collect()}


def test_keep_first_and_last(rows):
    frame = rows("k string, v int", ("a", 1), ("a", 2), ("b", 3))
    assert values(dedup.dedup_first(frame, ["k"])) == {"a": 1, "b": 3}
    assert values(dedup.dedup_last(frame, ["k"])) == {"a": 2, "b": 3}
    assert tuple(dedup.duplicate_count(frame, ["k"]).first()) == (1, 1)


def test_existing_rows_never_change(rows):
    target = rows("k string, v int", ("k1", 1)).drop("_row_no")
    given = rows("k string, v int", ("k1", 9), ("k2", 2), ("k2", 3), (None, 4))
    batch, refused = history.split_null_keys(given, ["k"])
    last = history.insert_if_absent(target, batch, ["K"], keep="last")
    assert values(last) == {"k1": 1, "k2": 3}
    assert values(history.insert_if_absent(target, batch, ["K"], keep="first")) == {"k1": 1, "k2": 2}
    assert values(history.insert_if_absent(last.drop("_row_no"), batch, ["K"])) == {"k1": 1, "k2": 3}
    assert (batch.count(), refused.count()) == (3, 1)


def test_key_must_exist(rows):
    with pytest.raises(ValueError):
        history.check_key(rows("a string", ("x",)), ["Otra Llave"])
    with pytest.raises(ValueError):
        history.new_rows(rows("k int", (1,)), rows("k int", (1,)), ["k"], keep="any")


def test_preparation(rows):
    frame = rows(
        "numero_orden_suministro string, file_date timestamp_ntz, fecha_autorizacion string, precio_unitario string, "
        "Importe string, razon_social string, `Unnamed: 3` string, nota string",
        ("o1", D1, "5/2/2025", "3.0", "x", "dropped", "dropped", " NaT "),
        ("o2", None, "31/02/2025", None, "2.5", "dropped", "dropped", " ok "),
    )
    got = history.prepare_history([frame])
    assert set(got.columns) == {
        "numero_orden_suministro", "file_date", "fecha_autorizacion", "precio_unitario", "importe", "nota", "_row_no",
    }
    one, two = sorted(got.collect(), key=lambda r: r["_row_no"])
    assert (one["fecha_autorizacion"], one["precio_unitario"], one["importe"], one["nota"]) == (
        dt.datetime(2025, 2, 5), 3, None, None)
    assert (two["fecha_autorizacion"], two["file_date"], two["importe"], two["nota"]) == (
        dt.datetime(1900, 1, 1), dt.datetime(1900, 1, 1), 2.5, "ok")
    bad = rows("precio_unitario string", ("3.5",))
    with pytest.raises(PySparkException):
        history.prepare_history([bad]).collect()


def test_append_twice_gives_the_same_table(spark, rows):
    batch = rows(
        "numero_orden_suministro string, file_date timestamp_ntz, importe double",
        ("o1", D1, 1.0), ("o1", D1, 2.0), ("o1", D2, 3.0), ("o2", D2, 4.0),
    )
    expected = [("o1", D1, 2.0), ("o1", D2, 3.0), ("o2", D2, 4.0)]
    for _ in range(2):
        writers.append_history(spark, "hist.historico", batch, HISTORY_KEY)
        table = spark.table("hist.historico").select("numero_orden_suministro", "file_date", "importe")
        assert sorted(map(tuple, table.collect())) == expected
    latest = history.latest_snapshot_lookup(
        spark.table("hist.historico").selectExpr("*", "'P' as estado_de_la_factura"), ["o2", "zz"]
    )
    assert list(map(tuple, latest.collect())) == [("o2", "P", 4.0)]


def test_missing_keys_fail_and_can_be_set_aside(spark, rows):
    batch = rows("k string, v int", ("a", 1), (None, 2))
    target = spark.createDataFrame([], "k string, v int")
    with pytest.raises(Exception, match="primary key"):
        history.insert_if_absent(target, batch, ["k"]).collect()
    full, refused = history.split_null_keys(batch, ["k"])
    assert history.insert_if_absent(target, full, ["k"]).count() == 1 and [r["v"] for r in refused.collect()] == [2]


def test_append_tells_of_columns_the_table_lacks(spark, rows):
    schema = "numero_orden_suministro string, file_date timestamp_ntz"
    writers.append_history(spark, "hist.narrow", rows(schema + ", importe double, uuid string", ("o1", D1, 1.0, "u")), HISTORY_KEY)
    with pytest.raises(ValueError, match="extra"):
        writers.append_history(spark, "hist.narrow", rows(schema + ", extra int", ("o2", D1, 1)), HISTORY_KEY)
    writers.append_history(spark, "hist.narrow", rows(schema + ", uuid string", ("o2", D1, "v")), HISTORY_KEY)
    table = spark.table("hist.narrow").select("numero_orden_suministro", "importe", "uuid")
    assert sorted(map(tuple, table.collect())) == [("o1", 1.0, "u"), ("o2", None, "v")]


def test_append_prunes_the_target(spark, rows):
    from conftest import plan_of

    batch = rows("numero_orden_suministro string, file_date timestamp_ntz, importe double", ("o1", D1, 1.0), ("o2", D2, 2.0))
    writers.append_history(spark, "hist.bounds", batch, HISTORY_KEY)
    target = spark.table("hist.bounds")
    low = batch.agg({"file_date": "min"}).scalar()
    pruned = target.filter(target.file_date >= low)
    pruned.collect()
    assert "PartitionFilters: [isnotnull(file_date" in plan_of(pruned) and "Subquery" in plan_of(pruned)


def test_history_writer_of_a_stream(spark, rows, tmp_path):
    from cotejo.streaming.ingest import history_writer, run_once

    schema = "numero_orden_suministro string, file_date timestamp_ntz, importe double, _row_no bigint"
    batch = rows(schema, ("o1", D1, 1.0, 0), ("o1", D1, 2.0, 1))
    for _ in range(2):
        batch.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        run_once(stream, str(tmp_path / "state"), history_writer("hist.streamed")).awaitTermination(120)
    assert [r["importe"] for r in spark.table("hist.streamed").collect()] == [2.0]


def test_latest_snapshot_reads_one_partition(spark, rows):
    from conftest import plan_of

    batch = rows("numero_orden_suministro string, file_date timestamp_ntz, importe double", ("o1", D1, 1.0), ("o1", D2, 3.0))
    writers.append_history(spark, "hist.pruned", batch, HISTORY_KEY)
    latest = history.latest_snapshot(spark.table("hist.pruned"))
    latest.collect()
    assert "PartitionFilters: [isnotnull(file_date" in plan_of(latest)


def test_create_table_needs_the_key(spark, rows):
    with pytest.raises(ValueError):
        writers.create_table(spark, "hist.bad", rows("a int", (1,)), HISTORY_KEY)
