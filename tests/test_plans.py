import datetime as dt

import pytest
from pyspark.sql import functions as F

from cotejo.operators.setops import union_by_name
from cotejo.plans import run_all as stages
from cotejo.plans.integrate import integrate
from cotejo.plans.invoices import extend_documents
from cotejo.plans.payments import payments_feed
from cotejo.plans.sql_folder import folder_report, run_sql_folder
from cotejo.sinks import writers
from cotejo.sources import datasets, invoice_xml
from cotejo.streaming import ingest
from test_sources import CFDI, RECEIVER, SECOND


@pytest.fixture
def inputs(rows):
    orders = rows("numero_orden_suministro string, precio_unitario string, cantidad_solicitada string, orden_remision string",
                  ("A", "2", "5", "r1"), ("B", "1", "1", "r2"))
    catalog = rows("Referencia string, Factura string, Total double, `UUID Descripción` string, _row_no bigint",
                   ("A ", "F1", 10.0, "Vigente", 0), ("B", "F2", 9.0, "Vigente", 1))
    xml = rows("Folio string, UUID string", ("F1", "u1"), ("F2", "u2"))
    accounts = rows("`Folio fiscal` string, `Orden de suministro` string, `Estado de la factura` string, Total string",
                    ("u1", None, "Pagado", "$10.00"))
    penalties = rows("`ORDEN DE SUMINISTRO` string, PENA string, OFICIO string", ("A", "3", "of"))
    status = rows("uuid string, estado string", ("u2", "Cancelado"))
    return stages.Inputs(orders, accounts, penalties, [catalog], xml, status)


def test_all_stages(spark, inputs, tmp_path):
    folder = tmp_path / "sql"
    folder.mkdir()
    (folder / "a.sql").write_text("SELECT max(importe) AS m FROM stages.historico;")
    (folder / "b.sql").write_text("  ")
    (folder / "c.sql").write_text("SELECT nothing FROM nowhere")
    args = (spark, inputs, str(tmp_path / "out"), "2025-09-19-08_10", dt.datetime(2025, 9, 19, 8, 30), "stages.historico", str(folder))
    for _ in range(2):
        results = stages.run_all(*args)
    assert [r.status for r in results] == ["ok", "empty", "error"] and results[0].result.first()["m"] == 10.0
    assert [tuple(r)[1:] for r in folder_report(spark, results).collect()] == [("ok", 1), ("empty", None), ("error", None)]
    table = {r["numero_orden_suministro"]: r for r in spark.table("stages.historico").collect()}
    assert len(table) == spark.table("stages.historico").count() == 2
    a, b = table["A"], table["B"]
    assert (a["uuid"], a["folio"], a["estado_de_la_factura"], a["pena"], a["oficio"]) == ("u1", "F1", "Pagado", 3.0, "of")
    assert (b["uuid"], b["estado_de_la_factura"], b["pena"]) == ("no localizado", "no localizado", None)
    assert a["file_date"] == dt.datetime(2025, 9, 19, 8)
    stored = datasets.scan_history_sheets(spark, str(tmp_path / "out"), "invoices")
    assert [r["orden_remision"] for r in stored.collect()] == ["r1"]


def test_integration_without_penalty_columns(inputs):
    got = integrate(inputs.orders, inputs.catalogs[0].selectExpr("*", "'u' as UUID", "'f' as Folio"), inputs.accounts,
                    inputs.penalties.drop("PENA"), "2025-01-01")
    assert "PENA" not in got.orders.columns and got.orders.count() == 2


def test_payments(spark, rows):
    names = ["2025-01-01 10-30 Acme a.xlsx", "2025-01-01 10-30 Acme b.xlsx"]
    listing = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    cells = [["Folio Fiscal", "Referencia", "Importe", "CLC"], [" u1 ", "r", "5", " "], ["u1", "r", "6", "c"], ["NaN", "r", "7", "c"], ["u2", "r", "x", "c"]]
    sheet = spark.createDataFrame([(n, i, c) for n in names for i, c in enumerate(cells)], "file string, pos int, cells array<string>")
    target = spark.createDataFrame([], "folio_fiscal string, referencia string, importe double, clc string, file_name string")
    table, rejected = payments_feed(listing, sheet, target, "Acme", "i")
    assert [tuple(r) for r in table.collect()] == [("u1", "r", 5.0, None, names[0])]
    assert sorted(r["importe"] for r in rejected.collect()) == ["7", "x"]
    empty = payments_feed(listing.limit(0), sheet, target, "Acme", "i")[0]
    assert empty.count() == 0 and empty.columns == target.columns


def test_stored_notices_are_counted_by_their_write(spark, tmp_path):
    from cotejo.operators.checks import quality_metrics
    from cotejo.operators.filters import flag_payments
    from cotejo.plans.payments import insert_notices, notice_rows, stored_notices

    names = ["2025-01-01 10-30 Acme a.xlsx", "2025-01-02 10-30 Acme b.xlsx"]
    listing = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    cells = [["Folio Fiscal", "Referencia", "Importe", "CLC"], ["u1", "r", "5", " "], ["u1", "r", "6", "c"], ["NaN", "r", "x", "c"], ["u2", "r", "x", "c"], ["NaN", "r", "1", "c"]]
    sheet = spark.createDataFrame([(n, i, c) for n in names for i, c in enumerate(cells)], "file string, pos int, cells array<string>")
    target = spark.createDataFrame([], "folio_fiscal string, referencia string, importe double, clc string, file_name string")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    once = sheet.mapInArrow(counted, sheet.schema)
    accepted, rejected, counts = stored_notices(listing, once, str(tmp_path / "n"), "Acme", "i")
    seen = reads.value
    metrics = quality_metrics(
        flag_payments(notice_rows(listing, sheet, "Acme", "i")), accepted=F.col("accepted"), without_folio=F.col("folio_fiscal").isNull(),
        without_amount=F.col("importe") == "x")
    assert counts == metrics.first().asDict() == {"rows": 10, "accepted": 4, "without_folio": 4, "without_amount": 4}
    assert (accepted.count(), rejected.count()) == (4, 6) and reads.value == seen
    assert insert_notices(target, accepted).count() == 2
    split = payments_feed(listing, sheet, target, "Acme", "i")
    assert sorted(map(tuple, insert_notices(target, accepted).collect())) == sorted(map(tuple, split[0].collect()))
    counts = stored_notices(listing.limit(0), sheet, str(tmp_path / "none"), "Acme", "i")[2]
    assert counts == {"rows": 0, "accepted": 0, "without_folio": 0, "without_amount": 0}


def test_known_documents_are_skipped(spark):
    texts = spark.createDataFrame(
        [("a.xml", CFDI.format(v=3, rec=RECEIVER, more="")), ("b.xml", CFDI.format(v=4, rec=RECEIVER, more=SECOND))],
        "file_name string, text string",
    )
    parsed = invoice_xml.parse_documents(texts)
    known = invoice_xml.line_items(invoice_xml.headers(parsed.filter("file_name = 'a.xml'")))
    got = extend_documents(known, parsed)
    assert sorted((r["UUID"], r["line_no"]) for r in got.collect()) == [("u-3", 0), ("u-4", 0), ("u-4", 1)]


def test_incremental_documents(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    inbox.mkdir()

    def run():
        query = ingest.run_once(ingest.stream_documents(spark, str(inbox)), state, ingest.invoice_lines_writer(table))
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted((r["UUID"], r["Archivo"], r["line_no"]) for r in spark.read.parquet(table).collect())

    (inbox / "a.xml").write_text(CFDI.format(v=3, rec=RECEIVER, more=""))
    assert run() == [("u-3", "a.xml", 0)]
    (inbox / "b.xml").write_text(CFDI.format(v=4, rec=RECEIVER, more=SECOND))
    (inbox / "copy.xml").write_text(CFDI.format(v=3, rec=RECEIVER, more=""))
    expected = [("u-3", "a.xml", 0), ("u-4", "b.xml", 0), ("u-4", "b.xml", 1)]
    assert run() == expected
    assert run() == expected


def test_sinks(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    assert {k: v.count() for k, v in writers.write_sheets({"s": one, "e": one.limit(0)}, root, "g1").items()} == {"s": 1, "e": 0}
    writers.write_sheets({"s": one}, root, "g2")
    writers.write_sheets({"s": union_by_name([one, one])}, root, "g1")
    counts = {r["group_id"]: r["count"] for r in spark.read.parquet(f"{root}/s").groupBy("group_id").count().collect()}
    assert counts == {"g1": 2, "g2": 1}
    assert writers.write_by_header([one, one.select("b", "a")], root, "h") == [f"{root}/h"]
    assert spark.read.parquet(f"{root}/h").count() == 2
    assert writers.write_by_header([one, one.select("a")], root, "k") == [f"{root}/k_0", f"{root}/k_1"]
    writers.write_split(one.withColumn("accepted", F.lit(True)), f"{root}/split")
    assert spark.read.parquet(f"{root}/split").filter("accepted = 'true'").count() == 1
    writers.write_csv(one, f"{root}/csv")
    assert spark.read.option("header", True).csv(f"{root}/csv").columns == ["a", "b"]


def test_sql_that_fails_while_it_runs(spark, tmp_path):
    (tmp_path / "bad.sql").write_text("SELECT CAST(concat('x', id) AS INT) AS n, id FROM range(3)")
    (tmp_path / "good.sql").write_text("SELECT * FROM range(3)")
    report = folder_report(spark, run_sql_folder(spark, str(tmp_path)))
    assert sorted(map(tuple, report.collect())) == [("bad.sql", "error", None), ("good.sql", "ok", 3)]


def test_exchanges(spark, rows, inputs):
    """The number of shuffles of the larger plans, so that none creeps in."""
    from conftest import plan_of

    from cotejo.operators import groups

    files = spark.createDataFrame([("k", "2024-01-01 08:00:00", "p")], "owner string, t string, path string")
    stamped = files.withColumn("ts", F.col("t").cast("timestamp_ntz"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(groups.anchored_groups(stamped, ["owner"])).count("Exchange hashpartitioning") <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_sql_folder(spark, tmp_path):
    assert folder_report(spark, run_sql_folder(spark, str(tmp_path))).count() == 0
