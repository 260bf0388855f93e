import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from cotejo.operators import files, ranges
from cotejo.sources import csv_dialect, datasets, html_tables, invoice_xml, lines, receipts, sheets


def test_csv_dialect(spark, tmp_path):
    body = [
        "﻿a,b,c",
        "1,plain,z",
        "2,m\\,n,z",
        '3,"p""q",z',
        '4,"x\\"y",z',
        "5,\\N,z",
        "6,too,wide,row",
        "7,narrow",
        "8,,NA",
        '9,"q,r", s ',
        "10,back\\\\slash,\\t",
        "11,x,y,",
    ]
    (tmp_path / "one.csv").write_text("\n".join(body) + "\n", encoding="utf-8")
    found, rejects = csv_dialect.read_csv_dialect(spark, str(tmp_path), ["a", "b", "c"])
    got = {r["a"]: (r["b"], r["c"]) for r in found.collect()}
    assert [(r["line"], r["reason"]) for r in rejects.orderBy("pos").collect()] == [("6,too,wide,row", "too many cells"), ("11,x,y,", "too many cells")]
    assert got == {
        "1": ("plain", "z"), "2": ("m,n", "z"), "3": ('p"q', "z"), "4": ('x"y', "z"), "5": (None, "z"),
        "7": ("narrow", None), "8": (None, None), "9": ("q,r", " s "), "10": ("back\\slash", "t"),
    }


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1,"two\nlines, and ""more"""\n2,x\n', encoding="utf-8")
    got, _ = csv_dialect.read_csv_dialect(spark, str(tmp_path), ["a", "b"], line_breaks=True)
    assert {r["a"]: r["b"] for r in got.collect()} == {"1": 'two\nlines, and "more"', "2": "x"}


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    texts = {"1": "a,b,c\n1,2,3\n", "2": "c,b,a\n30,20,10\n\n31,21\n", "3": "a,b,x\n7,8,9\n", "4": "b,a,c\n5,4,6,7\n", "5": ""}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found, rejects = csv_dialect.read_csv_dialect(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted((r["a"] or "", r["b"], r["c"]) for r in found.collect()) == [("", "21", "31"), ("1", "2", "3"), ("10", "20", "30")]
    assert sorted((r["line"], r["reason"]) for r in rejects.collect()) == [
        ("5,4,6,7", "too many cells"), ("7,8,9", "unknown header"), ("a,b,x", "unknown header"),
    ]
    sets = {tuple(r["names"]): len(r["files"]) for r in csv_dialect.header_sets(csv_dialect.read_sheet_rows(spark, str(tmp_path))).collect()}
    assert sets == {("a", "b", "c"): 3, ("a", "b", "x"): 1}


def test_wide_lines_are_not_lost(spark):
    given = spark.createDataFrame([(1, "a,b"), (2, "a,b,c"), (3, "a")], "n int, line string")
    assert [r["n"] for r in csv_dialect.wide_lines(given, ["x", "y"]).collect()] == [2]
    assert sorted(r["n"] for r in csv_dialect.parse_lines(given, ["x", "y"]).collect()) == [1, 3]


@pytest.mark.parametrize("size", ["100b", "1k", "100m"])
def test_row_numbers_do_not_depend_on_the_split(spark, tmp_path, size):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(300)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        numbered = lines.with_row_numbers(lines.read_lines(spark, str(tmp_path)))
        got = [(r["line"], r["pos"]) for r in numbered.orderBy("_row_no").collect()]
        assert got == [(f"{name}{i}", i) for name in "abc" for i in range(300)]
        assert [r["_row_no"] for r in numbered.select("_row_no").orderBy("_row_no").collect()] == list(range(900))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_catalogs_from_files(spark, tmp_path):
    from cotejo.plans import invoices

    (tmp_path / "1.csv").write_text("title,,\nFactura,x,Total\nF1,?,10\nF2,?,20\n")
    (tmp_path / "2.csv").write_text("Total,Factura\n30,F1\n")
    got = invoices.read_catalogs(spark, str(tmp_path), ["Factura", "Total"]).orderBy("_row_no").collect()
    assert [(r["Factura"], r["Total"]) for r in got] == [("F1", "10"), ("F2", "20"), ("F1", "30")]
    one = spark.createDataFrame([("F1", 1, 0)], "Factura string, n int, _row_no bigint")
    two = spark.createDataFrame([("F1", 2, 0)], "f string, m int, r bigint")
    xml = spark.createDataFrame([("F1", "u", 0)], "Folio string, UUID string, _row_no bigint")
    assert [r["n"] for r in invoices.load_invoices([one, two], xml).orderBy("_row_no").collect()] == [1, 2]


def test_notices_from_files(spark, tmp_path):
    (tmp_path / "n.csv").write_text("x\nFolio  Fiscal,Referencia,Importe,CLC\nu1,r1,5,c1\n")
    rows = csv_dialect.read_sheet_rows(spark, str(tmp_path))
    assert [(r["folio_fiscal"], r["importe"], r["_row_no"]) for r in sheets.read_notices(rows).collect()] == [("u1", "5", 2)]


def test_numbered_invoice_items(spark, tmp_path):
    (tmp_path / "b.xml").write_text(CFDI.format(v=4, rec=RECEIVER, more=SECOND))
    (tmp_path / "a.xml").write_text(CFDI.format(v=3, rec=RECEIVER, more=""))
    got = invoice_xml.numbered_items(spark, str(tmp_path)).orderBy("_row_no").collect()
    assert [(r["Archivo"], r["line_no"]) for r in got] == [("a.xml", 0), ("b.xml", 0), ("b.xml", 1)]


def test_equal_file_names_in_two_folders(spark, tmp_path):
    for folder in ("x", "y", "z y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.xml").write_text(CFDI.format(v=4, rec=RECEIVER, more=SECOND))
    got = invoice_xml.numbered_items(spark, str(tmp_path)).orderBy("_row_no").collect()
    assert [r["_row_no"] for r in got] == [n * invoice_xml.ITEMS + k for n in range(3) for k in range(2)]
    assert "Archivo" in got[0] and "path" not in got[0]


def test_a_million_one_line_files_are_numbered_without_gaps(spark):
    name = F.format_string("/drop/%03d/%07d.xml", (F.col("id") * 7919) % 1000, F.col("id"))
    lines_of = spark.range(1_000_000).select(name.alias("file"), F.lit(0).alias("block"), F.lit(5).alias("line_id"))
    edges = ranges.bounds(lines_of, "file", [])
    numbered = lines.with_row_numbers(lines_of, edges)
    windows = [x for x in plan_of(numbered).split("\n") if re.search(r"\bWindow\b", x)]
    assert windows and all(re.search(r"\[_range#\d+", x) for x in windows)
    sums = numbered.agg(F.count("*"), F.countDistinct("_row_no"), F.min("_row_no"), F.max("_row_no"), F.max("pos")).first()
    assert tuple(sums) == (1_000_000, 1_000_000, 0, 999_999, 0)
    picked = numbered.where("_row_no in (0, 499999, 999999)").orderBy("_row_no").select("file").collect()
    files = sorted(f"/drop/{i * 7919 % 1000:03d}/{i:07d}.xml" for i in range(1_000_000))
    assert [r["file"] for r in picked] == [files[0], files[499_999], files[999_999]]


def test_damaged_history_files(spark, tmp_path):
    root = tmp_path / "h"
    for name in ("one", "two", "three"):
        spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(str(root / "s" / f"part={name}"))
    (damaged,) = (root / "s" / "part=two").glob("*.parquet")
    raw = bytearray(damaged.read_bytes())
    raw[4:4000] = bytes(3996)  # pages
    damaged.write_bytes(bytes(raw))
    (cut,) = (root / "s" / "part=three").glob("*.parquet")
    cut.write_bytes(cut.read_bytes()[:-8])  # footer
    for crc in root.rglob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception):
        datasets.scan_history_sheets(spark, str(root), "s", "id bigint, v string, part string").agg(F.max("v")).collect()
    kept, rejects = datasets.scan_readable_sheets(spark, str(root), "s")
    assert {r["part"]: r["count"] for r in kept.groupBy("part").count().collect()} == {"one": 1000}
    assert sorted(r["path"].split("/")[-2] for r in rejects.collect()) == ["part=three", "part=two"]


def test_work_lists(spark, tmp_path):
    (tmp_path / "w.csv").write_text("folio,x\n F1 ,1\nF1,2\n,3\n")
    (tmp_path / "empty.csv").write_text("folio,x\n")
    assert [r["folio"] for r in datasets.read_receipt_list(spark, str(tmp_path / "w.csv"), "folio").collect()] == ["F1"]
    for bad in (("empty.csv", "folio"), ("w.csv", "other")):
        with pytest.raises(ValueError):
            datasets.read_receipt_list(spark, str(tmp_path / bad[0]), bad[1])
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A.PDF").write_text("x")
    found = lines.index_files(spark, [str(tmp_path / "sub"), str(tmp_path / "sub") + "/", str(tmp_path)], "*.PDF")
    assert [r["name"] for r in found.collect()] == ["a.pdf"]


def test_tables_without_values_are_left_out(spark, tmp_path):
    one = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    one.write.parquet(str(tmp_path / "one"))
    one.filter("a is null").write.parquet(str(tmp_path / "none"))
    assert [t.count() for t in datasets.read_sheets(spark, [str(tmp_path / "one"), str(tmp_path / "none")])] == [2]


def test_line_order(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\n".join(str(i) for i in range(100)), encoding="utf-8")
    got = lines.read_lines(spark, str(tmp_path)).orderBy("file_name", *lines.LINE_ORDER)
    assert [int(r["line"]) for r in got.collect()] == list(range(100))


def sheet(spark, *cells, name="f"):
    data = [(name, i, list(c)) for i, c in enumerate(cells)]
    return spark.createDataFrame(data, "file string, pos int, cells array<string>")


def test_header_by_names(spark):
    rows = sheet(spark, ["title"], ["B", "x", "A"], ["2", "", "1"])
    got = sheets.rows_below(rows, sheets.locate_by_names(rows, ["A", "B"]), ["A", "B"])
    assert [tuple(r) for r in got.collect()] == [("f", 2, "1", "2")]
    late = sheet(spark, ["A"], *[["x"]] * 10, ["A", "B"])
    assert sheets.locate_by_names(late, ["A", "B"]).first()["header_pos"] == 0


def test_header_exact(spark):
    rows = sheet(spark, ["t"], ["", None], ["x"], [" A ", "", "B", "nan"], ["1"])
    assert sheets.locate_exact(rows, ["A", "B"]).first()["header_pos"] == 3
    other = sheet(spark, ["A", "C"])
    found = sheets.locate_exact(other, ["A", "B"])
    assert found.count() == 0 and [r["file"] for r in sheets.rejected_files(other, found).collect()] == ["f"]


def test_header_of_a_notice(spark):
    rows = sheet(spark, ["Folio fiscal"], ["FOLIO  FISCAL uuid", " Referencia", "importe", "CLC", None], ["u", "r", "1", "c"])
    got = sheets.read_notices(rows)
    assert [tuple(r) for r in got.collect()] == [("f", 2, "u", "r", "1", "c")]
    late = sheet(spark, *[["x"]] * 30, ["folio fiscal", "referencia", "importe", "clc"])
    assert sheets.locate_notice(late).count() == 0
    spread = sheet(spark, ["a folio fiscal", "referencias", "importe", "clc"])
    assert sheets.locate_notice(spread).count() == 0


CFDI = (
    '<?xml version="1.0"?><cfdi:Comprobante xmlns:cfdi="http://www.sat.gob.mx/cfd/{v}" '
    'xmlns:tfd="http://www.sat.gob.mx/TimbreFiscalDigital" Serie="A" Folio="007" Fecha="2024-01-01">{rec}'
    '<cfdi:Conceptos><cfdi:Concepto Descripcion="a &amp; b" Cantidad="2" Importe="2.5"/>{more}</cfdi:Conceptos>'
    '<cfdi:Complemento><tfd:TimbreFiscalDigital UUID="u-{v}"/></cfdi:Complemento></cfdi:Comprobante>'
)
RECEIVER = '<cfdi:Receptor Nombre="N" Rfc="X"/>'
SECOND = '<cfdi:Concepto Descripcion="c" Cantidad="1" Importe="1"/>'


def test_unfolded_sheets_are_not_sent_to_the_driver(spark):
    """Cells unfolded from one column look small to the planner; neither they nor the headers may be broadcast for it."""
    header, data = F.array(F.lit("Folio"), F.lit("Monto")), F.array(F.col("id").cast("string"), F.lit("5"))
    names = F.concat(F.lit("f"), F.col("id").cast("string")).alias("file")
    rows = spark.range(50).select(names, F.posexplode(F.array(header, data, data)).alias("pos", "cells"))
    headers = sheets.locate_exact(rows, ["Folio", "Monto"])
    found = sheets.rows_below(rows, headers, ["Folio", "Monto"])
    rejected = sheets.rejected_files(rows, headers.filter("file != 'f7'"))
    assert found.count() == 100 and [r["file"] for r in rejected.collect()] == ["f7"]
    for frame in (found, rejected):
        frame.collect()
        assert "BroadcastExchange" not in plan_of(frame) and "SortMergeJoin" in plan_of(frame)


def test_invoice_documents(spark, tmp_path):
    folder = tmp_path / "deep" / "er"
    folder.mkdir(parents=True)
    documents = {
        "three.xml": CFDI.format(v=3, rec=RECEIVER, more=""),
        "four.xml": CFDI.format(v=4, rec=RECEIVER, more=SECOND),
        "two.xml": CFDI.format(v=2, rec=RECEIVER, more=""),
        "nobody.xml": CFDI.format(v=4, rec="", more=""),
        "empty.xml": CFDI.format(v=4, rec=RECEIVER, more="").split("<cfdi:Conceptos>")[0] + "</cfdi:Comprobante>",
        "broken.xml": CFDI.format(v=4, rec=RECEIVER, more="")[:-30],
        "skipped.txt": CFDI.format(v=4, rec=RECEIVER, more=""),
    }
    for name, text in documents.items():
        (folder / name).write_text(text, encoding="utf-8")
    parsed = invoice_xml.read_invoices(spark, str(tmp_path))
    got = sorted(map(tuple, invoice_xml.line_items(invoice_xml.headers(parsed)).collect()), key=str)
    assert got == [
        ("u-3", "A-007", "2024-01-01", "N", "X", "a & b", 2.0, 2.5, "three.xml", 0),
        ("u-4", "A-007", "2024-01-01", "N", "X", "a & b", 2.0, 2.5, "four.xml", 0),
        ("u-4", "A-007", "2024-01-01", "N", "X", "c", 1.0, 1.0, "four.xml", 1),
    ]
    assert [r["file_name"] for r in invoice_xml.rejects(parsed).collect()] == ["broken.xml"]


def test_receipts(spark):
    data = [
        ("x&ID=ab c\nd&re=y Vigente Cancelado", "1"),
        ("&id=u1&re= Vigente &id=u2&re=", "2"),
        ("&id=&re= vigente", "3"),
        ("nothing", "4"),
    ]
    frame = spark.createDataFrame(data, "text string, filename string")
    got = {r["filename"]: (r["uuid"], r["estado"]) for r in receipts.receipt_status(frame).collect()}
    assert got == {"1": ("abcd", "Cancelado"), "2": ("u1", "Vigente"), "3": (None, "Desconocido"), "4": (None, "Desconocido")}


def test_html_tables(spark):
    html = (
        "<p>x</p><TABLE class='a'><thead><tr><th>Orden</th><th>Estado</th></tr></thead><tbody>"
        "<tr><td> 1 <b>a</b></td><td>Pagado&nbsp;&amp;&nbsp;ok</td></tr><tr><td>2</td></tr></tbody></TABLE>"
        "<table><tr><td>other</td></tr></table>"
    )
    frame = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page int, html string")
    got = html_tables.named_cells(html_tables.table_rows(frame, "page"), ["Estado", "Orden"])
    assert sorted(map(tuple, got.collect())) == [(1, 1, "Pagado & ok", "1 a"), (1, 2, None, "2")]


def test_file_listing_and_fingerprints(spark, tmp_path):
    for name, text in (("a.pdf", "same"), ("b.pdf", "same"), ("c.pdf", "other"), ("d.txt", "same")):
        (tmp_path / name).write_text(text)
    listed = lines.list_files(spark, str(tmp_path), "*.pdf")
    assert listed.columns == ["path", "modified", "length"] and listed.count() == 3
    twice = files.duplicate_contents(lines.list_files(spark, str(tmp_path), "*.pdf", content=True), "path")
    row = twice.first()
    assert twice.count() == 1 and row["files"] == 2 and row["first_path"].endswith("a.pdf")


def test_sheet_choice(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "main"))
    assert datasets.read_sheet(spark, str(tmp_path), "wanted", "main").count() == 3
    assert datasets.read_sheet(spark, str(tmp_path), "wanted", schema="a int").count() == 0
    with pytest.raises(ValueError):
        datasets.read_sheet(spark, str(tmp_path), "wanted")
    assert [f.count() for f in datasets.read_sheets(spark, [str(tmp_path / "main")])] == [3]
    with pytest.raises(ValueError):
        datasets.read_work_list(spark, str(tmp_path / "main"), ["Folio"])


def test_calendar(spark):
    frame = spark.createDataFrame([("1/2/2025", "28/2/2025"), (None, "1/1/2025")], "`DATE START` string, `DATE END` string")
    got = datasets.ranges_as_dates(frame).select(F.datediff("end", "start")).collect()
    assert [r[0] for r in got] == [27]
