import itertools
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cotejo.streaming import ingest

INVOICE = """<cfdi:Comprobante xmlns:cfdi="http://www.sat.gob.mx/cfd/4" Serie="S" Folio="{folio}" Fecha="2024-01-01">
<cfdi:Receptor Nombre="N" Rfc="R"/><cfdi:Conceptos><cfdi:Concepto Descripcion="d" Cantidad="1" Importe="2.5"/></cfdi:Conceptos>
<cfdi:Complemento><tfd:TimbreFiscalDigital xmlns:tfd="http://www.sat.gob.mx/TimbreFiscalDigital" {uuid}/></cfdi:Complemento></cfdi:Comprobante>"""


SECONDS = itertools.count(1_700_000_000)


def put(folder, name, folio, uuid=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(INVOICE.format(folio=folio, uuid=f'UUID="{uuid}"' if uuid else ""))
    os.utime(folder / name, (next(SECONDS),) * 2)  # the order of arrival


def finished(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_restarts_give_the_rows_of_one_run(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")

    def lines(**kwargs):
        return ingest.invoice_lines(ingest.stream_documents(spark, str(inbox), **kwargs), "30 days")

    def rows(path):
        return sorted((r["UUID"] or "", r["Folio"]) for r in spark.read.parquet(path).collect())

    put(inbox / "1", "a.xml", 1, "u1")
    put(inbox / "1", "n.xml", 8)
    finished(ingest.append_once(lines(), table, state))
    assert rows(table) == [("", "S-8"), ("u1", "S-1")]
    put(inbox / "2", "b.xml", 2, "u2")
    put(inbox / "2", "again.xml", 7, "u1")  # a known UUID
    put(inbox / "2", "a.xml", 1, "u3")  # a known pair
    put(inbox / "2", "m.xml", 8)  # no UUID, and another file: new
    put(inbox / "3", "n.xml", 8)  # no UUID, a known pair
    broken = lines().withColumn("Folio", F.when(F.col("Archivo") == "b.xml", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("Folio")))
    with pytest.raises(StreamingQueryException):
        ingest.append_once(broken, table, state).awaitTermination(120)
    assert len(rows(table)) == 2
    finished(ingest.append_once(lines(), table, state))
    finished(ingest.append_once(lines(), table, state))
    expected = [("", "S-8"), ("", "S-8"), ("u1", "S-1"), ("u2", "S-2")]
    assert rows(table) == expected
    whole = str(tmp_path / "whole")
    put(inbox / "4", "c.xml", 9, "u2")
    finished(ingest.append_once(lines(files_per_batch=1), table, state))
    finished(ingest.append_once(lines(files_per_batch=1), whole, str(tmp_path / "other")))
    assert rows(table) == rows(whole) == expected


def test_documents_known_before_the_stream(spark, tmp_path):
    put(tmp_path / "in", "a.xml", 1, "u1")
    put(tmp_path / "in", "b.xml", 2, "u2")
    known = spark.createDataFrame([("u1", "S-5", "z.xml")], "UUID string, Folio string, Archivo string")
    stream = ingest.invoice_lines(ingest.stream_documents(spark, str(tmp_path / "in")), "1 day", known)
    finished(ingest.append_once(stream, str(tmp_path / "t"), str(tmp_path / "s")))
    assert [r["UUID"] for r in spark.read.parquet(str(tmp_path / "t")).collect()] == ["u2"]
