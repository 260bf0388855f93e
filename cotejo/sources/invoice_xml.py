"""Electronic invoices (XML, schema versions 3 and 4) as one row per line item."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cotejo.functions.clean import once, series_folio, strict_number
from cotejo.operators.skew import join_unique
from cotejo.sources.lines import numbered_files, read_texts

# Namespaces of the two accepted versions and the parts of a document that are read.
VERSION_PATTERN = r"xmlns(:[\w.-]+)?\s*=\s*[\"'][^\"']*cfd/[34]"
SCHEMA = """
    _Serie string, _Folio string, _Fecha string,
    Receptor struct<_Nombre: string, _Rfc: string>,
    Conceptos struct<Concepto: array<struct<_Descripcion: string, _Cantidad: string, _Importe: string>>>,
    Complemento array<struct<TimbreFiscalDigital: struct<_UUID: string>>>,
    _corrupt_record string
"""
ITEMS = 1_000_000  # more line items than a document has
OPTIONS = {"rowTag": "Comprobante", "ignoreNamespace": "true", "mode": "PERMISSIVE"}


def parse_documents(texts: DataFrame, text: str = "text", file_name: str = "file_name", keep: Sequence[str] = ()) -> DataFrame:
    """(file_name, doc, text) and the columns to keep: every document parsed once, attribute values kept as text."""
    return texts.select(F.col(file_name).alias("file_name"), F.col(text).alias("text"), *keep).select(
        "file_name", "text", *keep, once(F.from_xml("text", SCHEMA, OPTIONS)).alias("doc")
    )


def root_tag(text: Column) -> Column:
    return F.regexp_extract(text, r"(?s)<(?:[\w.-]+:)?Comprobante\b([^>]*)>", 1)


def accepted(parsed: DataFrame) -> DataFrame:
    """Well-formed documents of an accepted version that name a receiver."""
    return parsed.filter(
        F.col("doc._corrupt_record").isNull()
        & root_tag(F.col("text")).rlike(VERSION_PATTERN)
        & F.col("doc.Receptor").isNotNull()
    )


def headers(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per accepted document, its line items still nested, with the columns to keep."""
    return accepted(parsed).select(
        F.try_element_at("doc.Complemento.TimbreFiscalDigital._UUID", F.lit(1)).alias("UUID"),
        series_folio("doc._Serie", "doc._Folio").alias("Folio"),
        F.col("doc._Fecha").alias("Fecha"),
        F.col("doc.Receptor._Nombre").alias("Nombre"),
        F.col("doc.Receptor._Rfc").alias("Rfc"),
        F.col("file_name").alias("Archivo"),
        F.col("doc.Conceptos.Concepto").alias("items"),
        *keep,
    )


def line_items(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per line item; documents without any vanish. ``line_no`` counts from 0 inside a document."""
    items = documents.select("*", F.posexplode("items").alias("line_no", "item")).drop("items")
    return items.select(
        "UUID",
        "Folio",
        "Fecha",
        "Nombre",
        "Rfc",
        F.col("item._Descripcion").alias("Descripcion"),
        strict_number("item._Cantidad").alias("Cantidad"),
        strict_number("item._Importe").alias("Importe"),
        "Archivo",
        "line_no",
        *keep,
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Documents that are not well-formed."""
    return parsed.filter(F.col("doc._corrupt_record").isNotNull()).select("file_name", "text")


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    return parse_documents(read_texts(spark, path, "*.xml"))


def numbered_items(spark: SparkSession, path: str) -> DataFrame:
    """Line items of all documents of a path with ``_row_no``: by file, then by place in the document.

    Files are known by their whole path, so equal names in two folders are two files. They are numbered from the listing;
    every document is read and parsed once and finds its number before its line items are laid out.
    """
    documents = headers(parse_documents(read_texts(spark, path, "*.xml"), keep=["path"]), ["path"])
    numbered = join_unique(documents, ["path"], numbered_files(spark, path, "*.xml"), ["file"], "inner")
    items = line_items(numbered, ["file_no"])
    return items.withColumn("_row_no", F.col("file_no") * ITEMS + F.col("line_no")).drop("file_no")
