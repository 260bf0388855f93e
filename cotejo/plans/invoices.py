"""Invoice load: stacked catalogs joined with the XML line items and the tax status."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cotejo.operators.lookup import join_first, mark_listed, new_documents
from cotejo.operators.setops import union_by_name, union_by_position
from cotejo.sources import invoice_xml
from cotejo.sources.csv_dialect import read_sheet_rows
from cotejo.sources.sheets import locate_by_names, rows_below
from cotejo.values import CANCELLED

# Distance between the ingest numbers of two catalogs.
CATALOG_STEP = 1 << 50


def extend_documents(known: DataFrame, parsed: DataFrame) -> DataFrame:
    """Known line items plus those of new documents; known ones are skipped before their items are unfolded."""
    fresh = new_documents(invoice_xml.headers(parsed), known)
    return union_by_name([known, invoice_xml.line_items(fresh)])


def stack_catalogs(catalogs: Sequence[DataFrame]) -> DataFrame:
    """Catalogs by position, with ingest numbers that don't collide: those of a later catalog are all larger."""
    if "_row_no" not in catalogs[0].columns:
        return union_by_position(catalogs)
    place = catalogs[0].columns.index("_row_no")
    numbered = []
    for i, catalog in enumerate(catalogs):
        if place < len(catalog.columns):
            name = catalog.columns[place]
            catalog = catalog.withColumn(name, F.col(f"`{name}`").cast("bigint") + F.lit(i * CATALOG_STEP))
        numbered.append(catalog)
    return union_by_position(numbered)


def read_catalogs(spark: SparkSession, path: str, wanted: Sequence[str], **options) -> DataFrame:
    """All catalog files of a path as one table: header search, wanted columns, one ingest number over all files."""
    rows = read_sheet_rows(spark, path, **options)
    found = rows_below(rows, locate_by_names(rows, wanted), wanted)
    return found.select(*[F.col(f"`{c}`") for c in wanted], "_row_no")


def load_invoices(
    catalogs: Sequence[DataFrame], xml_lines: DataFrame, tax_status: DataFrame | None = None, order=("_row_no",)
) -> DataFrame:
    """Catalog rows with the first XML line of their folio; invoices cancelled at the tax office are marked so."""
    joined = join_first(stack_catalogs(catalogs), xml_lines, "Factura", "Folio", order)
    if tax_status is None:
        return joined
    cancelled = tax_status.filter(tax_status["estado"] == CANCELLED)
    return mark_listed(joined, "UUID", cancelled, "uuid", "UUID Descripción", CANCELLED)
