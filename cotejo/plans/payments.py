"""Payment notices: choose the sheets, read them, split the rows, append the accepted ones."""

from pyspark.sql import DataFrame, functions as F

from cotejo.functions.clean import clean_strings, null_markers, to_number
from cotejo.operators.filters import flag_payments, split_payments
from cotejo.operators.files import first_sheet_per_prefix
from cotejo.operators.history import insert_if_absent
from cotejo.sinks.writers import write_counted
from cotejo.sources.sheets import TOKEN_ROWS, locate_notice, read_notices
from cotejo.values import PAYMENT_COLUMNS, PAYMENT_KEY, PAYMENT_NULL_MARKERS


def notice_rows(files: DataFrame, rows: DataFrame, suffix: str, order: str) -> DataFrame:
    """Typed-as-text rows of the first sheet of every prefix, with the file they came from."""
    chosen = first_sheet_per_prefix(files, suffix, order).select(F.col("first_file").alias("file"))
    # Only the leading rows are needed to find the headers; the rows below are then dealt once.
    headers = locate_notice(rows.filter(F.col("pos") < TOKEN_ROWS).join(chosen, "file", "left_semi"))
    notices = read_notices(rows, headers)
    number = F.col("_row_no") if "_row_no" in notices.columns else F.col("pos")
    return notices.select(
        null_markers("folio_fiscal", PAYMENT_NULL_MARKERS).alias("folio_fiscal"),
        *[c for c in PAYMENT_COLUMNS if c != "folio_fiscal"],
        F.col("file").alias("file_name"),
        number.alias("_row_no"),
    )


def stored_notices(files: DataFrame, rows: DataFrame, root: str, suffix: str, order: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(accepted rows, rejected rows, counts) of a run whose notice rows are read once and stored under ``root``.

    The counts of all rows, of accepted ones, and of those without a folio or without a number for an amount (a row may
    lack both) come from the write itself.
    """
    flagged = flag_payments(notice_rows(files, rows, suffix, order))
    missing = {"without_folio": F.col("folio_fiscal").isNull(), "without_amount": to_number("importe").isNull()}
    counts = write_counted(flagged, root, accepted=F.col("accepted"), **missing)
    stored = flagged.sparkSession.read.schema(flagged.schema).parquet(root)
    accepted = stored.filter("accepted").withColumn("importe", to_number("importe")).drop("accepted")
    return accepted, stored.filter("not accepted").drop("accepted"), counts


def insert_notices(target: DataFrame, accepted: DataFrame) -> DataFrame:
    """The target after the insert; the first row of a key wins."""
    clean = clean_strings(accepted, PAYMENT_NULL_MARKERS)
    return insert_if_absent(target, clean, PAYMENT_KEY, ("_row_no",), keep="first").drop("_row_no")


def payments_feed(files: DataFrame, rows: DataFrame, target: DataFrame, suffix: str, order: str):
    """(target after the insert, rejected rows); the first row of a key wins."""
    accepted, rejected = split_payments(notice_rows(files, rows, suffix, order))
    return insert_notices(target, accepted), rejected
