"""Sheets whose header is not in the first row.

A sheet is a set of rows (file, pos, cells): position in the file and an array of cell texts. Only the first rows of a
file are searched, and the header comes back as one small row per file.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cotejo.functions.clean import SPACE, normalize_identifier_column, once, strip
from cotejo.operators.skew import join_unique
from cotejo.values import PAYMENT_COLUMNS

# Number of leading rows searched by each rule.
NAMED_ROWS = 11
EXACT_ROWS = 11
TOKEN_ROWS = 30
# Cells that mark the header of a payment notice.
FOLIO_PATTERN = rf"folio{SPACE}*fiscal"
NOTICE_TOKENS = ("referencia", "importe", "clc")
# Fixed value: the character put between the cells of a row.
CELL = "\ue010"


def has_names(cells: Column, names: Sequence[str]) -> Column:
    """Every name occurs as a cell."""
    return F.forall(F.array(*[F.lit(n) for n in names]), lambda name: F.array_contains(cells, name))


def equals_names(cells: Column, names: Sequence[str]) -> Column:
    """The trimmed cells that are not blank are exactly the names, in order."""
    filled = F.filter(F.transform(cells, strip), lambda c: c.isNotNull() & ~c.isin("", "nan"))
    return filled == F.array(*[F.lit(n) for n in names])


def header_rows(rows: DataFrame, rule: Column, limit: int) -> DataFrame:
    """(file, header_pos, header): the first row within the limit that satisfies the rule."""
    return (
        rows.filter((F.col("pos") < limit) & rule)
        .groupBy("file")
        .agg(F.min("pos").alias("header_pos"), F.min_by("cells", "pos").alias("header"))
    )


def locate_by_names(rows: DataFrame, names: Sequence[str], limit: int = NAMED_ROWS) -> DataFrame:
    """Header with all the names in the first ``limit`` rows, else the first row."""
    rule = has_names(F.col("cells"), names)
    return (
        rows.filter((F.col("pos") < limit) & (rule | (F.col("pos") == 0)))
        .groupBy("file")
        .agg(
            F.coalesce(F.min(F.when(rule, F.col("pos"))), F.lit(0)).cast("bigint").alias("header_pos"),
            F.coalesce(
                F.min_by(F.when(rule, F.col("cells")), F.when(rule, F.col("pos"))), F.min_by("cells", "pos")
            ).alias("header"),
        )
    )


def locate_exact(rows: DataFrame, names: Sequence[str], limit: int = EXACT_ROWS) -> DataFrame:
    return header_rows(rows, equals_names(F.col("cells"), names), limit)


def locate_notice(rows: DataFrame, limit: int = TOKEN_ROWS) -> DataFrame:
    """Header of a payment notice; plain word searches keep the cell-wise test away from nearly all data rows."""
    row = F.lower(F.array_join("cells", CELL))
    likely = F.lit(True)
    for word in ("folio", "fiscal", *NOTICE_TOKENS):
        likely = likely & F.contains(row, F.lit(word))
    texts = F.transform("cells", lambda c: F.lower(strip(F.coalesce(c, F.lit("")))))
    candidates = rows.filter((F.col("pos") < limit) & likely).select("*", once(texts).alias("_texts"))
    rule = has_names(F.col("_texts"), NOTICE_TOKENS) & F.array_join("_texts", CELL).rlike(FOLIO_PATTERN)
    return header_rows(candidates, rule, limit)


def rejected_files(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Files in which no header was found."""
    return rows.select("file").distinct().join(headers.select("file").hint("merge"), "file", "left_anti")


def rows_below(rows: DataFrame, headers: DataFrame, names: Sequence[str]) -> DataFrame:
    """(file, pos, one column per name) for the rows under each file's header; NULL where a file lacks the name.

    Rows of files without a header place go. An ingest number (``_row_no``) is kept where there is one. Both sides are shuffled:
    cells unfolded from few columns look small to the planner, which would send all rows, or all headers, to the driver.
    """
    places = headers.select(
        "file", "header_pos", *[F.array_position("header", F.lit(n)).cast("int").alias(f"_at_{n}") for n in names]
    )
    joined = join_unique(rows, ["file"], places, ["file"], "inner", strategy="merge")
    number = [c for c in ("_row_no",) if c in rows.columns]
    return joined.filter(F.col("pos") > F.col("header_pos")).select(
        "file", "pos", *number, *[F.when(F.col(f"_at_{n}") > 0, F.try_element_at("cells", F.col(f"_at_{n}"))).alias(n) for n in names]
    )


def normal_notice_headers(headers: DataFrame) -> DataFrame:
    """Normalised header names; the first one with both ``folio`` and ``fiscal`` counts as ``folio_fiscal``."""
    names = F.transform("header", lambda c: normalize_identifier_column(F.coalesce(c, F.lit(""))))
    tidy = headers.select("file", "header_pos", once(names).alias("_names"))
    candidates = F.filter("_names", lambda c: F.contains(c, F.lit("folio")) & F.contains(c, F.lit("fiscal")))
    named = tidy.withColumn("_first", F.try_element_at(candidates, F.lit(1)))
    renamed = F.transform("_names", lambda c: F.when(c == F.col("_first"), F.lit("folio_fiscal")).otherwise(c))
    has_name = F.array_contains("_names", "folio_fiscal")
    return named.select("file", "header_pos", F.when(has_name, F.col("_names")).otherwise(renamed).alias("header"))


def read_notices(rows: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Payment notices as (file, pos, folio_fiscal, referencia, importe, clc)."""
    found = locate_notice(rows) if headers is None else headers
    named = normal_notice_headers(found)
    return rows_below(rows, named.filter(has_names(F.col("header"), PAYMENT_COLUMNS)), PAYMENT_COLUMNS)
