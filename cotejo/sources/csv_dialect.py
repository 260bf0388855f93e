r"""Comma-separated exports with ``"`` quotes, ``\`` escapes inside and outside quotes, and ``\N`` for NULL.

Spark's CSV reader drops short lines and splits at escaped commas outside quotes in this dialect, so escapes are
hidden behind private characters before ``from_csv`` and restored afterwards. All values stay text.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cotejo.functions.clean import as_column, once
from cotejo.operators.skew import join_unique
from cotejo.sources.lines import file_bounds, read_lines, with_row_numbers
from cotejo.sources.records import read_records

# Private-use characters that stand for escaped ones while a line is parsed.
BACKSLASH, COMMA, QUOTE, NULL_CELL, END = "", "", "", "", ""
EXTRA = "_extra"

# Most cells of a line, where no header tells their number.
WIDTH = 256

# Cells that the exports use for "no value", compared exactly.
NO_VALUE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

def _hide(line: Column) -> Column:
    hidden = F.replace(line, F.lit("\\\\"), F.lit(BACKSLASH))
    hidden = F.replace(hidden, F.lit("\\,"), F.lit(COMMA))
    hidden = F.replace(hidden, F.lit('\\"'), F.lit(QUOTE))
    hidden = F.regexp_replace(hidden, r"\\N(?=,|$)", NULL_CELL)
    return F.replace(hidden, F.lit("\\"), F.lit(""))


def _show(cell: Column) -> Column:
    text = F.replace(cell, F.lit(BACKSLASH), F.lit("\\"))
    text = F.replace(text, F.lit(COMMA), F.lit(","))
    text = F.replace(text, F.lit(QUOTE), F.lit('"'))
    return F.when(~cell.isin(NULL_CELL, END, *NO_VALUE), text)


def parse_lines(lines: DataFrame, columns: Sequence[str], line: str = "line") -> DataFrame:
    """Cells of every line: short lines are padded with NULL, those with too many cells are left to ``wide_lines``.

    An end mark is appended to each line; only where a line has too many cells is it out of sight.
    """
    schema = ", ".join(f"`{c}` string" for c in [*columns, EXTRA])
    marked = F.concat(_hide(as_column(line)), F.lit(f",{END}"))
    cells = F.from_csv(marked, F.lit(schema), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    others = [F.col(f"`{c}`") for c in lines.columns if c != line]
    parsed = lines.filter(F.length(line) > 0).select(*others, once(cells).alias("_cells"))
    ends = F.array(*[F.col(f"_cells.`{c}`") for c in [*columns, EXTRA]])
    return parsed.filter(F.array_contains(ends, END)).select(
        *others, *[_show(F.col(f"_cells.`{c}`")).alias(c) for c in columns]
    )


def wide_lines(lines: DataFrame, columns: Sequence[str], line: str = "line") -> DataFrame:
    """Lines that ``parse_lines`` leaves out because they have more cells than there are columns."""
    cells = split_cells(lines.filter(F.length(line) > 0), len(columns), line)
    return cells.filter("cells is null").drop("cells")


def split_cells(lines: DataFrame, width: int = WIDTH, line: str = "line") -> DataFrame:
    """Adds ``cells``, the cell texts of each line; NULL where it has more than ``width``."""
    names = [f"c{i}" for i in range(width + 1)]
    schema = ", ".join(f"{c} string" for c in names)
    marked = F.concat(_hide(as_column(line)), F.lit(f",{END}"))
    parsed = once(F.from_csv(marked, F.lit(schema), {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxColumns": str(width + 2)}))
    split = lines.select("*", parsed.alias("_cells")).withColumn("_cells", F.array(*[F.col(f"_cells.{c}") for c in names]))
    end = F.array_position("_cells", END).cast("int")
    shown = F.transform(F.slice("_cells", 1, F.greatest(end - 1, F.lit(0))), _show)
    return split.withColumn("cells", F.when(end > 0, shown)).drop("_cells")


def read_sheet_rows(spark: SparkSession, path: str, line_breaks: bool = False, width: int = WIDTH) -> DataFrame:
    """(file, pos, cells, _row_no, line) of every line of all files that isn't blank: what the sheet rules work on."""
    edges = file_bounds(spark, path)
    lines = with_row_numbers(read_records(spark, path) if line_breaks else read_lines(spark, path), edges)
    return split_cells(lines.filter(F.length("line") > 0), width).select("file", F.col("pos").cast("bigint").alias("pos"), "cells", F.col("_row_no").cast("bigint").alias("_row_no"), "line")


def first_rows(rows: DataFrame) -> DataFrame:
    """(file, header_pos, header): the first row of each file is its header."""
    return rows.groupBy("file").agg(F.min("pos").alias("header_pos"), F.min_by("cells", "pos").alias("header"))


def header_sets(rows: DataFrame) -> DataFrame:
    """(names, files): files by the set of their header's names, whatever the order."""
    return first_rows(rows).groupBy(F.array_sort("header").alias("names")).agg(F.array_sort(F.collect_list("file")).alias("files"))


def rows_by_header(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of sheet rows (file, pos, cells, ...), every file read by its own header.

    Cells are found by name, so files may order the columns as they like; short lines are padded with NULL. Rejects
    have a reason: all lines of a file whose header has other names, and lines with more cells than their header.
    """
    known = F.array_sort("header") == F.array_sort(F.array(*map(F.lit, columns)))
    places = first_rows(rows).select(
        "file", "header_pos", F.coalesce(known, F.lit(False)).alias("_known"), F.size("header").alias("_size"),
        *[F.array_position("header", F.lit(c)).cast("int").alias(f"_at{i}") for i, c in enumerate(columns)],
    )
    joined = join_unique(rows, ["file"], places, ["file"], "inner")
    reason = F.when(~F.col("_known"), F.lit("unknown header")).when(
        F.col("cells").isNull() | (F.size("cells") > F.col("_size")), F.lit("too many cells")
    )
    judged = joined.withColumn("reason", reason)
    others = [c for c in rows.columns if c != "cells"]
    rejects = judged.filter("reason is not null").select(*others, "cells", "reason")
    good = judged.filter(F.col("reason").isNull() & (F.col("pos") > F.col("header_pos")))
    return good.select(*others, *[F.try_element_at("cells", F.col(f"_at{i}")).alias(c) for i, c in enumerate(columns)]), rejects


def read_csv_dialect(
    spark: SparkSession, path: str, columns: Sequence[str], line_breaks: bool = False, width: int = WIDTH
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all files of a path, each read by its own header; see ``rows_by_header``.

    ``line_breaks`` is for files whose quoted cells hold line breaks, see ``read_records``.
    """
    rows, rejects = rows_by_header(read_sheet_rows(spark, path, line_breaks, width), columns)
    return rows.drop("line"), rejects
