"""Rows of tables in saved HTML pages."""

from pyspark.sql import Column, DataFrame, functions as F

from cotejo.functions.clean import SPACE, as_column, once, strip

# Character references decoded in cell texts; the ampersand comes last.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def blocks(html, tag: str) -> Column:
    """Contents of every element with the tag (or one of ``a|b``), outermost text as written."""
    pattern = rf"(?is)<(?:{tag})(?:\s[^>]*)?>(.*?)</(?:{tag})\s*>"
    return F.regexp_extract_all(as_column(html), F.lit(pattern), F.lit(1))


def cell_text(cell: Column) -> Column:
    text = F.regexp_replace(cell, "<[^>]*>", "")
    for entity, shown in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(shown))
    return strip(F.regexp_replace(text, rf"{SPACE}+", " "))


def element_rows(pages: DataFrame, key: str, html: str, container: str, row: str, cell: str | None = None) -> DataFrame:
    """(key, container_no, row_no, cells) of every container; without a cell tag the row itself is the only cell."""
    texts = (
        F.transform(blocks(F.col("row_html"), cell), cell_text) if cell else F.array(cell_text(F.col("row_html")))
    )
    return (
        pages.select(F.col(key), F.posexplode(blocks(html, container)).alias("container_no", "_own"))
        .select(key, "container_no", F.posexplode(blocks("_own", row)).alias("row_no", "row_html"))
        .select(key, *[F.col(c).cast("bigint").alias(c) for c in ("container_no", "row_no")], texts.alias("cells"))
    )


def table_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, row_no, header, cells) of the first table of each page; its first row is the header."""
    first = F.try_element_at(blocks(html, "table"), F.lit(1))
    parsed = F.transform(blocks(first, "tr"), lambda r: F.transform(blocks(r, "td|th"), cell_text))
    return (
        pages.select(F.col(key), once(parsed).alias("_rows"))
        .select(key, F.try_element_at("_rows", F.lit(1)).alias("header"), F.posexplode("_rows").alias("row_no", "cells"))
        .filter("row_no > 0")
        .select(key, F.col("row_no").cast("bigint").alias("row_no"), "header", "cells")
    )


def named_cells(rows: DataFrame, names) -> DataFrame:
    """Cells as columns, found through each page's header."""
    position = {n: F.array_position("header", F.lit(n)).cast("int") for n in names}
    return rows.select(
        *[F.col(c) for c in rows.columns if c not in ("header", "cells")],
        *[
            F.when(p > 0, F.nullif(F.try_element_at("cells", p), F.lit(""))).alias(n) for n, p in position.items()
        ],
    )
