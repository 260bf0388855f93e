"""Keep-first and keep-last rules.

``row_number() = 1`` makes Spark limit each key inside every map task before the shuffle, so a key holding a third of
the rows sends one row per map task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_rows(df: DataFrame, keys: Sequence, order: Sequence, limit: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``limit`` rows of every key; ``rank`` names a column for their position."""
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)
    return ranked if rank else ranked.drop(name)


def _descending(order: Sequence) -> list[Column]:
    return [F.desc(c) if isinstance(c, str) else c.desc() for c in order]


def dedup_first(df: DataFrame, keys: Sequence, order: Sequence = ("_row_no",)) -> DataFrame:
    return top_rows(df, keys, order)


def dedup_last(df: DataFrame, keys: Sequence, order: Sequence = ("_row_no",)) -> DataFrame:
    return top_rows(df, keys, _descending(order))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a keep-one rule removes, and on how many keys."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )
