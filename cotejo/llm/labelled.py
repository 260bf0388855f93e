"""Bounded samples of labelled documents, for fitting."""

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# A model is fitted on at most so many labelled rows (the ones with the least id hash, so a fixed set of each table).
FIT_ROWS = 2000
HELD_OUT_OF, HELD_OUT = 3, 1  # rows whose crc32(doc_id as text) leaves this remainder are never learnt from


def held_out(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(HELD_OUT_OF)) == HELD_OUT


def least_hashed(df: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the least hash of their id.

    Rows above twice the hash expected for them leave in the scan, so that what a task hands on for sorting doesn't grow
    with the number of tasks. (Should that leave too few, the sample is smaller.)
    """
    place = F.xxhash64("doc_id").bitwiseAND(F.lit(2**63 - 1))
    rows = df.count()
    near = df if rows <= 4 * most else df.where(place < F.lit(2 * most * 2**63 // rows))
    return near.orderBy(place, "doc_id").limit(most)


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int = FIT_ROWS, *more: str) -> pd.DataFrame:
    """doc_id, text, label and the named columns of at most ``most`` labelled documents outside the held-out third.

    Chosen among the labels alone; the documents are then looked up by the chosen ids. Labels other than 0 and 1,
    missing ids and repeated ids (the least label counts) don't disturb.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    chosen = least_hashed(usable.groupBy("doc_id").agg(F.min(label).alias("_label")), most)
    rows = docs.select("doc_id", "text", *more).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    rows["text"] = rows["text"].fillna("")
    return rows.rename(columns={"_label": label})
