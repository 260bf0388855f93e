"""Append-only history keyed by primary key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cotejo.functions.clean import (
    clean_strings,
    fill_dates_by_name,
    normalize_identifier,
    parse_date_sentinel,
    to_integer,
    to_number,
)
from cotejo.operators.dedup import dedup_first, dedup_last
from cotejo.operators.setops import union_by_name
from cotejo.operators.shape import drop_unnamed, quoted, with_identifiers
from cotejo.values import HISTORY_DATES, HISTORY_DROPPED, HISTORY_INTEGERS, HISTORY_KEY, HISTORY_NUMBERS


def check_key(df: DataFrame, key: Sequence[str]) -> list[str]:
    """Normalised key columns; an error where one is missing."""
    names = [normalize_identifier(k) for k in key]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"primary key columns are missing: {missing}")
    return names


def split_null_keys(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows a primary key would refuse)."""
    names = check_key(df, key)
    full = F.lit(True)
    for name in names:
        full = full & quoted(name).isNotNull()
    return df.filter(full), df.filter(~full)


def new_rows(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence = ("_row_no",), keep: str = "last"
) -> DataFrame:
    """Batch rows to append: one per key, none whose key the target already holds.

    A row with a missing key fails the job, as a primary key would; ``split_null_keys`` sets such rows aside beforehand.
    Both sides of the anti join hold at most one row per key, so no key can be hot.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    names = check_key(batch, key)
    refused = F.raise_error(F.lit(f"missing value in the primary key ({', '.join(names)})"))
    full = F.lit(True)
    for name in names:
        full = full & quoted(name).isNotNull()
    rows = batch.filter(F.when(full, F.lit(True)).otherwise(refused.cast("boolean")))
    single = dedup_last(rows, names, order) if keep == "last" else dedup_first(rows, names, order)
    return single.join(target.select(*[quoted(n) for n in names]), names, "left_anti")


def only_between(target: DataFrame, batch: DataFrame, snapshot: str) -> DataFrame:
    """Target rows between the batch's first and last snapshot; one scalar subquery with both bounds prunes its partitions."""
    value = F.col(snapshot)
    ends = batch.select(value.alias("_at")).agg(F.struct(F.min("_at").alias("first"), F.max("_at").alias("last"))).scalar()
    return target.filter((value >= ends["first"]) & (value <= ends["last"]))


def insert_if_absent(target, batch, key, order=("_row_no",), keep="last") -> DataFrame:
    """The target after the insert; rows already there never change."""
    return target.unionByName(new_rows(target, batch, key, order, keep), allowMissingColumns=True)


def prepare_history(
    frames: Sequence[DataFrame],
    dropped=HISTORY_DROPPED,
    dates=HISTORY_DATES,
    integers=HISTORY_INTEGERS,
    numbers=HISTORY_NUMBERS,
    on_fraction: str = "error",
) -> DataFrame:
    """Union, drop, type and clean the snapshot tables into rows ready for ``insert_if_absent``."""
    df = drop_unnamed(union_by_name(frames).drop(*dropped))
    typed = {c: parse_date_sentinel(quoted(c)) for c in dates if c in df.columns}
    typed |= {c: to_integer(quoted(c), on_fraction) for c in integers if c in df.columns}
    typed |= {c: to_number(quoted(c)) for c in numbers if c in df.columns}
    return fill_dates_by_name(with_identifiers(clean_strings(df.withColumns(typed))))


def load_history(target: DataFrame, frames: Sequence[DataFrame], order=("_row_no",), key=HISTORY_KEY, **options):
    return insert_if_absent(target, prepare_history(frames, **options), key, order, keep="last")


def load_history_split(
    target: DataFrame, frames: Sequence[DataFrame], order=("_row_no",), key=HISTORY_KEY, **options
) -> tuple[DataFrame, DataFrame]:
    """(the target after the load, rows that a primary key would refuse)."""
    full, rejected = split_null_keys(prepare_history(frames, **options), key)
    return insert_if_absent(target, full, key, order, keep="last"), rejected


def latest_snapshot(history: DataFrame, snapshot: str = "file_date") -> DataFrame:
    """Rows of the newest snapshot; the scalar subquery prunes the scan on a table partitioned by snapshot."""
    return history.filter(F.col(snapshot) == history.agg(F.max(snapshot)).scalar())


def lookup_orders(rows: DataFrame, orders: Sequence[str]) -> DataFrame:
    return rows.filter(F.col("numero_orden_suministro").isin(*orders)).select("numero_orden_suministro", "estado_de_la_factura", "importe")


def latest_snapshot_lookup(history: DataFrame, orders: Sequence[str], snapshot: str = "file_date") -> DataFrame:
    return lookup_orders(latest_snapshot(history, snapshot), orders)
