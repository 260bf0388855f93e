"""Unions of tables with differing headers."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by column position under the first table's names; narrower tables are padded with NULL."""
    names = frames[0].columns
    too_wide = [len(f.columns) for f in frames if len(f.columns) > len(names)]
    if too_wide:
        raise ValueError(f"tables are wider than the first one ({len(names)} columns): {too_wide}")
    slots = [f"_slot{i}" for i in range(len(names))]
    return union_by_name([f.toDF(*slots[: len(f.columns)]) for f in frames]).toDF(*names)


def concat_by_header(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """One table per set of column names, in order of first appearance; duplicates stay."""
    groups: dict[tuple[str, ...], list[DataFrame]] = {}
    for frame in frames:
        groups.setdefault(tuple(sorted(frame.columns)), []).append(frame)
    return [union_by_name(group) for group in groups.values()]
