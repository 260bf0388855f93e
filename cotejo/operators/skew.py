"""Joins against a table with one row per key, in a form whose hot keys Spark can split.

Adaptive execution splits a hot partition of a shuffled join among tasks, but only where both sides come straight from
a shuffle made for that join. A side that was just aggregated on the join key keeps the aggregation's partitioning
instead, and the other side's hot key ends up in one task. The second join key below is 0 on every row, so it changes
no result; it makes Spark shuffle the (already reduced) side once more and thereby lets it split the hot keys of the
other one, missing keys included.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def key_match(names: Sequence[str], others: Sequence[str], null_safe: bool = False) -> Column:
    condition = F.lit(True)
    for a, b in zip(names, others):
        left, right = F.col(f"`{a}`"), F.col(f"`{b}`")
        condition = condition & (left.eqNullSafe(right) if null_safe else left == right)
    return condition


def _zero(names: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in names]), F.lit(1))


def join_unique(
    left: DataFrame,
    left_keys: Sequence[str],
    right: DataFrame,
    right_keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    strategy: str | None = None,
) -> DataFrame:
    """Join with a right side that has at most one row per key; no left row is ever repeated.

    The right key columns are dropped; other right columns that clash with the left ones are an error. ``strategy`` is a join
    hint, for inputs whose size the planner can't tell.
    """
    clash = [c for c in right.columns if c not in right_keys and c in left.columns]
    if clash and how not in ("left_semi", "left_anti"):
        raise ValueError(f"columns on both sides of the join: {clash}")
    names = [f"_right{i}" for i in range(len(right_keys))]
    renamed = right.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(right_keys, names)],
        *[F.col(f"`{c}`") for c in right.columns if c not in right_keys],
    )
    condition = key_match(left_keys, names, null_safe) & (_zero(left_keys) == _zero(names))
    return left.join(renamed if strategy is None else renamed.hint(strategy), condition, how).drop(*names)
