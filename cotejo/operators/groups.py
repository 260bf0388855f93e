"""Anchored snapshot groups: a file joins the open group while it is at most two hours after the group's first file.

File stamps have whole hours, so the distinct stamps of one key are bounded by the calendar (8,784 a year) whatever
the number of files. Anchors are worked out on those distinct stamps only; the files themselves are merely joined to
the result or reduced to one row per stamp and category first.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cotejo.functions.clean import hour_stamp, hour_text
from cotejo.operators.skew import join_unique
from cotejo.values import GROUP_SPAN_HOURS


def _anchored(stamps: Column, span: Column) -> Column:
    """(ts, anchor) of ascending stamps: an anchor is the first stamp, then each first one beyond the last anchor's span."""

    def step(pairs: Column, ts: Column) -> Column:
        last = F.element_at(pairs, -1)["anchor"]
        anchor = F.when(ts > last + span, ts).otherwise(last)
        return F.array_append(pairs, F.struct(ts.alias("ts"), anchor.alias("anchor")))

    first = F.transform(F.slice(stamps, 1, 1), lambda ts: F.struct(ts.alias("ts"), ts.alias("anchor")))
    return F.aggregate(F.slice(stamps, 2, F.size(stamps)), first, step)


def stamp_anchors(files: DataFrame, keys: Sequence[str], ts: str = "ts", hours: int = GROUP_SPAN_HOURS) -> DataFrame:
    """(keys, ts, anchor) for every distinct stamp.

    A gap above the span always opens a new group, so it cuts the stamps into islands that are solved side by side.
    Stamps are cut to the hour, which bounds their number.
    """
    span = F.expr(f"interval '{hours}' hour")
    stamps = files.select(*keys, F.date_trunc("hour", ts).cast(files.schema[ts].dataType).alias("ts")).filter("ts is not null").distinct()
    ordered = Window.partitionBy(*keys).orderBy("ts")
    islands = stamps.withColumn(
        "_opens", F.coalesce((F.col("ts") > F.lag("ts").over(ordered) + span).cast("int"), F.lit(1))
    ).withColumn("_island", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    solved = islands.groupBy(*keys, "_island").agg(_anchored(F.array_sort(F.collect_list("ts")), span).alias("_pairs"))
    return solved.select(*keys, F.inline("_pairs"))


def _global_key(files: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without keys there is one file list; its distinct stamps still fit one task."""
    return (files, list(keys)) if keys else (files.withColumn("_all", F.lit(0)), ["_all"])


def anchored_groups(files: DataFrame, keys: Sequence[str] = (), ts: str = "ts", hours: int = GROUP_SPAN_HOURS):
    """Every file with the anchor of its group; files without a stamp are left out.

    Stamps count by their hour, as file names give them; ``anchors.exact_groups`` takes them as they are.
    """
    keyed, names = _global_key(files, keys)
    anchors = stamp_anchors(keyed, names, ts, hours)
    stamped = keyed.filter(F.col(ts).isNotNull()).withColumn("_hour", F.date_trunc("hour", ts).cast(files.schema[ts].dataType))
    return _with_anchor(stamped, anchors, names, "_hour").drop("_all", "_hour")


def _with_anchor(stamped: DataFrame, anchors: DataFrame, names: Sequence[str], ts: str) -> DataFrame:
    """Rows with the anchor of their key and stamp; a missing key is a key like any other."""
    pairs = [f"_k{i}" for i in range(len(names))]
    return join_unique(stamped, [*names, ts], anchors.toDF(*pairs, "_ts", "anchor"), [*pairs, "_ts"], "inner", null_safe=True)


def snapshot_groups(
    files: DataFrame,
    categories: Sequence[str],
    keys: Sequence[str] = (),
    ts: str = "ts",
    category: str = "category",
    path: str = "path",
    hours: int = GROUP_SPAN_HOURS,
) -> DataFrame:
    """One row per group: id, first and last stamp, and the last path of every category (NULL if absent)."""
    keyed, names = _global_key(files.filter(F.col(category).isin(*categories)), keys)
    reduced = (
        keyed.filter(F.col(ts).isNotNull())
        .groupBy(*names, F.date_trunc("hour", ts).cast(files.schema[ts].dataType).alias("ts"), F.col(category).alias("category"))
        .agg(F.max(path).alias("path"))
    )
    anchors = stamp_anchors(reduced, names, hours=hours)
    grouped = _with_anchor(reduced, anchors, names, "ts").groupBy(*names, "anchor")
    latest = F.struct("ts", "path")
    rows = grouped.agg(
        F.max("ts").alias("last_ts"),
        *[F.max(F.when(F.col("category") == c, latest)).alias(c) for c in categories],
    )
    return rows.select(
        *names,
        F.concat(hour_stamp("anchor"), F.lit("_"), hour_text("last_ts")).alias("group_id"),
        F.col("anchor").alias("first_ts"),
        "last_ts",
        *[F.col(f"`{c}`.path").alias(c) for c in categories],
        *[F.col(f"`{c}`.ts").alias(f"{c}_ts") for c in categories],
    ).drop("_all")


def complete_groups(groups: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Groups that hold every category."""
    return groups.dropna(subset=list(categories))


def newest_first(groups: DataFrame, *ties: str) -> DataFrame:
    """Newest day first; groups of one day in ascending order."""
    return groups.orderBy(F.desc(F.substring("group_id", 1, 10)), "group_id", *ties)


def with_hour_agreement(groups: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Adds ``same_hour``: the last files of all present categories carry the same hour."""
    hours = F.filter(F.array(*[hour_stamp(f"`{c}_ts`") for c in categories]), lambda h: h.isNotNull())
    return groups.withColumn("same_hour", F.size(F.array_distinct(hours)) == 1)


def hour_agreement_counts(groups: DataFrame, categories: Sequence[str]) -> DataFrame:
    flagged = with_hour_agreement(groups, categories)
    return flagged.agg(
        F.count_if("same_hour").alias("same_hour_groups"), F.count_if(~F.col("same_hour")).alias("different_groups")
    )
