"""Quality counts and extraction alerts."""

from pyspark.sql import Column, DataFrame, functions as F

from cotejo.values import PORTAL_ROW_CAP


def quality_metrics(df: DataFrame, **rules: Column) -> DataFrame:
    """One row: all rows and the rows that satisfy each named rule."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(rule).alias(name) for name, rule in rules.items()])


def page_counts(pages: DataFrame, dataset: str = "dataset") -> DataFrame:
    return pages.groupBy(dataset).agg(F.count(F.lit(1)).alias("pages"))


def partial_extract_alert(current: DataFrame, previous: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Datasets that came back with fewer pages than last time, and those without any."""
    before = previous.select(F.col(dataset).alias("_dataset"), F.col("pages").alias("previous_pages"))
    joined = before.join(current, F.col("_dataset") == F.col(dataset), "left")
    pages = F.coalesce("pages", F.lit(0))
    return joined.filter((pages == 0) | (pages < F.col("previous_pages"))).select(
        F.col("_dataset").alias(dataset),
        "previous_pages",
        pages.cast("bigint").alias("pages"),
        F.when(pages == 0, F.lit("no data")).otherwise(F.lit("partial")).alias("finding"),
    )


def next_page_counts(current: DataFrame, previous: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Counts to keep for the next run: this run's where it has data, else the earlier ones."""
    fresh = current.filter("pages > 0")
    return fresh.unionByName(previous.join(fresh, [dataset], "left_anti"))


def range_overflow(ranges: DataFrame, rows: DataFrame, ts: str, cap: int = PORTAL_ROW_CAP) -> DataFrame:
    """Date ranges (whole days, both ends included) with more than ``cap`` rows.

    Rows are counted per day first and ranges are unfolded into days, so an equi-join on the day replaces the range
    join and its size depends on the calendar only. A range given several times is reported once; one that ends before
    it starts holds no day.
    """
    days = rows.groupBy(F.col(ts).cast("date").alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    forward = ranges.select("start", "end").filter("start <= end").distinct()
    unfolded = forward.withColumn("_range_day", F.explode(F.sequence("start", "end")))
    return (
        unfolded.join(days, F.col("_range_day") == F.col("_day"))
        .groupBy("start", "end")
        .agg(F.sum("_rows").alias("hits"))
        .filter(F.col("hits") > cap)
    )


def extend_last_range(ranges: DataFrame, run_date: str, order: str, start="DATE START", end="DATE END") -> DataFrame:
    """The last complete range ends on the run date; all other rows stay."""
    complete = ranges.dropna(subset=[start, end])
    last = complete.agg(F.max(order)).scalar()
    return ranges.withColumn(
        end, F.when(F.col(order) == last, F.lit(run_date)).otherwise(F.col(f"`{end}`"))
    )
