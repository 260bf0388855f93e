"""Amounts by status, between two snapshots and around a cut-off date.

Everything is one map-side-combined aggregation over the scan; all later steps work on one row per status.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from cotejo.functions.clean import format_currency, format_percent, to_number
from cotejo.operators.shape import quoted, resolve_column
from cotejo.values import GRAND_TOTAL_LABEL, SUBTOTAL_LABEL, TOTAL_LABEL

PERIODS = ("raw", "before", "after")


def _period_filters(date: str, cutoff) -> dict[str, Column]:
    day = F.col(date).cast("date")
    limit = F.lit(cutoff).cast("date")
    return {"raw": F.lit(True), "before": day < limit, "after": day >= limit}


def _amount(column: str) -> Column:
    return F.coalesce(to_number(quoted(column)), F.lit(0.0))


def _numeric_amount(df: DataFrame, column: str) -> Column:
    """Numbers need no text check; text is coerced."""
    kind = dict(df.dtypes)[column]
    return F.coalesce(quoted(column).cast("double"), F.lit(0.0)) if kind != "string" else _amount(column)


def status_split(df: DataFrame, cutoff, amount="importe", date="fechaaltatrunc", status: str | None = None):
    """Amount per status over all rows, before and from the cut-off; NULL where the status has no row on that side."""
    status = resolve_column(df, "estado", override=status)
    value = _numeric_amount(df, amount)
    sums = [F.sum(F.when(rule, value)).alias(p) for p, rule in _period_filters(date, cutoff).items()]
    return df.filter(quoted(status).isNotNull()).groupBy(quoted(status).alias("status")).agg(*sums)


def partial_sums(df: DataFrame, amount="importe", date="fechaaltatrunc", snapshot="file_date", status: str | None = None) -> DataFrame:
    """Amounts per snapshot, status and day under the columns' own names: a table that reports can read in place of the rows.

    Sums of sums are sums, so the parts of several appends stand side by side and any cut-off date can be asked for.
    Rows without a status count in no report and are left out.
    """
    status = resolve_column(df, "estado", override=status)
    value = _numeric_amount(df, amount).alias(amount)
    rows = df.filter(quoted(status).isNotNull()).select(snapshot, quoted(status).alias(status), F.col(date).cast("date").alias(date), value)
    return rows.groupBy(snapshot, quoted(status), date).agg(F.sum(quoted(amount)).alias(amount), F.count(F.lit(1)).alias("rows"))


def snapshots(df: DataFrame, column: str = "file_date") -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def snapshot_compare(
    df: DataFrame, previous, current, cutoff, amount="importe", date="fechaaltatrunc", snapshot="file_date", status=None
) -> DataFrame:
    """(period, status, previous, current); a status missing on one side counts 0 there."""
    if previous == current:
        raise ValueError("previous and current snapshot must differ")
    status = resolve_column(df, "estado", override=status)
    value = _numeric_amount(df, amount)
    sides = {n: F.lit(str(v)).cast("timestamp_ntz") for n, v in (("previous", previous), ("current", current))}
    sums = [
        F.sum(F.when(rule & (F.col(snapshot) == stamp), value)).alias(f"{period}_{side}")
        for period, rule in _period_filters(date, cutoff).items()
        for side, stamp in sides.items()
    ]
    wide = (
        df.filter(F.col(snapshot).isin(*sides.values()) & quoted(status).isNotNull())
        .groupBy(quoted(status).alias("status"))
        .agg(*sums)
    )
    rows = F.array(
        *[
            F.struct(F.lit(p).alias("period"), *[F.col(f"{p}_{side}").alias(side) for side in sides])
            for p in PERIODS
        ]
    )
    return (
        wide.select("status", F.explode(rows).alias("_row"))
        .select("_row.period", "status", "_row.previous", "_row.current")
        .filter("previous is not null or current is not null")
        .fillna(0.0, subset=["previous", "current"])
    )


def snapshot_totals(compared: DataFrame) -> DataFrame:
    """Adds delta, delta in percent and the period total, plus a total row per period with its own percentage."""
    summed = (
        compared.rollup("period", "status")
        .agg(
            F.grouping("period").alias("_all_periods"),
            F.grouping("status").alias("is_total"),
            F.sum("previous").alias("previous"),
            F.sum("current").alias("current"),
        )
        .filter("_all_periods = 0")
    )
    delta = F.col("current") - F.col("previous")
    return summed.select(
        "period",
        F.when(F.col("is_total") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("status")).alias("status"),
        (F.col("is_total") == 1).alias("is_total"),
        "previous",
        "current",
        delta.alias("delta"),
        F.when(F.col("previous") != 0, delta / F.col("previous") * 100).alias("delta_pct"),
        (F.col("previous") + F.col("current")).alias("total_period"),
    )


def snapshot_top(totals: DataFrame, period: str | None = None, rows: int | None = None) -> DataFrame:
    """Per period the largest current amount first, the total last; ``rows`` limits the statuses, never the total."""
    chosen = totals if period is None else totals.filter(F.col("period") == period)
    if rows is not None:
        place = F.row_number().over(Window.partitionBy("period", "is_total").orderBy(F.desc("current"), "status"))
        chosen = chosen.withColumn("_place", place).filter(F.col("is_total") | (F.col("_place") <= rows)).drop("_place")
    return chosen.orderBy("period", "is_total", F.desc("current"), "status")


def snapshot_formatted(totals: DataFrame) -> DataFrame:
    return totals.select(
        "period",
        "status",
        *[format_currency(c).alias(c) for c in ("previous", "current", "delta")],
        format_percent("delta_pct").alias("delta_pct"),
    )


def rollup_report(df: DataFrame, group: str, detail: str, amount: str) -> DataFrame:
    """Detail rows with a subtotal per group and a grand total, labelled."""
    rolled = df.rollup(group, detail).agg(
        F.grouping(group).alias("_g"), F.grouping(detail).alias("_d"), F.sum(amount).alias("amount")
    )
    return rolled.select(
        F.when(F.col("_g") == 1, F.lit(GRAND_TOTAL_LABEL)).otherwise(F.col(group).cast("string")).alias("group_label"),
        F.when(F.col("_g") == 1, F.lit(""))
        .when(F.col("_d") == 1, F.lit(SUBTOTAL_LABEL))
        .otherwise(F.col(detail).cast("string"))
        .alias("detail_label"),
        "amount",
    )
