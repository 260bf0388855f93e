"""Writers. Every write is one job-level commit, so a lost executor only repeats its tasks."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cotejo.operators.history import check_key, new_rows, only_between
from cotejo.operators.setops import concat_by_header


def write_sheet(frame: DataFrame, root: str, sheet: str, group_id: str) -> DataFrame:
    """Replace one group of a sheet dataset (``root/<sheet>/group_id=<id>``) and read it back.

    A table without rows leaves a group without rows; asking first whether it has any would run the whole plan twice.
    """
    path = f"{root}/{sheet}/group_id={group_id}"
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def write_sheets(sheets: Mapping[str, DataFrame], root: str, group_id: str) -> dict[str, DataFrame]:
    return {sheet: write_sheet(frame, root, sheet, group_id) for sheet, frame in sheets.items()}


def write_by_header(frames: Sequence[DataFrame], root: str, name: str) -> list[str]:
    """One dataset per header set; a number is added only where there are several."""
    groups = concat_by_header(frames)
    paths = [f"{root}/{name}" if len(groups) == 1 else f"{root}/{name}_{i}" for i in range(len(groups))]
    for path, group in zip(paths, groups):
        group.write.mode("overwrite").parquet(path)
    return paths


def write_split(flagged: DataFrame, root: str, flag: str = "accepted") -> None:
    """Accepted and rejected rows side by side in one pass over the input."""
    flagged.write.mode("overwrite").partitionBy(flag).parquet(root)


def write_counted(flagged: DataFrame, root: str, flag: str = "accepted", **rules: Column) -> dict[str, int]:
    """``write_split``, and what ``quality_metrics`` counts of the same rows, gathered by the tasks that write them.

    The counts are those of the tasks whose output was committed: a task that is repeated counts once.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(rule).alias(name) for name, rule in rules.items()]]
    write_split(flagged.observe(seen, *counts), root, flag)
    return {name: seen.get.get(name) or 0 for name in ("rows", *rules)}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def create_table(
    spark: SparkSession, table: str, df: DataFrame, key: Sequence[str], partition: str | None = None
) -> None:
    """Create schema and table from the frame's columns if they are missing; the key columns must exist."""
    check_key(df, key)
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        by = f" PARTITIONED BY (`{partition}`)" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by}")


def append_history(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence = ("_row_no",),
    keep: str = "last",
    partition: str = "file_date",
) -> None:
    """Append the keys the table does not hold yet (single writer).

    When the partition column is part of the key, the target is read only between the batch's first and last snapshot:
    a scalar subquery prunes its partitions. Columns of the table that the batch lacks become NULL; columns that the
    table lacks are an error. A batch with a long plan should be stored first, since those bounds read it once more.
    Appends that are all or nothing for readers, too, are those of ``snapshots.HistoryTable``.
    """
    hidden = [c for c in order if isinstance(c, str) and c.startswith("_")]
    names = check_key(batch, key)
    create_table(spark, table, batch.drop(*hidden), key, partition if partition in batch.columns else None)
    target = spark.table(table)
    if partition in names and partition in target.columns:
        target = only_between(target, batch, partition)
    rows = new_rows(target, batch, key, order, keep).drop(*hidden)
    fields = spark.table(table).schema.fields
    unknown = [c for c in rows.columns if c not in {f.name for f in fields}]
    if unknown:
        raise ValueError(f"columns that the table {table} lacks: {unknown}")
    # insertInto goes by position.
    values = [F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    rows.select(*values).write.mode("append").insertInto(table)


def append_jdbc(rows: DataFrame, url: str, table: str, **options) -> None:
    """Append to a warehouse table in batches of 10,000 rows."""
    rows.write.format("jdbc").options(url=url, dbtable=table, batchsize="10000", **options).mode("append").save()
