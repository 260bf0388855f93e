"""Sheet datasets and the warehouse table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from cotejo.operators.setops import union_by_name
from cotejo.operators.shape import clean_table, has_values, require_columns


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_dataset(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """A Parquet dataset; where it does not exist, an empty table with the schema, or None without one."""
    reader = spark.read.option("mergeSchema", True)
    try:
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return None if schema is None else empty(spark, schema)


def read_sheet(spark: SparkSession, root: str, sheet: str, fallback: str | None = None, schema=None) -> DataFrame:
    """A sheet dataset by name, else the fallback sheet, else an empty table with the given schema."""
    for name in [n for n in (sheet, fallback) if n is not None]:
        found = read_dataset(spark, f"{root}/{name}")
        if found is not None:
            return found
    if schema is None:
        raise ValueError(f"no sheet {sheet!r} under {root}")
    return empty(spark, schema)


def read_sheets(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """One cleaned table per sheet dataset; tables without any value are left out."""
    tables = [clean_table(spark.read.parquet(path)) for path in paths]
    return [table for table in tables if has_values(table)]


def union_sheets(frames: Sequence[DataFrame]) -> DataFrame:
    return union_by_name([clean_table(frame) for frame in frames])


def scan_history_sheets(spark: SparkSession, root: str, sheet: str, schema: StructType | str | None = None) -> DataFrame:
    """One named sheet of all integration outputs; an unreadable file fails the job. A schema saves reading all footers."""
    reader = spark.read if schema is not None else spark.read.option("mergeSchema", True)
    return (reader.schema(schema) if schema is not None else reader).parquet(f"{root}/{sheet}")


def scan_readable_sheets(spark: SparkSession, root: str, sheet: str, schema: StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of the files that can be read in full, paths of the others).

    A file counts as readable if as many rows can be decoded as its footer announces; of a damaged file no row is kept.
    All files are read twice for it.
    """
    path = f"{root}/{sheet}"
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("path"))
    reader = spark.read.option("ignoreCorruptFiles", True)
    rows = (reader.option("mergeSchema", True) if schema is None else reader.schema(schema)).parquet(path)
    names = [F.col(f"`{c}`") for c in rows.columns]
    file = F.col("_metadata.file_path")
    announced = rows.select(file.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("announced"))
    # The hash is asked for so that every column is decoded; a count alone would read none.
    hashed = rows.select(file.alias("path"), F.xxhash64(*names).alias("_hash"))
    decoded = hashed.groupBy("path").agg(F.count(F.lit(1)).alias("decoded"), F.max("_hash").alias("_seen"))
    good = announced.join(decoded, "path").filter("announced = decoded and _seen is not null").select(F.col("path").alias("_good"))
    kept = rows.select("*", file.alias("_path")).join(good, F.col("_path") == F.col("_good"), "left_semi").drop("_path")
    return kept, listed.join(good, F.col("path") == F.col("_good"), "left_anti")


def read_warehouse(
    spark: SparkSession, url: str, table: str, partition: str = "file_date", bounds=None, parts: int = 64, **options
) -> DataFrame:
    """A warehouse table over JDBC; with bounds it is read in parallel slices of the partition column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if bounds is not None:
        lower, upper = bounds
        reader = reader.options(
            partitionColumn=partition, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
        )
    return reader.load()


def read_work_list(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Rows of a work list; a list without its columns or without rows is an error."""
    found = require_columns(spark.read.option("header", True).csv(path), required)
    if found.isEmpty():
        raise ValueError(f"the work list {path} has no rows")
    return found


def read_receipt_list(spark: SparkSession, path: str, folio: str) -> DataFrame:
    """Distinct folios of a work list, trimmed; a list without any is an error."""
    folios = read_work_list(spark, path, [folio]).select(F.trim(f"`{folio}`").alias(folio)).filter(F.col(f"`{folio}`") != "").distinct()
    if folios.isEmpty():
        raise ValueError(f"the work list {path} has no folios")
    return folios


def read_ranges(calendar: DataFrame, start: str = "DATE START", end: str = "DATE END") -> DataFrame:
    """Calendar rows with both bounds present."""
    return calendar.dropna(subset=[start, end])


def ranges_as_dates(calendar: DataFrame, start: str = "DATE START", end: str = "DATE END") -> DataFrame:
    return read_ranges(calendar, start, end).select(
        F.try_to_date(F.col(f"`{start}`"), "d/M/yyyy").alias("start"),
        F.try_to_date(F.col(f"`{end}`"), "d/M/yyyy").alias("end"),
    )
