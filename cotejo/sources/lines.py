"""Text files as ordered lines, split over tasks like any other scan."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cotejo.operators import ranges

LINE_ORDER = ("block", "line_id")

# Fixed value: the mark some exports put at the start of a file.
BOM = "^\ufeff"


def read_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """(file, file_name, block, line_id, line); block and line_id give the order inside a file.

    A large file is read by many tasks: ``block`` is the byte offset of a task's slice, ``line_id`` ascends inside it.
    """
    lines = spark.read.options(**options).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.regexp_replace("value", BOM, "").alias("line"),
    )


def file_bounds(spark: SparkSession, path: str, **options) -> list[str]:
    """Bounds of even ranges of a path's files, from their listing alone."""
    listed = spark.read.options(**options).format("binaryFile").load(path)
    return ranges.bounds(listed.select(F.col("_metadata.file_path").alias("file")), "file", [])


def with_row_numbers(lines: DataFrame, edges: Sequence[str] | None = None) -> DataFrame:
    """Adds ``pos``, the line's position in its file, and ``_row_no``, its position among all lines by file and place.

    Both count from 0 without gaps, and are the same however the files are split among tasks. Only the slices (one small row
    each) are ordered: a line's place in its slice is known from the ascending ids. Slices are counted up inside ranges of files
    between ``edges`` (see ``file_bounds``; without any the files are read once more for them), and the totals of the
    ranges before are added back, so that no task sees all slices.
    """
    if edges is None:
        edges = ranges.bounds(lines.select("file").distinct(), "file", [])
    slices = lines.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block")).agg(
        F.min("line_id").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    slices = slices.withColumn("_range", ranges.below("_file", edges))
    inside = Window.partitionBy("_range").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("_range", "_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.element_at(ranges.before(slices, "_range", F.col("_lines"), "sum", len(edges)), F.col("_range") + 1)
    starts = slices.withColumns({
        "_start": earlier + F.coalesce(F.sum("_lines").over(inside), F.lit(0)),
        "_in_file": F.coalesce(F.sum("_lines").over(of_file), F.lit(0)),
    }).drop("_lines", "_range")
    joined = lines.join(starts, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    place = F.col("line_id") - F.col("_first")
    return joined.withColumns({"pos": F.col("_in_file") + place, "_row_no": F.col("_start") + place}).drop(
        "_file", "_block", "_first", "_start", "_in_file"
    )


def numbered_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, file_no): the files below a path, numbered from 0 in the order of their paths; contents are not read."""
    options = {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
    listed = spark.read.options(**options).format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    one = listed.withColumns({"block": F.lit(0), "line_id": F.lit(0)})
    return with_row_numbers(one, file_bounds(spark, path, **options)).select("file", F.col("_row_no").alias("file_no"))


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file_name, path, text): one row per file, for documents that must be seen whole.

    A text is one cell, of at most 2 GB, and one task; large files belong to ``read_lines``.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("path"),
        F.regexp_replace("value", BOM, "").alias("text"),
    )


def index_files(spark: SparkSession, folders: Sequence[str], pattern: str = "*") -> DataFrame:
    """(path, name): every file below the folders once, with its lower-cased name; a folder given twice counts once."""
    found = None
    for folder in dict.fromkeys(f.rstrip("/") for f in folders):
        own = list_files(spark, folder, pattern).select("path", F.lower(F.element_at(F.split("path", "/"), -1)).alias("name"))
        found = own if found is None else found.union(own)
    if found is None:
        raise ValueError("no folders to search")
    return found.dropDuplicates(["path"])


def list_files(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """(path, modified, length): file metadata; contents are read only on request."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    )
    extra = ["content"] if content else []
    return files.select(
        "path", F.col("modificationTime").cast("timestamp_ntz").alias("modified"), "length", *extra
    )
