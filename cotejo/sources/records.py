"""Records of delimited files whose quoted cells hold line breaks, read in slices like any other scan.

Whether a line break ends a record depends on all quotes before it in the file. Escaped characters count for nothing on either
side of a quote and a doubled quote counts twice, so all that a line does is flip the state or keep it. The lines of a slice
are counted up on their own, the parities of the slices before are added (one small row per slice), and every line then knows
whether it begins inside a cell. A line that begins and ends outside is a record by itself; only the others are gathered.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cotejo.sources.lines import read_lines

# One record of a text, and an escaped character.
RECORD = r'((?:[^"\\\r\n]++|\\[^\r\n]|"(?:[^"\\]++|\\[\s\S]|"")*+")++)'
ESCAPED = r"\\[^\n]"


def records_of_text(texts: DataFrame, text: str = "text") -> DataFrame:
    """Records of whole texts: adds ``line_id``, a record's place in its text, and ``line``.

    A quote that is never closed stands between two records, and the text after it is read as if it weren't there.
    """
    others = [F.col(c) for c in texts.columns if c != text]
    return texts.select(*others, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(RECORD), F.lit(1))).alias("line_id", "line"))


def records_of_lines(lines: DataFrame) -> DataFrame:
    """(file, block, line_id, line): the records of lines (file, block, line_id, line) cut at line feeds only.

    The same records as ``records_of_text`` gives of the whole files, in the same order; ``block`` is the slice in which a
    record begins and ``line_id`` counts from 0 inside it. A slice is one task's work and a record is one cell.
    """
    slice_ = ["file", "block"]
    in_slice = Window.partitionBy(*slice_).orderBy("line_id")
    quotes = F.length(masked := F.regexp_replace("line", ESCAPED, "")) - F.length(F.replace(masked, F.lit('"')))
    counted = lines.select(*slice_, "line_id", "line", quotes.alias("_quotes"))
    # State at the beginning of a line, if its slice begins outside a cell.
    flips = F.coalesce(F.sum("_quotes").over(in_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = counted.withColumn("_flips", flips)

    slices = counted.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block")).agg(
        (F.sum("_quotes") % 2).alias("_parity"),
        F.max(F.when(F.col("_flips") == 0, F.col("line_id"))).alias("_even"),
        F.max(F.when(F.col("_flips") == 1, F.col("line_id"))).alias("_odd"),
        F.max(F.when(F.col("_quotes") > 0, F.struct("block", "line_id"))).alias("_quoted"),
    )
    whole = Window.partitionBy("_file")
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entry = F.coalesce(F.sum("_parity").over(earlier), F.lit(0)) % 2
    slices = slices.select(
        "_file", "_block", entry.alias("_entry"), F.when(entry == 0, F.col("_even")).otherwise(F.col("_odd")).alias("_begun"),
        F.when(F.sum("_parity").over(whole) % 2 == 1, F.max("_quoted").over(whole)).alias("_unclosed"),
    )
    begun = F.when(F.col("_begun").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("_begun").alias("line_id")))
    slices = slices.withColumn("_carried", F.last(begun, ignorenulls=True).over(earlier)).drop("_begun")

    here = F.struct("block", "line_id")
    known = counted.join(slices, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    # Behind a quote that the file never closes everything is outside.
    free = F.coalesce(here > F.col("_unclosed"), F.lit(False))
    starts = free | ((F.col("_entry") + F.col("_flips")) % 2 == 0)
    ends = free | F.coalesce(here == F.col("_unclosed"), F.lit(False)) | ((F.col("_entry") + F.col("_flips") + F.col("_quotes")) % 2 == 0)
    known = known.select(*slice_, "line_id", "line", starts.alias("_starts"), ends.alias("_ends"), "_carried")
    own = F.last(F.when(F.col("_starts"), here), ignorenulls=True).over(in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = known.withColumn("_of", F.coalesce(own, F.col("_carried")))

    alone = known.filter("_starts and _ends").select(*slice_, "line_id", "line")
    parts = known.filter("not (_starts and _ends)").groupBy("file", "_of").agg(F.array_sort(F.collect_list(F.struct("block", "line_id", "line"))).alias("_parts"))
    joined = parts.select("file", "_of.block", "_of.line_id", F.array_join("_parts.line", "\n").alias("line"))
    found = records_of_text(alone.union(joined).withColumnRenamed("line_id", "_line"), "line")
    place = Window.partitionBy(*slice_).orderBy("_line", "line_id")
    return found.select(*slice_, (F.row_number().over(place) - 1).alias("line_id"), "line")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all files of a path, each file read by as many tasks as it has slices."""
    return records_of_lines(read_lines(spark, path, lineSep="\n"))
