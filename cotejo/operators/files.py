"""Rules over file inventories: (path, ts, category, ...) tables, never file contents."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cotejo.functions.clean import as_column, dashed_date, once, parse_hour_stamp
from cotejo.operators.lookup import anti_join
from cotejo.values import LEDGER_TOLERANCE_SECONDS

# File-name formats.
NOTICE_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}-\d{2} "
EXPORT_NAME = "[FacturaVsCR][%s][%s][%s].xls"


def base_name(path) -> Column:
    return F.substring_index(F.substring_index(as_column(path), "/", -1), "\\", -1)


def extension(name) -> Column:
    """Lower-cased extension with its dot, empty where there is none."""
    text = as_column(name)
    tail = F.substring_index(text, ".", -1)
    has_dot = F.length(tail) + 1 < F.length(text)
    return F.when(has_dot, F.lower(F.concat(F.lit("."), tail))).otherwise(F.when(text.isNotNull(), F.lit("")))


def inventory(files: DataFrame, extensions: Sequence[str], path: str = "path") -> DataFrame:
    """Adds name, ext and the hour in the name; drops temporary files and other extensions."""
    return (
        files.select("*", once(base_name(path)).alias("name"))
        .withColumn("ext", extension("name"))
        .filter(F.col("ext").isin(*extensions) & ~F.startswith("name", F.lit("~")))
        .withColumn("ts", parse_hour_stamp(F.substring("name", 1, 13)))
    )


def count_by_extension(files: DataFrame, path: str = "path") -> DataFrame:
    return files.groupBy(extension(base_name(path)).alias("ext")).agg(F.count(F.lit(1)).alias("files"))


def files_of_day(files: DataFrame, run_date, extensions: Sequence[str], modified: str = "modified") -> DataFrame:
    """Files of the run date; compares against the day's bounds so that the filter can be pushed down."""
    start = F.lit(run_date).cast("date")
    stamp = F.col(modified)
    return files.filter(
        (stamp >= start.cast("timestamp_ntz"))
        & (stamp < F.date_add(start, 1).cast("timestamp_ntz"))
        & extension(base_name("path")).isin(*extensions)
    )


def fingerprints(files: DataFrame, content: str = "content") -> DataFrame:
    return files.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256)).drop(content)


def duplicate_contents(files: DataFrame, path: str, content: str = "content") -> DataFrame:
    """Contents that occur more than once, with the number of files and the first path."""
    return (
        fingerprints(files, content)
        .groupBy("sha256")
        .agg(F.count(F.lit(1)).alias("files"), F.min(path).alias("first_path"))
        .filter("files > 1")
    )


def notice_prefix(name, suffix: str) -> Column:
    """Date-time prefix of a payment notice followed by the literal suffix, NULL where the name has none."""
    literal = "\\Q" + suffix + "\\E"
    return F.nullif(F.regexp_extract(as_column(name), f"{NOTICE_PATTERN}{literal}", 0), F.lit(""))


def pair_completeness(files: DataFrame, suffix: str, name: str = "name") -> DataFrame:
    """Per prefix: number of documents and sheets, and whether one is missing or there are several."""
    ext = extension(name)
    return (
        files.withColumn("prefix", notice_prefix(name, suffix))
        .filter("prefix is not null")
        .groupBy("prefix")
        .agg(F.count_if(ext == ".pdf").alias("pdf_files"), F.count_if(ext == ".xlsx").alias("xlsx_files"))
        .filter("pdf_files + xlsx_files > 0")
        .select(
            "*",
            (F.col("pdf_files") == 0).alias("pdf_missing"),
            (F.col("xlsx_files") == 0).alias("xlsx_missing"),
            (F.col("pdf_files") > 1).alias("pdf_several"),
            (F.col("xlsx_files") > 1).alias("xlsx_several"),
        )
    )


def unprefixed_files(files: DataFrame, suffix: str, name: str = "name") -> DataFrame:
    return files.filter(notice_prefix(name, suffix).isNull())


def first_sheet_per_prefix(files: DataFrame, suffix: str, order: str, name: str = "name") -> DataFrame:
    """The first sheet of every prefix and how many there were; both aggregates combine inside the map tasks."""
    return (
        files.withColumn("prefix", notice_prefix(name, suffix))
        .filter((extension(name) == ".xlsx") & F.col("prefix").isNotNull())
        .groupBy("prefix")
        .agg(F.min_by(name, order).alias("first_file"), F.count(F.lit(1)).alias("files"))
    )


def expected_exports(ranges: DataFrame, user: str, start: str = "DATE START", end: str = "DATE END") -> DataFrame:
    """Calendar rows with both bounds, plus the export name each should have produced."""
    clean = ranges.dropna(subset=[start, end])
    name = F.format_string(EXPORT_NAME, F.lit(user), dashed_date(f"`{start}`"), dashed_date(f"`{end}`"))
    return clean.withColumn("expected_name", name)


def missing_files(expected: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    return anti_join(expected, ["expected_name"], present, [name])


def present_files(expected: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """Names both expected and present; both sides are sets."""
    return expected.select(F.col("expected_name").alias(name)).intersect(present.select(name))


def unexpected_files(expected: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    return anti_join(present, [name], expected, ["expected_name"])


def pending_groups(groups: DataFrame, ledger: DataFrame, key: str, modified: str = "modified") -> DataFrame:
    """Groups not recorded in the ledger with the same modification time (less than a second apart)."""
    seen = ledger.select(F.col(key).alias("_key"), F.col(modified).alias("_seen"))
    tolerance = F.expr(f"interval '{LEDGER_TOLERANCE_SECONDS}' second")
    same = (F.col(modified) < F.col("_seen") + tolerance) & (F.col(modified) > F.col("_seen") - tolerance)
    return groups.join(seen, (F.col(key) == F.col("_key")) & same, "left_anti")
