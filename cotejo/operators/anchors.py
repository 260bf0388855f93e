"""Anchored groups of stamps of any resolution: the anchors are found by pointer doubling, no list of stamps is built.

``groups.anchored_groups`` cuts stamps to the hour, as file names do; here they stay as they are, and a key may have any number of
them. Time is divided into blocks as long as a group's span. Two anchors are further apart than the span, so a block has one
at most, and the anchor after a stamp stands in one of the two blocks behind it. Every stamp is linked to the one that would be the
next anchor; the first stamps after a gap over the span are anchors in any case. From those the anchors are the stamps reached
over the links, and links of twice the length take half the steps.

What one task holds are the distinct stamps of one key within one span, twice. Every round is stored in the shared folder
and read again, so that no round repeats those before it; there are as many as the number of groups without a gap has binary digits.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from cotejo.operators.skew import join_unique
from cotejo.session import shared_folder
from cotejo.values import GROUP_SPAN_HOURS

DAY = 86_400_000_000  # microseconds


def _micros(ts: str, kind: DataType) -> Column:
    """Microseconds since 1970; clock times without a zone are counted as they read."""
    if not isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.col(f"`{ts}`").cast("timestamp"))
    at = F.col(f"`{ts}`")
    minutes = F.hour(at) * 60 + F.minute(at)
    seconds = F.extract(F.lit("SECOND"), at) * 1_000_000
    return F.unix_date(at.cast("date")).cast("bigint") * DAY + minutes.cast("bigint") * 60_000_000 + seconds.cast("bigint")


def _moment(us: str, kind: DataType) -> Column:
    if not isinstance(kind, TimestampNTZType):
        return F.timestamp_micros(us).cast(kind)
    seconds = f"cast({us} % {DAY} as decimal(18, 6)) / 1000000"
    return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(cast({us} div {DAY} as int), 0, 0, cast({seconds} as decimal(18, 6)))")


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _links(stamps: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """(openers, links) of distinct stamps (_key, _block, _us): stamps after a gap, and for the others (_us, _next)."""
    blocks = stamps.groupBy("_key", "_block").agg(F.min("_us").alias("_low"), F.max("_us").alias("_high"))
    before = blocks.select("_key", (F.col("_block") + 1).alias("_block"), F.col("_high").alias("_earlier"))
    # Only the first stamp of a block may follow a gap.
    reached = F.coalesce(F.col("_low") - F.col("_earlier") <= span, F.lit(False))
    openers = blocks.join(before, ["_key", "_block"], "left").filter(~reached).select("_key", F.col("_low").alias("_us"))
    # In a block, stamps and those of the block before (as far as the span) meet in descending order, askers first.
    askers = stamps.select("_key", (F.col("_block") + 1).alias("_block"), (F.col("_us") + span).alias("_at"), F.col("_us").alias("_asks"))
    points = stamps.select("_key", "_block", F.col("_us").alias("_at"), F.lit(None).cast("bigint").alias("_asks"))
    later = Window.partitionBy("_key", "_block").orderBy(F.desc("_at"), F.col("_asks").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    point = F.when(F.col("_asks").isNull(), F.col("_at"))
    met = askers.unionByName(points).withColumn("_found", F.min(point).over(later)).filter("_asks is not null")
    after = blocks.select("_key", (F.col("_block") - 1).alias("_block"), F.col("_low").alias("_second"))
    links = met.join(after, ["_key", "_block"], "left").select("_key", F.col("_asks").alias("_us"), F.coalesce("_found", "_second").alias("_next"))
    opening = openers.withColumnRenamed("_us", "_next")
    return openers, links.filter("_next is not null").join(opening, ["_key", "_next"], "left_anti").select("_key", "_us", "_next")


def anchors(stamps: DataFrame, span: int, folder: str) -> DataFrame:
    """(_key, _us) of all anchors among distinct stamps (_key, _block, _us)."""
    openers, links = _links(stamps, span)
    links = _stored(links, f"{folder}/links-0")
    found = _stored(openers, f"{folder}/anchors/step=0").select("_key", "_us")
    step = 0
    while not links.isEmpty():
        step += 1
        reached = found.join(links, ["_key", "_us"]).select("_key", F.col("_next").alias("_us"))
        reached.write.parquet(f"{folder}/anchors/step={step}")
        found = stamps.sparkSession.read.schema(reached.schema).parquet(f"{folder}/anchors").select("_key", "_us")
        second = links.select("_key", F.col("_us").alias("_next"), F.col("_next").alias("_far"))
        twice = links.join(second, ["_key", "_next"]).select("_key", "_us", F.col("_far").alias("_next"))
        links = _stored(twice, f"{folder}/links-{step}")
    return found


def exact_groups(files: DataFrame, keys: Sequence[str] = (), ts: str = "ts", hours: int = GROUP_SPAN_HOURS) -> DataFrame:
    """Every file with the ``anchor`` of its group: the first stamp of the key, then each first one later than the span after the last anchor.

    Stamps keep their full resolution. Files without a stamp are left out; a missing key is a key like any other. The anchors
    are found when this is called.
    """
    spark, kind, span = files.sparkSession, files.schema[ts].dataType, hours * 3_600_000_000
    key = F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.struct(F.lit(0))
    micros = _micros(ts, kind)
    placed = files.filter(F.col(f"`{ts}`").isNotNull()).withColumns({"_key": key, "_us": micros, "_block": F.floor(micros / span)})
    folder = shared_folder(spark, "anchors")
    stamps = _stored(placed.select("_key", "_block", "_us").distinct(), f"{folder}/stamps")
    block = F.floor(F.col("_us") / span)
    both = F.explode(F.array(F.struct(block.alias("_of"), F.col("_us").alias("_own"), F.lit(None).cast("bigint").alias("_last")),
                             F.struct((block + 1).alias("_of"), F.lit(None).cast("bigint").alias("_own"), F.col("_us").alias("_last"))))
    told = anchors(stamps, span, folder).select("_key", both.alias("_a")).groupBy("_key", F.col("_a._of").alias("_of"))
    told = told.agg(F.max("_a._own").alias("_own"), F.max("_a._last").alias("_last")).withColumnRenamed("_key", "_whose")
    joined = join_unique(placed, ["_key", "_block"], told, ["_whose", "_of"], "inner")
    chosen = joined.withColumn("_anchor", F.when(F.col("_own") <= F.col("_us"), F.col("_own")).otherwise(F.col("_last")))
    return chosen.withColumn("anchor", _moment("_anchor", kind)).drop("_key", "_us", "_block", "_own", "_last", "_anchor")
