"""Bitmaps of keys, and histories that read only what may hold a key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from cotejo.operators.history import insert_if_absent
from cotejo.operators.membership import Shape, bitmaps, parts_that_may_hold
from cotejo.sinks.snapshots import HistoryTable

D1 = dt.datetime(2025, 1, 1)
KEY = ["id", "file_date"]
SCHEMA = "id string, file_date timestamp_ntz, v int"


def held(df):
    return sorted((r["id"], r["file_date"], r["v"]) for r in df.collect())


def files(df):
    return df.select(F.input_file_name().alias("f")).distinct().count()


def test_shapes():
    assert [Shape.of(4, n).chunks for n in (0, 1, 4_096, 4_097, 8_192, 8_193)] == [1, 1, 1, 2, 2, 4]


def test_known_keys_are_always_found_and_few_others(spark):
    shape = Shape.of(4, 20_000)
    known = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("n"))
    marked = bitmaps(known, ["k", "n"], shape).withColumn("part", F.lit("p"))
    assert marked.agg(F.max(F.length("bitmap"))).first()[0] == 4_096
    for key in (0, 77, 19_999):
        one = known.where(F.col("k") == str(key))
        at = one.select(shape.bucket(["k", "n"])).first()[0]
        assert [tuple(r) for r in parts_that_may_hold(one, ["k", "n"], marked, [shape], "part").collect()] == [("p", at)]
    unknown = spark.range(20_000, 40_000).select(F.col("id").cast("string").alias("k"), F.lit(3).cast("bigint").alias("n"))
    wrong = sum(
        parts_that_may_hold(unknown.where(F.pmod(F.xxhash64("k"), F.lit(200)) == i), ["k", "n"], marked, [shape], "part").count() for i in range(6)
    )
    assert wrong <= 4  # of 600 keys; about one in 5,000 is expected


@pytest.mark.parametrize("buckets", [[4, 4, 4], [0, 4, 2], [3, 0, 3]])
def test_appends_equal_the_plain_insert(spark, rows, tmp_path, buckets):
    rng = random.Random(1)
    plain = None
    for i, n in enumerate(buckets):
        table = HistoryTable(spark, str(tmp_path / "history"), buckets=n)
        data = [(f"k{rng.randrange(60)}", D1 + dt.timedelta(days=rng.randrange(4)), rng.randrange(1000)) for _ in range(60)]
        batch = rows(SCHEMA, *data)
        # The key's order and case don't matter to the index.
        assert table.append(batch, KEY if i % 2 else ["File_Date", "ID"], f"b{i}")
        plain = insert_if_absent(spark.createDataFrame([], SCHEMA) if plain is None else spark.createDataFrame(plain, SCHEMA), batch, KEY).drop("_row_no").collect()
        assert held(table.read()) == sorted(map(tuple, plain))


def test_only_buckets_that_may_hold_a_key_are_read(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "history"), buckets=16)
    table.append(spark.range(4_000).selectExpr("CAST(id AS STRING) AS id", "TIMESTAMP_NTZ'2025-01-01' AS file_date", "1 AS v", "id AS _row_no"), KEY, "one")
    assert files(table.read()) == 16
    known, unknown = rows(SCHEMA, ("17", D1, 2)), rows(SCHEMA, ("new", D1, 2), ("other day", D1 + dt.timedelta(days=1), 2))
    assert files(table.holding(known, KEY)) == 1 and ("17", D1, 1) in held(table.holding(known, KEY))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(table.holding(known, KEY))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "batch#" in filters and "key_bucket#" in filters and "file_date#" in filters
    assert table.holding(unknown, KEY).count() == 0 and "FileScan" not in plan_of(table.holding(unknown, KEY))
    assert table.append(unknown.unionByName(known), KEY, "two") and table.commits()[-1]["rows"] == 2


def test_columns_of_another_type_and_plain_keys(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "plain"), buckets=2)
    assert table.holding(rows("id bigint", (1,)), ["id"]) is None
    table.append(rows("id bigint, v int", (1, 1), (2, 1)), ["id"], "one")
    table.append(rows("id int, v int", (2, 2), (3, 2)), ["id"], "two")
    table.append(rows("id int, v int", (3, 3)), ["id"], "nothing new")
    assert table.commits()[-1]["rows"] == 0
    assert table.append(spark.createDataFrame([], "id int, v int, _row_no bigint"), ["id"], "empty")
    assert sorted((r["id"], r["v"]) for r in table.read().collect()) == [(1, 1), (2, 1), (3, 2)]
    with pytest.raises(ValueError, match="key_bucket"):
        table.append(rows("id bigint, key_bucket int", (9, 9)), ["id"], "clash")
    with pytest.raises(Exception, match="primary key"):
        table.append(rows("id bigint, v int", (None, 9)), ["id"], "missing")
