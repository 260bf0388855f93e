import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cotejo.operators.anchors import exact_groups
from cotejo.operators.groups import anchored_groups

BASE = dt.datetime(2025, 9, 19, 0, 0, 1, 250)
SPAN = dt.timedelta(hours=2)


def walked(data):
    out = {}
    for key in {k for k, _ in data}:
        anchor = None
        for ts in sorted({t for k, t in data if k == key and t is not None}):
            if anchor is None or ts - anchor > SPAN:
                anchor = ts
            out[key, ts] = anchor
    return out


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_equals_a_walk_over_the_stamps(spark, kind):
    rng = random.Random(3)
    data = []
    for key, spread in ((1, 4_000), (2, 200_000), (None, 40_000), (4, 9_000_000)):
        data += [(key, BASE + dt.timedelta(seconds=rng.randrange(spread), microseconds=rng.randrange(3))) for _ in range(150)]
    data += [(5, BASE), (5, BASE + SPAN), (5, BASE + SPAN + dt.timedelta(microseconds=1)), (5, BASE + 2 * SPAN + dt.timedelta(microseconds=1))]
    data += [(6, dt.datetime(1969, 12, 31, 23, 0, 0, 7)), (6, dt.datetime(1970, 1, 1, 0, 59, 59)), (6, dt.datetime(1970, 1, 1, 1, 0, 0, 8))]
    data += [(7, None), (1, None)] + data[:20]
    frame = spark.createDataFrame(data, f"k int, ts {kind}")
    got = exact_groups(frame, ["k"])
    assert got.schema["anchor"].dataType == frame.schema["ts"].dataType and got.columns == ["k", "ts", "anchor"]
    rows = got.collect()
    assert {(r["k"], r["ts"]): r["anchor"] for r in rows} == walked(data)
    assert len(rows) == len([1 for _, t in data if t is not None])


def test_one_key_with_many_stamps(spark):
    """Two million seconds without a gap: 277 groups, each exactly 7,201 stamps but the last."""
    frame = spark.range(2_000_000).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"))
    sizes = [r["count"] for r in exact_groups(frame).groupBy("anchor").count().orderBy("anchor").collect()]
    assert sizes[:-1] == [7_201] * 277 and sum(sizes) == 2_000_000


def test_whole_hours_give_the_groups_of_file_names(spark):
    rng = random.Random(9)
    data = [(k, dt.datetime(2025, 1, 1) + dt.timedelta(hours=rng.randrange(400))) for k in range(3) for _ in range(120)]
    frame = spark.createDataFrame(data, "k int, ts timestamp_ntz")
    assert sorted(map(tuple, exact_groups(frame, ["k"]).collect())) == sorted(map(tuple, anchored_groups(frame, ["k"]).collect()))


def test_no_stamps(spark):
    assert exact_groups(spark.createDataFrame([], "k int, ts timestamp_ntz"), ["k"]).count() == 0
