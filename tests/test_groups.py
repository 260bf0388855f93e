import datetime as dt
import random

from pyspark.sql import functions as F

from cotejo.operators import files, groups

BASE = dt.datetime(2025, 9, 19)
CATS = ("orders", "accounts", "invoices")


def at(hour):
    return BASE + dt.timedelta(hours=hour)


def listing(spark, *entries):
    data = [(at(h), c, f"/{c}/{at(h):%Y-%m-%d-%H}h {n}.xlsx") for n, (h, c) in enumerate(entries)]
    return spark.createDataFrame(data, "ts timestamp_ntz, category string, path string")


def anchors_of(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["anchor"], set()).add((r["ts"] - BASE).total_seconds() / 3600)
    return sorted(sorted(v) for v in found.values())


def test_groups_hang_on_their_first_file(spark):
    frame = listing(spark, *[(h, "orders") for h in (8, 9, 10, 11, 13, 14)])
    assert anchors_of(groups.anchored_groups(frame)) == [[8, 9, 10], [11, 13], [14]]


def test_groups_cross_midnight(spark):
    frame = listing(spark, *[(h, "orders") for h in (23, 25, 26)])
    assert anchors_of(groups.anchored_groups(frame)) == [[23, 25], [26]]


def test_groups_equal_a_sequential_walk(spark):
    rng = random.Random(7)
    data = [(k, at(rng.randrange(150))) for k in (1, 2, None) for _ in range(90)]
    frame = spark.createDataFrame(data, "k int, ts timestamp_ntz")
    got = {(r["k"], r["ts"]): r["anchor"] for r in groups.anchored_groups(frame, ["k"]).collect()}
    expected = {}
    for key in (1, 2, None):
        anchor = None
        for ts in sorted({t for k, t in data if k == key}):
            if anchor is None or ts - anchor > dt.timedelta(hours=2):
                anchor = ts
            expected[key, ts] = anchor
    assert got == expected
    assert groups.anchored_groups(frame, ["k"]).count() == len(data)


def test_complete_groups(spark):
    frame = listing(spark, (8, "orders"), (8, "accounts"), (9, "invoices"), (10, "orders"), (20, "orders"), (20, "other"))
    found = groups.snapshot_groups(frame, CATS)
    complete = groups.complete_groups(found, CATS).collect()
    assert [r["group_id"] for r in complete] == ["2025-09-19-08_10"]
    assert complete[0]["orders"].endswith("10h 3.xlsx")
    assert found.count() == 2
    agreement = {r["group_id"]: r["same_hour"] for r in groups.with_hour_agreement(found, CATS).collect()}
    assert agreement == {"2025-09-19-08_10": False, "2025-09-19-20_20": True}
    assert tuple(groups.hour_agreement_counts(found, CATS).first()) == (1, 1)


def test_missing_group_keys_are_a_group(spark):
    rows = [(None, "2024-01-01 08:10:00", "x", "p"), (None, "2024-01-01 09:00:00", "y", "q"), ("k", "2024-01-01 08:00:00", "x", "r")]
    files = spark.createDataFrame(rows, "office string, t string, category string, path string").selectExpr("*", "cast(t as timestamp_ntz) as ts")
    found = groups.snapshot_groups(files, ("x", "y"), ["office"])
    assert sorted(((r["office"], r["x"], r["y"]) for r in found.collect()), key=str) == [("k", "r", None), (None, "p", "q")]
    assert groups.anchored_groups(files, ["office"]).count() == 3


def test_newest_day_first(spark):
    ids = ["2025-09-19-08_10", "2025-09-20-15_15", "2025-09-20-09_10"]
    frame = spark.createDataFrame([(i,) for i in ids], "group_id string")
    assert [r[0] for r in groups.newest_first(frame).collect()] == [ids[2], ids[1], ids[0]]


def test_pending_groups(spark):
    found = spark.createDataFrame([("a", at(1)), ("b", at(1)), ("c", at(1))], "k string, modified timestamp_ntz")
    ledger = spark.createDataFrame(
        [("a", at(1) + dt.timedelta(milliseconds=999)), ("b", at(1) + dt.timedelta(seconds=1))],
        "k string, modified timestamp_ntz",
    )
    assert sorted(r["k"] for r in files.pending_groups(found, ledger, "k").collect()) == ["b", "c"]


def test_inventory(spark):
    paths = ["/d/2025-09-19-08h a.XLSX", "/d/~2025-09-19-08h b.xlsx", "/d/notes.xlsx", "C:\\d\\2025-09-19-99h c.csv", "/d/x.pdf", "/d/.xlsx"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["name"]: (r["ext"], r["ts"]) for r in files.inventory(frame, (".xlsx", ".csv")).collect()}
    assert got == {"2025-09-19-08h a.XLSX": (".xlsx", at(8)), "notes.xlsx": (".xlsx", None), "2025-09-19-99h c.csv": (".csv", None)}
    counts = {r["ext"]: r["files"] for r in files.count_by_extension(frame).collect()}
    assert counts == {".xlsx": 3, ".csv": 1, ".pdf": 1, "": 1}


def test_pairs(spark):
    names = ["2025-01-01 10-30 Acme a.pdf", "2025-01-01 10-30 Acme b.PDF", "2025-01-02 10-30 Acme.xlsx", "2025-01-02 Acme.xlsx"]
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    pairs = {r["prefix"]: tuple(r)[1:] for r in files.pair_completeness(frame, "Acme").collect()}
    assert pairs == {
        "2025-01-01 10-30 Acme": (2, 0, False, True, True, False),
        "2025-01-02 10-30 Acme": (0, 1, True, False, False, False),
    }
    assert [r["name"] for r in files.unprefixed_files(frame, "Acme").collect()] == [names[3]]
    assert [tuple(r) for r in files.first_sheet_per_prefix(frame, "Acme", "i").collect()] == [
        ("2025-01-02 10-30 Acme", names[2], 1)]


def test_files_of_day(spark):
    data = [("/a.csv", at(0)), ("/b.csv", at(23)), ("/c.csv", at(24)), ("/d.tmp", at(1))]
    frame = spark.createDataFrame(data, "path string, modified timestamp_ntz")
    assert sorted(r["path"] for r in files.files_of_day(frame, "2025-09-19", (".csv",)).collect()) == ["/a.csv", "/b.csv"]


def test_hot_key_reaches_the_window_as_distinct_stamps(spark):
    from conftest import plan_of

    frame = spark.range(1000).select(F.lit(1).alias("k"), F.lit(at(1)).cast("timestamp_ntz").alias("ts"))
    plan = plan_of(groups.stamp_anchors(frame, ["k"]))
    assert plan.rindex("HashAggregate") > plan.index("Window")
