"""Records cut out of slices against the same rule on whole texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from cotejo.sources import csv_dialect, lines, records

PIECES = ["a", "b,", '"', '"', '""', "\\", '\\"', "\n", "\n", "\r\n", ",", '"x\ny"', "é\n", "\\\\", ""]


def plain(text):
    return re.findall(records.RECORD, text)


def sliced(spark, texts, most, seed):
    """Lines of the texts (name -> text) in slices of up to ``most`` lines, in an order that tells nothing."""
    rng, rows = random.Random(seed), []
    for name, text in texts.items():
        block, left = 0, rng.randint(1, most)
        for i, line in enumerate(text.split("\n")):
            if not left:
                block, left = block + rng.randint(1, 9), rng.randint(1, most)
            rows.append((name, block, i * 3, line))
            left -= 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "file string, block bigint, line_id bigint, line string")


def in_order(found):
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["file"], r["block"], r["line_id"])):
        got.setdefault(r["file"], []).append(r["line"])
    return got


@pytest.mark.parametrize("most", [1, 3, 50])
def test_any_text_in_any_slices(spark, most):
    rng = random.Random(most)
    texts = {f"f{i}": "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for i in range(150)}
    # A backslash in front of a line break outside of quotes ends the record in both.
    got = in_order(records.records_of_lines(sliced(spark, texts, most, 1)))
    assert got == {name: plain(text) for name, text in texts.items() if plain(text)}


def test_places_count_from_zero_in_each_slice(spark):
    texts = {"a": '1,"x\ny"\n2,z\n\n3,"\n\n"', "b": "1\n2"}
    got = sorted((r["file"], r["block"], r["line_id"], r["line"]) for r in records.records_of_lines(sliced(spark, texts, 2, 3)).collect())
    for name in texts:
        for block in {r[1] for r in got if r[0] == name}:
            assert [r[2] for r in got if r[:2] == (name, block)] == list(range(len([r for r in got if r[:2] == (name, block)])))
    assert records.records_of_lines(sliced(spark, {}, 2, 3)).count() == 0


@pytest.mark.parametrize("size", ["64b", "1k", "100m"])
def test_files_read_in_slices(spark, tmp_path, size):
    rng = random.Random(7)
    expected = []
    for name in ("a", "b"):
        body = ["id,note"]
        for i in range(300):
            note = "".join(rng.choice(["x", "\n", "\r\n", ",", '""', '\\"', "long text "]) for _ in range(rng.randint(0, 9)))
            body.append(f'{name}{i},"{note}"')
            shown = note.replace('""', '"').replace('\\"', '"')
            expected.append((f"{name}{i}", None if shown == "" else shown))
        (tmp_path / f"{name}.csv").write_bytes(("﻿" + "\n".join(body)).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = records.read_records(spark, str(tmp_path))
        raw = lines.read_texts(spark, str(tmp_path)).select("path", "text").collect()
        assert in_order(found) == {r["path"]: plain(r["text"]) for r in raw}
        rows, rejects = csv_dialect.read_csv_dialect(spark, str(tmp_path), ["id", "note"], line_breaks=True)
        got = [(r["id"], r["note"]) for r in rows.orderBy("_row_no").collect()]
        assert got == expected and rejects.count() == 0
        assert sorted(r["_row_no"] for r in rows.collect()) == [*range(1, 301), *range(302, 602)]
        if size == "64b":
            assert found.select("file", "block").distinct().count() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_window_sees_a_whole_file_of_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n')
    windows = [x for x in plan_of(records.read_records(spark, str(tmp_path))).split("\n") if re.search(r"\bWindow\b", x)]
    by_file = [x for x in windows if re.search(r"\[_file#\d+\]", x)]  # over one row per slice
    assert windows and all("line#" not in x for x in by_file)
    assert all(re.search(r"\[file#\d+, block#\d+L?\]", x) for x in windows if x not in by_file)
