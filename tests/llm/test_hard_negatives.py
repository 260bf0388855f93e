"""Hard negatives against a plain version that looks at every pair."""

import math
from collections import Counter

import numpy as np
import pytest

import check
from cotejo.llm import hard_negatives
from cotejo.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, slot int, score string, id int, rank int, copies int"


def plain(rows, most=5, fewest=5, every=100):
    usable = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (-r[1], -(2**63) if r[0] is None else r[0])
    out = Counter()
    for k, (anchor, v, label) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        scored = [(i, sum(x * y for x, y in zip(v, w)), other) for n, (i, w, other) in enumerate(usable) if n != k]
        positives = sorted((r for r in scored if r[2] == label), key=order)[:most]
        for p in positives:
            near = sorted((r for r in scored if r[2] != label and 80 * p[1] <= 100 * r[1] <= 100 * p[1]), key=order)
            out.update((anchor, p[0], n + 1, r[0], p[1], r[1]) for n, r in enumerate(near[:fewest]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA)


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for top, bits in ((200, 9), (30_000, 16), (1 << 20, 22)):
        a, b = rng.integers(-top, top, (2, 30, 24))
        planes = hard_negatives.packed(a, bits)
        assert (hard_negatives.unpacked(planes) == a).all()
        assert (hard_negatives.scores(planes, hard_negatives.subset_sums(b)) == a @ b.T).all()


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table_against_sql_and_pairs(spark, folder):
    path = f"/root/testdata/{folder}"
    assert check.compare(spark, check.connect(path), path, "op12_hard_negatives") == ""
    rows = hard_negatives.shifted_labels(spark.read.parquet(f"{path}/embeddings.parquet")).select("vec_id", "embedding", "label").collect()
    assert Counter(map(tuple, QUERIES["op12_hard_negatives"](spark, path).collect())) == plain([tuple(r) for r in rows])


@pytest.mark.parametrize("block", [hard_negatives.BLOCK, 2])
def test_awkward_rows(spark, block):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=11).tolist(), int(rng.integers(0, 3))) for i in range(0, 400, 5)]
    rows += [(100, rows[20][1], rows[20][2])] * 3 + [(100, rows[3][1], 1), (200, rows[3][1], None), (300, None, 1)]
    rows += [(400, [1.0, None], 1), (500, [float("nan")], 1), (600, [float("inf")] * 2, 1), (700, [], 1), (800, [1.0, -2.0], 2)]
    rows += [(None, rows[0][1], 0), (None, rows[1][1], 1), (-100, rows[2][1], 2)] + [(7, rows[40][1], 1)] * 40
    got = hard_negatives.mine(frame(spark, rows).repartition(3), block=block)
    padded = [(i, None if v is None else v + [0.0] * (11 - len(v)), label) for i, v, label in rows]
    floats = [(i, v if v is None or None in v else np.float32(v).astype(float).tolist(), label) for i, v, label in padded]
    assert Counter(map(tuple, got.collect())) == plain(floats)
    few = hard_negatives.mine(frame(spark, rows), positives=2, negatives=3, every=50)
    assert Counter(map(tuple, few.collect())) == plain(floats, 2, 3, 50)


def test_empty_tables_and_large_numbers(spark):
    for rows in ([], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, [], 1), (101, [], 1), (102, [], 2)], [(100, None, None)]):
        got = hard_negatives.mine(frame(spark, rows))
        assert got.columns == "anchor_id positive_id rank negative_id positive_score negative_score".split()
        assert Counter(map(tuple, got.collect())) == plain(rows)
    with pytest.raises(ValueError, match="may reach"):
        hard_negatives.mine(frame(spark, [(100, [1e9], 1)]))
