"""Substring dedup sends no bucket the windows of a common minimiser."""

from collections import Counter

import numpy as np
import zstandard

from cotejo.llm import substring_dedup
from test_dedup import without_windows


def test_a_common_run_in_differing_contexts_reaches_no_bucket(spark):
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(16)] + ["the", "common", "run", "here"] + [f"b{i // 2}x{k}" for k in range(20)])) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    hot = substring_dedup.hot_slots(table, 20, 20)
    cut = substring_dedup._cut(table, 20, 4, hot).collect()
    windows = Counter()
    for row in cut:
        if row.block is not None:
            _, _, _, least, texts = substring_dedup._unpacked(zstandard.ZstdDecompressor().decompress(bytes(row.block)))
            for value, text in zip(least.tolist(), texts):
                windows[value] += len(text.split(b" ")) - 19
    assert len(hot) and max(windows.values()) <= 20
    assert np.ptp([sum(r.bucket == b for r in cut if r.window is not None) for b in range(4)]) < 300
    got = substring_dedup.dedup(table, hot=20).drop("removed").collect()
    assert sorted(map(tuple, got), key=repr) == without_windows(rows)
