"""What one task of substring dedup holds doesn't follow the size of a bucket or of a batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cotejo.llm import substring_dedup
from test_dedup import rows, without_windows

KINDS = pa.schema([("bucket", pa.int32()), ("block", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("window", pa.binary())])


class Frame:
    """Keeps the function that Spark would call in its tasks."""

    def sortWithinPartitions(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def texts(n, words=200):
    rng = random.Random(7)
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(n)]


def cut(table, buckets=1):
    frame = substring_dedup._cut(Frame(), 20, buckets, [np.zeros(1 << 18, np.uint8)])
    return frame.run(iter(table.to_batches()))


def peak(batches):
    """MB of Python's and numpy's memory at most, and the rows."""
    tracemalloc.start()
    try:
        n = sum(batch.num_rows for batch in batches)
        return tracemalloc.get_traced_memory()[1] / 2**20, n
    finally:
        tracemalloc.stop()


def documents(own):
    return pa.table({"doc_id": pa.array(range(len(own)), pa.int64()), "text": own})


def test_a_bucket_is_unpacked_by_shares():
    own = texts(12_000)
    blocks = [block for low in range(0, 12_000, 600) for block in cut(documents(own[low : low + 600]))]
    raw = sum(substring_dedup.zstandard.frame_content_size(x) for batch in blocks for x in batch["block"].to_pylist()) / 2**20
    assert raw > 50
    most, _ = peak(substring_dedup._sorted(Frame(), 20).run(iter(pa.Table.from_batches(blocks, KINDS).to_batches())))
    assert most < raw


def test_a_batch_is_cut_by_small_slices():
    most, found = peak(cut(documents(texts(2_500))))
    assert found == 1
    assert most < 65


@pytest.mark.parametrize("share", [2 << 10, 50_000])
def test_results_don_t_depend_on_shares(share, monkeypatch):
    own = texts(300, 60)
    own = [f"{text} {own[i // 3]} {own[i // 50]}" for i, text in enumerate(own)]
    blocks = [block for low in range(0, 300, 60) for block in cut(pa.table({"doc_id": pa.array(range(low, low + 60), pa.int64()), "text": own[low : low + 60]}), 3)]
    blocks = pa.Table.from_batches(blocks, KINDS).sort_by("bucket").to_batches()
    covered = []
    monkeypatch.setattr(substring_dedup, "MOST_SHARES", 2_000)
    for size in (1 << 40, share):
        monkeypatch.setattr(substring_dedup, "SHARE_BYTES", size)
        covered.append(sorted(tuple(row.values()) for batch in substring_dedup._sorted(Frame(), 20).run(iter(blocks)) for row in batch.to_pylist()))
    assert len(covered[0]) > 100 and covered[0] == covered[1]


def test_many_strings_of_a_minimiser_over_several_blocks(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    table = spark.createDataFrame([(i, f"{text} {shared}") for i, text in enumerate(texts(40, 30))], "doc_id bigint, text string").repartition(7)
    got = substring_dedup.dedup(table).drop("removed").collect()
    assert sorted(map(tuple, got), key=repr) == without_windows(rows(table))
