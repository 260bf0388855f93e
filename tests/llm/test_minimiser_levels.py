"""Windows of common minimisers travel by longer ones."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cotejo.llm import substring_dedup
from cotejo.llm.batches import Words, slices
from test_dedup import FOLDER, rows, without_windows


def _bits(least, hot):
    """Slots of the given minimisers with more than ``hot`` windows each, as bits."""
    slot, n = np.unique(substring_dedup._slots(least, 21), return_counts=True)
    flags = np.zeros(1 << 21, np.uint8)
    flags[slot[n > hot]] = 1
    return np.packbits(flags, bitorder="little")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab ", max_size=90), min_size=1, max_size=4), st.integers(0, 4), st.integers(0, 2))
def test_every_window_is_in_one_string_of_the_level_its_words_give(texts, hot, levels):
    raw = [t.encode() for t in texts]
    words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    known = []
    for level in range(levels):
        begin, stop, least, _, at = substring_dedup.levelled(words, 9, known)
        own = at == level
        known.append(_bits(np.repeat(least[own] ^ np.uint64(level), (stop - begin - 8)[own]), hot))
    begin, stop, least, twice, at = substring_dedup.levelled(words, 9, known)
    covered = [k for a, b in zip(begin.tolist(), stop.tolist()) for k in range(a, b - 8)]
    plain, first = [], 0
    for t in raw:
        plain += range(first, first + len(t.split()) - 8)
        first += len(t.split())
    assert covered == plain
    own, taken = b" ".join(raw).split(), {}
    for a, b, value, double, level in zip(begin.tolist(), stop.tolist(), least.tolist(), twice.tolist(), at.tolist()):
        inside = [tuple(own[k : k + 9]) for k in range(a, b - 8)]
        assert all(taken.setdefault(w, (value, level)) == (value, level) for w in inside)
        assert double or len(set(inside)) == len(inside)


@pytest.mark.parametrize("hot", [40, 5])
def test_results_don_t_depend_on_levels(spark, hot):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = substring_dedup.hot_slots(table, 20, hot)
    assert len(known) == 3 and known[0].any() and known[1].any()
    got = substring_dedup.dedup(table, hot=hot).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == without_windows(rows(table))


def test_slots_follow_the_corpus():
    assert [substring_dedup.slot_bits(x) for x in (0, 1 << 30, 1 << 33, 1 << 36, 1 << 46)] == [21, 21, 23, 26, 27]


def test_the_share_of_windows_outside_buckets_stays_small_as_the_corpus_grows(spark):
    """A corpus a hundred times as large, as seen by a threshold a hundred times as small."""
    column = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").toArrow()["text"]
    share = {}
    for hot in (2_000, 20):
        least = {}
        for _, _, data, offsets in slices(column):
            words = Words(data, offsets)
            for level, size in enumerate(substring_dedup.sizes(20)):
                begin, stop, value, _ = substring_dedup._strings(words.hashes(), words.text, 20, size)
                least.setdefault(level, []).append(np.repeat(value, stop - begin - 19))
        common = np.ones(sum(map(len, least[0])), bool)
        first = None
        for level in least:
            slot = substring_dedup._slots(np.concatenate(least[level]), 24)
            used, at, n = np.unique(slot[common], return_inverse=True, return_counts=True)
            common[np.flatnonzero(common)[n[at] <= hot]] = False
            first = common.mean() if first is None else first
        share[hot] = (first, common.mean())
    assert share[2_000][1] < 0.01 and share[20][1] < 0.5 * share[20][0], share
