"""Substring dedup, line dedup and SimHash against plain versions."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from awkward_rows import awkward, docs  # noqa: F401
from cotejo.llm import line_dedup, simhash, substring_dedup
from cotejo.llm.batches import Words
from cotejo.llm.common import components

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def order(doc_id):
    return -(2**63) if doc_id is None else doc_id


def without_windows(pairs, window=20):
    """(doc_id, n_words, n_removed, digest) of each row."""
    words = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in pairs]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, (2**63, 0)), (order(i), k))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (order(i), k):
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 1])
def test_repeated_windows(spark, hot):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = substring_dedup.dedup(table, hot=hot).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == without_windows(rows(table))


def test_repeated_windows_of_awkward_documents(awkward):
    got = substring_dedup.dedup(awkward).drop("removed").collect()
    assert sorted(map(tuple, got), key=repr) == without_windows(rows(awkward))
    assert substring_dedup.dedup(awkward.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab ", max_size=60), min_size=1, max_size=4))
def test_strings_hold_every_window_once(texts):
    raw = [t.encode() for t in texts]
    words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    begin, end, least, twice = substring_dedup.strings(words, 6)
    covered = [k for a, b in zip(begin.tolist(), end.tolist()) for k in range(a, b - 5)]
    plain, at = [], 0
    for t in raw:
        n = len(t.split())
        plain += range(at, at + n - 5)
        at += n
    assert covered == plain
    own = b" ".join(raw).split()
    minimiser = {}
    for a, b, value, double in zip(begin.tolist(), end.tolist(), least.tolist(), twice.tolist()):
        inside = [tuple(own[k : k + 6]) for k in range(a, b - 5)]
        assert all(minimiser.setdefault(w, value) == value for w in inside)
        assert double or len(set(inside)) == len(inside)


def without_lines(pairs):
    split = [(i, (t or "").split("\n")) for i, t in pairs]
    wordy = [(i, [x for x in lines if x.encode().strip(b"\t\n\x0b\x0c\r ")]) for i, lines in split]
    first = {}
    for i, w in wordy:
        for k in range(len(w) - 2):
            first[tuple(w[k : k + 3])] = min(first.get(tuple(w[k : k + 3]), (2**63, 0)), (order(i), k))
    places = {}
    for i, w in wordy:  # rows that share an id lose the places found in any of them
        own = places.setdefault(i, set())
        for k in range(len(w) - 2):
            if first[tuple(w[k : k + 3])] < (order(i), k):
                own |= {k, k + 1, k + 2}
    out = []
    for (i, lines), (_, w) in zip(split, wordy):
        kept, at = [], -1
        for line in lines:
            is_wordy = bool(line.encode().strip(b"\t\n\x0b\x0c\r "))
            at += is_wordy
            if not (is_wordy and at in places[i]):
                kept.append(line)
        out.append((i, len(w), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_lines(spark, awkward):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for df in (table, awkward):
        assert sorted(map(tuple, line_dedup.removals(df).collect()), key=repr) == without_lines(rows(df))
    kept = line_dedup.dedup(awkward)
    assert kept.schema == awkward.schema
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[14] == "x\n\ny" or texts[14] == "x\nfirst line here\nsecond line there\n\nthird line too\ny"
    assert texts[15].strip() == "" and texts[7] is None and texts[11] == "one"
    assert line_dedup.dedup(awkward.limit(0)).count() == 0


def prints(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, budget=4):
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    label = np.arange(len(values))
    while True:
        least = np.where(near, label[None, :], len(values)).min(1)
        if (least == label).all():
            return label
        label = least


@pytest.mark.parametrize("most", [simhash.MOST, 2])
def test_near_classes(spark, awkward, most):
    for df in (spark.read.parquet(f"{FOLDER}/documents.parquet"), awkward):
        pairs = sorted(rows(df), key=lambda r: order(r[0]))
        values = np.array([prints(t) for _, t in pairs], np.uint64)
        label = classes(values)
        expected = sorted({(i, f"{v:016x}", pairs[c][0]) for (i, _), v, c in zip(pairs, values.tolist(), label)}, key=repr)
        got = simhash.near_classes(df, most=most).collect()
        assert len(got) == len(pairs) and sorted(set(map(tuple, got)), key=repr) == expected


def test_trie_join_finds_all_classes():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (12, 50, 3), dtype=np.uint64), axis=2)
    values = np.unique((seeds[:, None] ^ flips).ravel())
    for budget in (0, 1, 3, 4):
        assert (simhash.linked(values, budget) == classes(values, budget)).all()


def test_groups_dealt_again_stay_whole_when_the_join_before_changes(spark):
    """A join planned as a shuffled one and made a broadcast when it runs leaves its rows where they were: groups still have to meet."""
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 100, dtype=np.uint64)
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    apart = bits[[5, 18, 30, 45]].sum(dtype=np.uint64)  # pairs that share one block only, and a group that is dealt again
    values = np.unique(np.concatenate([seeds, seeds ^ apart, seeds[0] ^ bits[:20]]))
    rng.shuffle(values)
    signed = values.view(np.int64).tolist()
    nodes = spark.createDataFrame([(v, v) for v in signed], "node bigint, fingerprint bigint").repartition(8)
    adaptive = "spark.sql.adaptive."
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", f"{adaptive}autoBroadcastJoinThreshold": "10m", f"{adaptive}coalescePartitions.enabled": "false"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = components(simhash.links(nodes, most=2)).collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    label = dict(zip(signed, range(len(signed)))) | {r.node: signed.index(r.component) for r in found}
    pairs = {(label[v], c) for v, c in zip(signed, classes(values).tolist())}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_one_document_of_each_class_stays(awkward):
    got = simhash.one_of_each(awkward)
    assert got.schema == awkward.schema
    pairs = sorted(rows(awkward), key=lambda r: order(r[0]))
    first = set(classes(np.array([prints(t) for _, t in pairs], np.uint64)).tolist())
    ids = [r.doc_id for r in got.collect()]
    # Both documents without an id stay: one is the first of the sentence, the other the first without words.
    assert sorted(ids, key=order) == [pairs[k][0] for k in sorted(first)] and ids.count(None) == 2
    assert 5 not in ids and 3 not in ids and 15 not in ids and {10, 11, 12, 16} <= set(ids)
    assert simhash.one_of_each(awkward.limit(0)).count() == 0
