"""Periodic runs against a plain search of every period."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from awkward_rows import awkward, docs  # noqa: F401
from cotejo.llm import periodic_runs
from cotejo.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def plain(own):
    """[start, length, period] of all runs: the smallest period of a stretch is found first."""
    found, n = {}, len(own)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and own[i] == own[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted([s, length, q] for (s, length), q in found.items())


def collapsed(own, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def expected(doc_id, text):
    own = words(text)
    if doc_id is not None:
        h, n = zlib.crc32(str(doc_id).encode()), len(own)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            own = own[:a] + [own[a + i % p] for i in range(n - a)]
    runs = plain(own)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else [None] * 3
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    exponent = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, exponent, digest, hashlib.sha256(collapsed(own, runs).encode()).hexdigest())


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (2, 8, 64):
        a, b = rng.integers(0, periodic_runs.PRIME, (2, 3, size), dtype=np.uint64)
        assert (periodic_runs.restored(periodic_runs.transformed(a)) == a).all()
        product = periodic_runs.restored(periodic_runs.transformed(a) * periodic_runs.transformed(b) % periodic_runs.P)
        for x, y, z in zip(a.tolist(), b.tolist(), product.tolist()):
            assert z == [sum(x[i] * y[(k - i) % size] for i in range(size)) % periodic_runs.PRIME for k in range(size)]


def test_recurrences_are_all_found():
    rng = np.random.default_rng(2)
    ids = np.concatenate([rng.integers(0, 2, 300), 1000 + np.arange(64)])
    for size in (1, 2, 4, 8, 16):
        blocks = np.arange(0, 256, size)
        got = {tuple(x) for x in np.column_stack(periodic_runs.recurrences(ids, blocks, size)).tolist()}
        assert got == {(b, d) for b in blocks.tolist() for d in range(size, 2 * size) if (ids[b : b + size] == ids[b + d : b + d + size]).all()}


piece = st.tuples(st.text("abc", min_size=1, max_size=7), st.integers(1, 40)).map(lambda x: (x[0] * x[1])[: x[1]])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(piece, st.text("ab", max_size=6)), max_size=5).map("".join), min_size=1, max_size=4))
def test_runs_of_words(texts):
    own = [[c.encode() for c in t] for t in texts]
    found, left = periodic_runs._of_texts(own)
    assert found == [plain(w) for w in own]
    assert left == [collapsed(t, r) for t, r in zip(texts, found)]


def test_long_runs():
    for own in ([b"a"] * 50_000, [b"a", b"b", b"a"] * 20_000, [b"%d" % (i % 9_000) for i in range(40_000)]):
        found, left = periodic_runs._of_texts([own])
        q = found[0][0][2]
        assert found == [[[0, len(own), q]]] and left == [b" ".join(own[:q]).decode()]


def test_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_periodic_runs"](spark, FOLDER)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect())) == sorted(expected(*r) for r in rows)
    assert got.where("n_runs > 0").count() > 10


def test_awkward_rows(awkward):  # noqa: F811
    short = awkward.where("doc_id <> 10 or doc_id is null")
    got = periodic_runs.digests(periodic_runs.find(periodic_runs.planted(short))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(r.doc_id, r.text) for r in short.collect()), key=repr)
    assert periodic_runs.find(awkward).count() == awkward.count()
    assert periodic_runs.digests(periodic_runs.find(periodic_runs.planted(awkward.limit(0)))).count() == 0
