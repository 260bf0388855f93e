"""Base rules against a plain version; both models on rows they haven't seen."""

import re
import zlib

import pytest

from awkward_rows import awkward, docs  # noqa: F401
from cotejo.llm import labelled, quality_classifier, quality_rules

FOLDER = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, repeated = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {p + k for p in places for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), len(words) < 50 or 100 * len(repeated) > 50 * len(words)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def area(rows):
    """Share of pairs of a good and a bad row in which the good one scores higher."""
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_base_counts(tables, awkward):
    for df in (tables[0], awkward):
        texts = {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}
        got = quality_rules.judge(df, None).collect()
        assert len(got) == df.count()
        assert {(r.doc_id, *counts(r)) for r in got} == {(i, *base(t)) for i, t in texts}
        assert all(r.kept == (not r.base_failed) for r in got)


def test_rules_on_unseen_rows(tables):
    docs, labels = tables
    out = quality_rules.judge(docs, quality_rules.fitted(docs, labels))
    rows = out.join(labels, "doc_id").where(labelled.held_out()).collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert area([r for r in rows if not r.base_failed]) > 0.97
    assert all(not r.kept for r in rows if r.base_failed)
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(good) / len(good) > 0.97
    kept = quality_rules.keep(docs, quality_rules.fitted(docs, labels))
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out.collect() if r.kept}


def test_classifier_on_unseen_rows(tables, awkward):
    docs, labels = tables
    model = quality_classifier.fitted(docs, labels)
    rows = quality_classifier.classify(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in rows)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    seen = [type("Row", (), {"score": r.score, "quality": quality[r.doc_id]}) for r in rows if r.held_out and r.doc_id in quality]
    assert area(seen) > 0.97
    odd = quality_classifier.classify(awkward.drop("n_chars"), model).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)


def test_pairs_by_squares_equal_pairs_one_by_one(tables):
    import numpy as np
    import pyarrow as pa

    from cotejo.llm.batches import Words, slices

    rng = np.random.default_rng(0)
    size = (1 << quality_classifier.BITS) + quality_classifier.STRUCTURE
    model = quality_classifier.Model(0.1, rng.normal(size=size), rng.normal(size=(size, quality_classifier.RANK)), np.zeros(quality_classifier.STRUCTURE), np.ones(quality_classifier.STRUCTURE))
    ((_, _, data, offsets),) = slices(pa.array(["a b b c", "d", ""]))
    feature, owner, value = model.inputs(Words(data, offsets), np.array([7.0, 1.0, 0.0]))
    raw, _ = model.raw(feature, owner, value, 3)
    for text in range(3):
        own = np.flatnonzero(owner == text)
        plain = 0.1 + sum(model.linear[feature[i]] * value[i] for i in own)
        plain += sum(model.factors[feature[i]] @ model.factors[feature[j]] * value[i] * value[j] for n, i in enumerate(own) for j in own[n + 1 :])
        assert raw[text] == pytest.approx(plain)


def test_held_out_rows_are_never_learnt_from(tables):
    docs, labels = tables
    ids = labelled.sample(docs, labels, "quality", 100).doc_id
    assert len(ids) == 100 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_without_labels(tables):
    docs, labels = tables
    assert quality_rules.fitted(docs, labels.limit(0)) is None
    assert quality_classifier.fitted(docs, labels.where("quality = 1")) is None
    assert {r.score for r in quality_classifier.classify(docs.limit(5), None).collect()} == {0.5}
    assert quality_rules.judge(docs.limit(0), None).count() == 0
