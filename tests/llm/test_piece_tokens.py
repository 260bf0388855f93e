"""Piece tokens against the library, on whole tables and awkward texts."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from awkward_rows import awkward, docs  # noqa: F401
from cotejo.llm import piece_tokens
from cotejo.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=piece_tokens.model_path())
MODEL = piece_tokens.pieces(piece_tokens.model_path())
VOCABULARY = [LIBRARY.id_to_piece(i) for i in range(259, 32_000)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    ids = LIBRARY.encode(text or "")
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))


def of_one(text):
    """Ids of a text, encoded beside others."""
    ids, edges = piece_tokens.Encoder(MODEL)(["x", text, text])
    a, b, c = edges[1:].tolist()
    assert ids[a:b].tolist() == ids[b:c].tolist()
    return ids[a:b].tolist()


def test_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_piece_tokens"](spark, FOLDER)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "string", "string"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(*r) for r in rows)


def test_awkward_rows(awkward):  # noqa: F811
    tokens = piece_tokens.encode(awkward)
    got = piece_tokens.digests(piece_tokens.decode(tokens)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(r.doc_id, r.text) for r in awkward.collect()), key=repr)
    assert piece_tokens.digests(piece_tokens.decode(piece_tokens.encode(awkward.limit(0)))).count() == 0
    unset = tokens.selectExpr("doc_id", "cast(null as array<int>) ids")
    assert {r.text for r in piece_tokens.decode(unset).collect()} == {""}


characters = st.sampled_from(["a", "b", " ", "  ", "-", "=", "\n", "\t", "é", "日", "本", "😀", "▁", "1", "0", "\0", "th", "e", "́"])
vocabulary = st.tuples(st.sampled_from(VOCABULARY), st.integers(1, 5)).map(lambda x: (x[0] * x[1]).replace("▁", " "))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(characters, vocabulary, st.text(max_size=5)), max_size=25).map("".join))
def test_any_text(text):
    assert of_one(text) == LIBRARY.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 260)), max_size=15))
def test_any_ids_are_decoded(ids):
    assert piece_tokens.decoded(MODEL, np.array(ids, np.int64), np.array([0, len(ids)])) == [LIBRARY.decode(ids)]


@pytest.mark.parametrize("unit", [" ", "a", "-", "=", "ab", "th", "日", " a", "\n", "0", "abcab", "日本 "])
def test_repeated_characters(unit):
    for count in (*range(1, 70), 997):
        assert of_one(unit * count) == LIBRARY.encode(unit * count)
        assert of_one(f"x {unit * count} y") == LIBRARY.encode(f"x {unit * count} y")


def test_very_long_texts():
    rng = np.random.default_rng(1)
    for text in (" " * 300_000, "a" * 100_000, "".join(rng.choice(list("etaoinsr"), 20_000)), "".join(rng.choice(list("abcXYZ019+/"), 50_000))):
        assert of_one(text) == LIBRARY.encode(text)


def test_remembered_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(piece_tokens, "REMEMBERED", 3)
    encoder = piece_tokens.Encoder(MODEL)
    for text in ("one two three four", "two five six", "one seven", ""):
        ids, edges = encoder([text, text])
        assert ids[: edges[1]].tolist() == ids[edges[1] :].tolist() == LIBRARY.encode(text)


def test_other_models_are_refused(monkeypatch, tmp_path):
    monkeypatch.setattr(piece_tokens.Pieces, "BPE", 1)
    with pytest.raises(ValueError, match="byte-pair"):
        piece_tokens.Pieces(piece_tokens.model_path())
