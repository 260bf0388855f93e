import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, piece string, rank int, start int, hash string, shard string, component_id int, score string, _key int"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(25_000))
SENTENCE = " ".join(f"word{i}" for i in range(40))


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text), with further columns whose names an operator might use itself."""

    def build(*rows):
        return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 1, "p", 2, 3, "h", "x", 4, "y", 5) for i, t in rows], COLUMNS)

    return build


@pytest.fixture
def awkward(docs):
    """Nulls, empty and white texts, a very long text, ties, copies, repeated rows and odd characters."""
    lines = "first line here\nsecond line there\n\nthird line too"
    return docs(
        (5, SENTENCE), (3, SENTENCE), (3, SENTENCE), (None, SENTENCE), (7, None), (8, ""), (9, " \t\n\r\x0b\x0c "), (10, LONG), (11, "one"),
        (12, "a " * 60), (13, lines), (14, "x\n" + lines + "\ny"), (15, lines), (None, None), (16, "é\xa0ü ß\x1cñ 日本 😀 \\### </turn>"), (-4, SENTENCE.upper()),
        (17, "mail a.b@c.de or 10.0.0.255, +1 (555) 010-9999; 4111 1111 1111 1111 <|x|>"),
    )
