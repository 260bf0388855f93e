"""Rows that share an id, or lack one, are documents of their own."""

from awkward_rows import docs  # noqa: F401
from cotejo.llm import decontaminate, line_dedup, simhash, substring_dedup

A, B, C = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")


def lines(*words):
    return "\n".join(words)


def test_texts_under_one_id_are_not_bridged_into_one_class(docs):  # noqa: F811
    for shared in (None, 4):
        rows = docs((shared, A), (shared, B), (7, A), (8, B), (9, C), (shared, C))
        assert sorted(r.text for r in simhash.one_of_each(rows).collect()) == sorted([A, B, C])
    got = simhash.near_classes(docs((4, A), (4, B), (7, A), (2, B))).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(2, 2), (4, 2), (4, 4), (7, 4)]


def test_only_the_row_that_holds_an_item_goes(spark, docs):  # noqa: F811
    items = spark.createDataFrame([(1, A)], "item_id bigint, text string")
    for shared in (None, 4):
        rows = docs((shared, A), (shared, B), (7, "x " + A), (8, C))
        left = decontaminate.clean(rows, items)
        assert left.schema == rows.schema and sorted(r.text for r in left.collect()) == [B, C]


def test_copies_under_one_id_go_and_unique_text_stays(docs):  # noqa: F811
    for shared in (None, 4):
        rows = docs((shared, lines("p", "q", "r")), (shared, lines("s", "t", "u")), (shared, lines("p", "q", "r")), (7, lines("x", "s", "t", "u")))
        assert sorted(r.text for r in line_dedup.dedup(rows).collect()) == ["", lines("p", "q", "r"), lines("s", "t", "u"), "x"]
        assert sorted((r.doc_id or 0, r.n_removed) for r in line_dedup.removals(rows).collect()) == [(shared or 0, 0), (shared or 0, 0), (shared or 0, 3), (7, 3)]
        got = substring_dedup.dedup(docs((shared, A), (shared, B), (shared, A), (7, "x " + B))).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(shared or 0, 30, 0), (shared or 0, 30, 0), (shared or 0, 30, 30), (7, 31, 30)]
