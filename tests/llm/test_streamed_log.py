"""A log of deltas, edits and regenerations ends in the turns it was made from."""

import pytest

from cotejo.llm import chat_format

HARD = "\\### Assistant: </turn> ok \\s \U0001f600"
ROWS = [
    (1, 0, "user", HARD), (1, 1, "assistant", HARD * 40), (1, 2, "assistant", ""), (1, 3, "assistant", None), (1, 4, None, "x"),
    (2, None, "assistant", "before all"), (2, 0, "tool", ""), (2, 0, "assistant", "b" * 400), (2, 0, "assistant", "a" * 401),
    (2, 0, "assistant", "a" * 401), (2, 7, "user", None), (None, 1, "assistant", "no id"), (3, 5, "a:b", "c"),
]
SCHEMA = "conv_id bigint, turn int, role string, text string"


@pytest.mark.parametrize("delta", [1, 7, 400])
def test_same_turns_as_the_finished_conversations(spark, delta):
    given = spark.createDataFrame(ROWS, SCHEMA)
    plain, log = chat_format.events(given), chat_format.streamed(given, delta)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    assert log.count() > 2 * len(ROWS)
    assert _digests(log) == _digests(plain) and len(_digests(log)) == 4


def _digests(log):
    return sorted(map(tuple, chat_format.digests(chat_format.render(log)).collect()), key=repr)


def test_the_mask_finds_the_assistants_texts_in_the_rendered_one(spark):
    row = chat_format.render(chat_format.streamed(spark.createDataFrame(ROWS, SCHEMA).where("conv_id = 1"))).first()
    turns = row.formatted.split(chat_format.END)
    texts = [turns[x.turn][x.start : x.start + x.length] for x in row["mask"]]
    for mark, escape in reversed(chat_format.ESCAPES):
        texts = [t.replace(escape, mark) for t in texts]
    assert texts == [HARD * 40, "", ""]


def test_empty_and_clashing_columns(spark):
    assert chat_format.streamed(spark.createDataFrame([], SCHEMA)).count() == 0
    more = spark.createDataFrame([(1, 0, "assistant", "t", 5, "k", 9)], SCHEMA + ", seq int, kind string, message int")
    assert [r.text for r in chat_format.folded(chat_format.streamed(more)).collect()] == ["t"]
