"""Personal data: spans are those of decoding every window, and spelled-out addresses are among them."""

import numpy as np
import pytest

from cotejo.llm import personal_data


@pytest.fixture(scope="module")
def network(spark):
    return personal_data.fitted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def all_tags(text, network):
    codes, out = personal_data.codes(text), np.zeros(len(text), np.int8)
    starts = list(range(0, max(1, len(text) - 32), 32))
    for s in starts:
        x = np.full((1, 64), personal_data.SYMBOLS - 1, np.int16)
        x[0, : len(codes[s : s + 64])] = codes[s : s + 64]
        low, high = s + 16 * (s > 0), len(text) if s == starts[-1] else s + 48
        out[low:high] = network.tags(x)[0, low - s : high - s]
    return out


def all_spans(text, network):
    out, tags = [], all_tags(text, network)
    for p, tag in enumerate(tags.tolist()):
        kind = (tag - 1) // 2
        if tag and out and out[-1][2] == p and out[-1][1] == kind and tag % 2 == 0:
            out[-1][2] = p + 1
        elif tag:
            out.append([p, kind, p + 1])
    return [tuple(x) for x in out]


def test_accepted_spans_are_those_of_every_window(spark, network):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if len(r.text) < 4000][:60]
    texts += ["jane at example dot org", "x" * 90 + "." + "y" * 50 + " (AT) " + "z" * 70 + ".org", ""]
    for text, own in zip(texts, personal_data.found(texts, network)):
        assert personal_data.accepted(text, [], own) == personal_data.accepted(text, [], all_spans(text, network))


@pytest.mark.parametrize("value", ["jane.roe at example dot org", "jane.roe (AT) example.org", "jane.roe {at} example.org", "a" * 40 + " [at] example.org"])
def test_spelled_out_addresses(network, value):
    before = "ont thand re ea the of ning "
    text = before + value + " the of ning ont"
    got = personal_data.accepted(text, [], personal_data.found([text], network)[0])
    assert got == [(len(before), 0, len(before) + len(value))]
