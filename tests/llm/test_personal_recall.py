"""Personal data: what the network finds in documents it wasn't fitted on, and the time that long texts take."""

import time
import zlib

import numpy as np
import pytest

from cotejo.llm import personal_data

MEASURED = {"email": 0.95, "ip": 0.95, "card": 0.75, "phone": 0.9}  # of plain and disguised values; measured: 0.98, 0.98, 0.84, 0.98


def test_recall_on_documents_that_were_not_fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[0-9@]'").select("doc_id", "text").collect()
    unseen = [r.text for r in docs if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    network = personal_data.train(*personal_data.examples([r.text for r in docs if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]))
    rng, asked = np.random.default_rng(9), []
    for text, own in zip(unseen, personal_data.found(unseen, network)):
        for start, kind, end in personal_data.base_spans(text):
            asked.append((kind, False, (start, kind, end) in own))
            value, low = personal_data.disguises(text[start:end], kind, rng), max(0, start - 30)
            if value != text[start:end]:
                hidden = text[low:start] + value + text[end : end + 30]
                got = personal_data.accepted(hidden, [], personal_data.found([hidden], network)[0])
                asked.append((kind, True, (start - low, kind, start - low + len(value)) in got))
    for disguised in (False, True):
        for kind, name in enumerate(personal_data.KINDS):
            hits = [hit for k, d, hit in asked if (k, d) == (kind, disguised)]
            assert not hits or sum(hits) >= MEASURED[name] * len(hits), (name, disguised, sum(hits), len(hits))


@pytest.mark.parametrize("piece", ["a dot ", "a", " ", "at ", "a at a dot ", "a@", " at dot", "(", "[at] ", "a.b@c dot ", "a" + " " * 30])
def test_addresses_of_long_texts_in_linear_time(piece):
    text = (piece * 1_000_000)[:1_000_000]
    start = time.perf_counter()
    personal_data.addresses(text)
    assert time.perf_counter() - start < 5


def test_written_addresses():
    text = "to jo.b at ex dot org, x(at)y.com; a dot b [at] c (dot) d  and u@v.w @no at home a@b.c+d@e.f"
    assert [text[a:b] for a, b in personal_data.addresses(text)] == ["jo.b at ex dot org", "x(at)y.com", "a dot b [at] c (dot) d", "u@v.w", "a@b.c"]
