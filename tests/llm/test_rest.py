"""Decontamination, packing, sharding, chat formatting, personal data, and the pipeline as a whole."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import plan_of
from awkward_rows import awkward, docs  # noqa: F401
from cotejo.llm import chat_format, decontaminate, labelled, line_dedup, packing, personal_data, quality_rules, sharding
from cotejo.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def table(spark, name, folder=FOLDER):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shingles(text, width=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}, len(words)


def held(docs, items):
    out = set()
    for item, text in items:
        n = shingles(text)[1]
        own = shingles(text, min(5, n))[0] if n else set()
        out |= {(i, item) for i, t in docs if own and len(own & shingles(t, min(5, n))[0]) >= 0.8 * len(own)}
    return out


def test_held_items(spark, awkward):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = decontaminate.holders(docs, items).collect()
    expected = held(pairs, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected) > 0
    left = decontaminate.clean(docs, items)
    assert left.schema == docs.schema and left.count() == len(pairs) - len({i for i, _ in expected})


def test_held_items_of_awkward_tables(spark, awkward):
    words = " ".join(f"word{i}" for i in range(30))
    some = [(1, words), (2, words + " changed tail here"), (3, "one"), (4, ""), (5, None), (None, "mail a b"), (6, "quite another text of more than five words"), (1, words), (7, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5")]
    items = spark.createDataFrame(some, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.holders(awkward, items).collect()}
    assert got == held([tuple(r) for r in awkward.select("doc_id", "text").collect()], some)
    assert decontaminate.holders(awkward.limit(0), items).count() == 0
    assert decontaminate.holders(awkward, items.limit(0)).count() == 0
    assert decontaminate.clean(awkward, items).schema == awkward.schema


def check_packing(spark, docs):
    got = packing.pack(docs).collect()
    tokenizer = Tokenizer.from_file(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    expected = Counter()
    for i, text in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        expected.update((i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r.length for r in got)


def test_packing(spark, awkward):
    count, tokens = check_packing(spark, table(spark, "documents"))
    assert count <= -(-tokens // 2048) + 1
    check_packing(spark, awkward)
    assert packing.pack(awkward.limit(0)).count() == 0


def fewest(lengths, capacity):
    """Fewest sequences, by trying all."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for room in sorted({b for b in bins if b >= lengths[i]}):
            rest = list(bins)
            rest.remove(room)
            place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best


def test_reduction_keeps_the_optimum():
    import random

    rng = random.Random(1)
    for _ in range(150):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        left = dict(Counter(lengths))
        fixed = packing.reduced(left, 20)
        rest = [length for length, n in left.items() for _ in range(n)]
        assert sum(times for _, times in fixed) + fewest(rest, 20) == fewest(lengths, 20)
        sets = fixed + packing.best_fit(left, 20)
        assert Counter(x for own, times in sets for x, n in own.items() for _ in range(n * times)) == Counter(lengths)
        assert all(sum(x * n for x, n in own.items()) <= 20 for own, _ in sets)


def test_shards(spark, awkward):
    for docs in (table(spark, "documents"), awkward, awkward.limit(3)):
        pairs = docs.select("doc_id", "text").collect()
        got = sharding.shard(docs).collect()
        expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
        own = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
        assert all(slots == list(range(len(slots))) for slots in own.values())
        assert max(map(len, own.values())) - min(map(len, own.values())) <= 1
        assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert sharding.shard(awkward.limit(0)).count() == 0


def test_ring_flow_goes_clockwise_to_the_next_shard_with_room():
    owners = [0, 1, 2, 0]
    ranges = sharding.flow([9, 0, 0, 0], owners, 3)
    assert [(arc, low, high, shard) for arc, low, high, shard, _ in ranges] == [(0, 0, 3, 0), (0, 3, 6, 1), (0, 6, 9, 2)]
    before = {k: s for k, s in enumerate(_owners(8))}
    after = {k: s for k, s in enumerate(_owners(9))}
    moved = sum(before[k] != after[k] for k in before)
    assert all(after[k] == 8 for k in before if before[k] != after[k]) and 0 < moved < 0.3 * len(before)


def _owners(shards, samples=2000):
    points = sharding.ring(shards)
    place = lambda at: next((s for p, s in points if p >= at), points[0][1])
    return [place(k * 2**32 // samples) for k in range(samples)]


def log(spark, *events):
    return spark.createDataFrame(list(events), "conv_id bigint, message bigint, seq bigint, kind string, role string, text string")


def test_folding_events(spark):
    rows = log(
        spark,
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "He"), (1, 1, 2, "delta", None, "llo"), (1, 1, 3, "regenerate", None, None),
        (1, 1, 4, "delta", None, "Good "), (1, 1, 5, "delta", None, "day"), (1, 0, 6, "edit", "user", "hello"), (1, 2, 7, "message", "user", "gone"), (1, 2, 8, "delete", None, None),
        (1, 3, 9, "noise", "user", "?"), (2, 0, 0, "delta", "assistant", "late"), (2, 0, None, "message", None, None), (None, None, None, "message", "user", "x"),
        (3, 0, 1, "message", "user", "a"), (3, 0, 1, "message", "user", "a"),
    )
    turns = {}
    for r in chat_format.folded(rows).orderBy("message", "version").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {1: [("user", "hello"), ("assistant", "Good day")], 2: [("", "late")], None: [("user", "x")], 3: [("user", "a"), ("user", "a")]}
    assert chat_format.digests(chat_format.render(rows.limit(0))).count() == 0


def test_texts_come_back_from_the_rendered_form(spark):
    hard = ["", "\\", "\\s", "\\e</turn>", "</turn>", "</turn>\n", "### user: x", "####\\h", "</turn", "a\n\nb ", " : ", "😀###", "\\\\</turn>\\", "/turn>"]
    roles = ["user", "assistant", "a: b", "</turn>", "###", ""]
    rows = [(7, i, i, "message", roles[i % len(roles)], text) for i, text in enumerate(hard * 2)]
    rendered = chat_format.render(log(spark, *rows))
    back = rendered.select(chat_format.read_back(F.col("formatted")).alias("t"), "segments", "formatted").first()
    assert [(t.role, t.text) for t in back.t] == [(r[4], r[5]) for r in rows]
    assert "".join(s.text for s in back.segments) == back.formatted
    got = chat_format.digests(rendered).first()
    said = "".join(r[5] for r in rows if r[4] == "assistant")
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (len(rows), len(said), hashlib.sha256(said.encode()).hexdigest())


def plain_spans(text):
    """Base spans by the patterns as they are written."""
    text, out = text or "", []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in re.sub("[^0-9]", "", m.group())]
            luhn = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0
            if (True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and luhn, 10 <= len(digits) <= 15)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.mark.parametrize("text", ["a@b.co+x@y.zz", "@a.b", "x@@y.z a.@-.- é@b.c", "1.2.3.4.5.6.7.8 256.1.1.1", "0001.2.3.4", "4111 1111-1111 1111", "+1 (555) 010-9999+49 30 1234567", "a@b.c@d.e.f", "x@y.a_b@c.d"])
def test_base_spans(text):
    assert personal_data.base_spans(text) == plain_spans(text)


def test_personal_data(spark, awkward):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    network = personal_data.fitted(docs)
    for df in (docs, awkward):
        texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
        for r in personal_data.detect(df.dropDuplicates(["doc_id"]), network).collect():
            base = plain_spans(texts[r.doc_id]) if r.doc_id is not None else None
            if base is None:
                continue
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
            assert r.base_sha256 == hashlib.sha256(personal_data.written(base).encode()).hexdigest()
            assert {x for x in personal_data.written(base).split(",") if x} <= set(r.spans.split(","))
    # The network finds most of the base spans by itself, and values in forms that the patterns don't know.
    texts = [r.text for r in docs.select("text").collect()]
    base, own = [personal_data.base_spans(t) for t in texts], personal_data.found(texts, network)
    assert sum(len(set(a) & set(b)) for a, b in zip(base, own)) > 0.85 * sum(map(len, base))
    hidden = "ont thand re (310) 555-0143 ea the of ning"
    assert personal_data.accepted(hidden, [], personal_data.found([hidden], network)[0]) == [(13, 3, 27)]
    assert personal_data.detect(awkward.limit(0), network).count() == 0 and personal_data.fitted(docs.limit(0)) is None


def test_gradients_of_the_network():
    import numpy as np

    rng = np.random.default_rng(2)
    network = personal_data.Network.new(1)
    for name in ("inputs", "recurrent", "output", "bias", "transitions"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    x, y = rng.integers(0, personal_data.SYMBOLS, (3, 6)), rng.integers(0, personal_data.TAGS, (3, 6))
    _, slopes = network.gradients(x, y)
    for name, slope in zip(("inputs", "recurrent", "output", "bias", "transitions"), slopes):
        weights = getattr(network, name)
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        old, step = weights[at], 1e-2
        weights[at] = old + step
        high, _ = network.gradients(x, y)
        weights[at] = old - step
        low, _ = network.gradients(x, y)
        weights[at] = old
        assert slope[at] == pytest.approx((high - low) / (2 * step), rel=2e-2)


def test_native_operators_run_no_python(spark):
    for name in ("op1_decontamination", "op8_sharding", "op10_chat_format"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")), name


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_with_sql(spark, name):
    import check

    assert check.compare(spark, check.connect(FOLDER), FOLDER, name) == ""
