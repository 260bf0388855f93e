"""The pipeline against its stages done plainly, one document after the other."""

import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from test_dedup import classes, prints
from test_quality import base
from test_rest import held
from tokenizers import Tokenizer

import corpus_pipeline
from awkward_rows import awkward, docs  # noqa: F401
from cotejo.llm import quality_rules

FOLDER = "/root/testdata/sf0.01"


def without_repeated_lines(pairs):
    """Texts without later copies of three consecutive lines with words; smaller ids come first."""
    seen, out = set(), []
    for doc, text in sorted(pairs):
        lines = text.split("\n")
        places = [i for i, line in enumerate(lines) if line.encode().strip(b"\t\n\x0b\x0c\r ")]
        gone = set()
        for k in range(len(places) - 2):
            key = tuple(lines[i] for i in places[k : k + 3])
            if key in seen:
                gone.update(places[k : k + 3])
            seen.add(key)
        out.append((doc, "\n".join(line for i, line in enumerate(lines) if i not in gone)))
    return out


def test_pipeline(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    pairs = [tuple(r) for r in table.select("doc_id", "text").collect()]
    model = quality_rules.fitted(table, labels)
    good = {r.doc_id for r in quality_rules.judge(table, model).collect() if r.score >= quality_rules.THRESHOLD}
    pairs = [(i, t) for i, t in pairs if i in good and not base(t)[-1]]
    pairs = without_repeated_lines(pairs)
    label = classes(np.array([prints(t) for _, t in pairs], np.uint64))
    pairs = [pairs[i] for i in sorted(set(label.tolist()))]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, _ in held(pairs, items)}
    pairs = [(i, t) for i, t in pairs if i not in bad]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for i, text in pairs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        expected.update((i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    assert bad and len(pairs) > 400


def test_stages_return_the_columns_of_documents(spark, awkward):  # noqa: F811
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, FOLDER)
        assert out.columns == awkward.columns and out.schema == awkward.schema, name
        assert stage(spark, awkward.limit(0), FOLDER).count() == 0
