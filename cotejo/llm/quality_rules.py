"""Quality rules: base counts of a text, and a calibrated logistic regression on hashed word and character n-grams.

The regression is fitted once on the driver from a bounded sample of labelled rows (``labelled.FIT_ROWS``); every text
is then scored whole, in Arrow batches, against a fixed threshold. No text is shuffled.

A word is a run of characters other than x20 and x09-x0D. Null and empty texts have no words: they fail the base rules.
Repeated rows are judged alike, null ids are kept, and further columns of the input play no part. Without usable labels
of both kinds the score is 1 for all, so only the base rules decide.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cotejo.llm import labelled
from cotejo.llm.batches import SPACES, Words, means, slices
from cotejo.llm.common import small_batches

BITS = 17  # of hashed features, for words and for character n-grams each
GRAM = 4  # UTF-8 bytes in a character n-gram
THRESHOLD = 0.5  # least calibrated probability of being good
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SCALE = 30.0  # features are shares of a text; this makes usual weights of order one
COLUMNS = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, score double, kept boolean"


@dataclass
class Model:
    """Weights of words and of character n-grams, and the calibration (slope, intercept) of their sum."""

    words: np.ndarray
    grams: np.ndarray
    slope: float
    intercept: float

    def scores(self, words: Words) -> np.ndarray:
        raw = sum(means(w[bucket], owner, words.n_texts) for w, (bucket, owner) in zip((self.words, self.grams), features(words)))
        return 1 / (1 + np.exp(-np.clip(self.slope * SCALE * raw + self.intercept, -500, 500)))


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of every word, and of every character n-gram, of the texts."""
    shift = np.uint64(64 - BITS)
    word = (words.hashes() >> shift).astype(np.int64)
    data, count = words.data, max(0, len(words.data) - GRAM + 1)
    packed = np.zeros(count, np.uint32)
    for i in range(GRAM):
        packed = packed << np.uint32(8) | data[i : i + count]
    gram = (packed * np.uint32(2654435761) >> np.uint32(32 - BITS)).astype(np.int64)
    owner = np.repeat(np.arange(words.n_texts), np.diff(words.offsets))
    inside = owner[:count] == owner[GRAM - 1 :][:count]
    return [(word, words.text), (gram[inside], owner[:count][inside])]


def fit(rows, label: str = "quality", steps: int = 60) -> Model | None:
    """Regression on the given texts, calibrated on every fifth of them, which the weights don't see."""
    y = rows[label].to_numpy(float)
    check = np.arange(len(y)) % 5 == 4
    if len(y) < 20 or any(len(set(y[part])) < 2 for part in (check, ~check)):
        return None
    parts: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[], []]
    for low, _, data, offsets in slices(pa.array(rows["text"], pa.large_string())):
        for part, (bucket, owner) in zip(parts, features(Words(data, offsets))):
            total = np.bincount(owner, minlength=len(offsets) - 1)
            key, n = np.unique((owner + low) << BITS | bucket, return_counts=True)
            own = key >> BITS
            part.append(((key & ((1 << BITS) - 1)).astype(np.int32), own.astype(np.int32), (n / total[own - low]).astype(np.float32)))
    for i, part in enumerate(parts):  # one at a time: the driver holds the features of the sample once
        parts[i] = tuple(map(np.concatenate, zip(*part)))
        part.clear()
    weights, first, second = ([np.zeros(1 << BITS) for _ in parts] for _ in range(3))
    balance = np.where(y == 1, 0.5 / max(1, y[~check].sum()), 0.5 / max(1, (1 - y[~check]).sum())) * ~check
    bias = 0.0

    def raw() -> np.ndarray:
        return SCALE * sum(np.bincount(own, w[at] * x, minlength=len(y)) for w, (at, own, x) in zip(weights, parts))

    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-(raw() + bias))) - y) * balance
        bias -= 0.5 * error.sum()
        for w, a, b, (at, own, x) in zip(weights, first, second, parts):  # Adam
            slope = SCALE * np.bincount(at, x * error[own], minlength=len(w)) + 1e-5 * w
            a += 0.1 * (slope - a)
            b += 0.01 * (slope**2 - b)
            w -= 0.05 * a / (1 - 0.9**step) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return Model(*[w.astype(np.float32) for w in weights], *calibration(raw()[check], y[check]))


def calibration(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that make the score a probability (Platt's targets, Newton steps)."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    slope, intercept = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * raw + intercept, -500, 500)))
        w, d = p * (1 - p) + 1e-9, p - target
        gradient = np.array([(d * raw).sum() + 1e-3 * (slope - 1), d.sum()])
        hessian = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        slope, intercept = slope - np.clip(step[0], -1, 1), intercept - np.clip(step[1], -1, 1)
    return float(max(slope, 1e-3)), float(intercept)


def base_counts(words: Words) -> dict[str, np.ndarray]:
    data = words.data
    at, run = words.runs(words.hashes(), 3)
    key = run ^ (words.text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(words.starts) + 2, bool)
    again[at[order[1:][same]]] = True
    again[at[order[:-1][same]]] = True
    covered = again[2:] | again[1:-1] | again[:-2] if len(words.starts) > 2 else np.zeros(len(words.starts), bool)
    if len(words.starts) > 2:  # a window starting at i covers i, i+1 and i+2
        start = again[:-2]
        covered = start.copy()
        covered[1:] |= start[:-1]
        covered[2:] |= start[:-2]
    repeated_lines = np.zeros(words.n_texts, np.int64)
    for i, text in enumerate(words.texts()):
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line.strip(SPACES):
                repeated_lines[i] += line in seen
                seen.add(line)
    return {
        "n_words": words.per_text,
        "word_chars": words.sums(words.inside & ((data & 0xC0) != 0x80)),
        "n_symbols": words.sums(SYMBOLS[data]),
        "n_dup_lines": repeated_lines,
        "n_repeat_words": np.bincount(words.text[covered], minlength=words.n_texts),
    }


def judged(words: Words, model: Model | None, threshold: float) -> dict[str, np.ndarray]:
    counts = base_counts(words)
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"])
    score = model.scores(words) if model else np.ones(words.n_texts)
    return counts | {"base_failed": failed, "score": score, "kept": ~failed & (score >= threshold)}


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, score and verdict of every document; see COLUMNS."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, end, data, offsets in slices(batch.column(1)):
                out = judged(Words(data, offsets), model, threshold)
                columns = {"doc_id": batch.column(0).slice(low, end - low)} | {k: pa.array(v.astype(np.int64) if v.dtype.kind in "iu" else v) for k, v in out.items()}
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, COLUMNS)


def keep(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns."""
    small_batches(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, end, data, offsets in slices(batch.column(place)):
                yield batch.slice(low, end - low).filter(pa.array(judged(Words(data, offsets), model, threshold)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit(labelled.sample(docs, labels, "quality"))
