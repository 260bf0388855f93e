"""Quality classifier: a factorisation machine over hashed words, statistics of a text's structure, and its metadata.

The score of features x is sigmoid(b + <w, x> + sum over pairs of <v_i, v_j> x_i x_j). The pairs are never formed: their sum is
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), which is linear in the number of features of a text.

Hashed words enter with their share of the text (scaled to unit length); structure and metadata (the ``n_chars``
column where there is one) enter as standardised numbers. Labels, lang, source and ids are no features. The model is
fitted on the driver from a bounded sample (``labelled.FIT_ROWS``) of the rows that aren't held out, and every text is
scored whole in Arrow batches. Null texts count as empty and get a score like any other text; without usable labels of
both kinds every score is 0.5.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cotejo.llm import labelled
from cotejo.llm.batches import SPACES, Words, slices
from cotejo.llm.common import small_batches

BITS, RANK = 16, 8
STRUCTURE = 11
COLUMNS = "doc_id bigint, held_out boolean, score double, predicted int"


def of_bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


KINDS = [of_bytes((48, 57)), of_bytes((65, 90)), of_bytes((33, 33), (63, 63)), of_bytes((35, 38), (42, 42), (60, 62), (124, 124)), of_bytes((44, 44), (46, 46)), of_bytes((10, 10))]


def structure(words: Words, n_chars: np.ndarray) -> np.ndarray:
    """Numbers that describe each text's build: length, metadata, shares of kinds of characters, repetition, word length."""
    size = np.maximum(1, np.diff(words.offsets)).astype(float)
    shares = [words.sums(kind[words.data]) / size for kind in KINDS]
    repeated = np.zeros(words.n_texts)
    for i, text in enumerate(words.texts()):
        lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
        repeated[i] = 1 - len(set(lines)) / max(1, len(lines))
    bucket, text, n = counted(words)
    distinct = np.bincount(text, minlength=words.n_texts) / np.maximum(1, words.per_text)
    width = words.sums(words.inside) / np.maximum(1, words.per_text)
    return np.column_stack([np.log1p(words.per_text), np.log1p(n_chars), *shares, repeated, distinct, np.minimum(width, 40)])


def counted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text number, count) of each text's hashed words, by text."""
    bucket = (words.hashes() >> np.uint64(64 - BITS)).astype(np.int64)
    key, n = np.unique(words.text.astype(np.int64) << BITS | bucket, return_counts=True)
    return key & ((1 << BITS) - 1), key >> BITS, n


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # hashed words, then structure
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def inputs(self, words: Words, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, text number, value) of all texts, in no order of texts."""
        bucket, text, n = counted(words)
        share = n / np.sqrt(np.bincount(text, n.astype(float) ** 2, minlength=words.n_texts))[text]
        dense = np.clip((structure(words, n_chars) - self.centre) / self.spread, -4, 4) / np.sqrt(STRUCTURE)
        feature = np.tile(np.arange(STRUCTURE) + (1 << BITS), words.n_texts)
        owner = np.repeat(np.arange(words.n_texts), STRUCTURE)
        return np.concatenate([bucket, feature]), np.concatenate([text, owner]), np.concatenate([share, dense.ravel()])

    def raw(self, feature: np.ndarray, owner: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums of factors they rest on."""
        out = self.bias + np.bincount(owner, self.linear[feature] * value, minlength=texts)
        sums = np.empty((texts, RANK))
        for f in range(RANK):
            part = self.factors[feature, f] * value
            sums[:, f] = np.bincount(owner, part, minlength=texts)
            out += 0.5 * (sums[:, f] ** 2 - np.bincount(owner, part * part, minlength=texts))
        return out, sums

    def scores(self, words: Words, n_chars: np.ndarray) -> np.ndarray:
        raw, _ = self.raw(*self.inputs(words, n_chars), words.n_texts)
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.intercept, -500, 500)))


def fit(rows, label: str = "quality", steps: int = 50, seed: int = 7) -> Model | None:
    """Adam on the balanced log loss; the given rows are all learnt from, but for a fifth that sets slope and intercept."""
    from cotejo.llm.quality_rules import calibration

    y = rows[label].to_numpy(float)
    check = np.arange(len(y)) % 5 == 4
    if len(y) < 20 or any(len(set(y[part])) < 2 for part in (check, ~check)):
        return None
    n_chars = rows["_n_chars"].to_numpy(float)
    parts = [(low, end, Words(data, offsets)) for low, end, data, offsets in slices(pa.array(rows["text"], pa.large_string()))]
    numbers = np.concatenate([structure(words, n_chars[low:end]) for low, end, words in parts])
    size = (1 << BITS) + STRUCTURE
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)), numbers.mean(0), numbers.std(0) + 1e-6)
    inputs = [model.inputs(words, n_chars[low:end]) for low, end, words in parts]
    feature, owner, value = (np.concatenate(x) for x in zip(*[(a, b + low, c) for (low, _, _), (a, b, c) in zip(parts, inputs)]))
    balance = np.where(y == 1, 0.5 / y[~check].sum(), 0.5 / (1 - y[~check]).sum()) * ~check
    state = {k: [np.zeros(v.shape), np.zeros(v.shape)] for k, v in (("linear", model.linear), ("factors", model.factors))}
    for step in range(1, steps + 1):
        raw, sums = model.raw(feature, owner, value, len(y))
        error = (1 / (1 + np.exp(-np.clip(raw, -500, 500))) - y) * balance
        pull = error[owner] * value
        slopes = {"linear": np.bincount(feature, pull, minlength=size) + 1e-5 * model.linear, "factors": np.empty_like(model.factors)}
        for f in range(RANK):
            part = pull * (sums[owner, f] - model.factors[feature, f] * value)
            slopes["factors"][:, f] = np.bincount(feature, part, minlength=size) + 1e-5 * model.factors[:, f]
        model.bias -= 0.5 * error.sum()
        for name, slope in slopes.items():
            first, second = state[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            getattr(model, name).__isub__(0.03 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6))
    raw, _ = model.raw(feature, owner, value, len(y))
    model.slope, model.intercept = calibration(raw[check], y[check])
    return model


def with_chars(docs: DataFrame) -> DataFrame:
    """doc_id, text and the length as the metadata has it, or else as the text has it."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("double")
    known = F.coalesce(F.greatest(F.col("n_chars").cast("double"), F.lit(0.0)), length) if "n_chars" in docs.columns else length
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", known.alias("_n_chars"))


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. A missing doc_id is not held out."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_chars = batch.column(2).to_numpy(zero_copy_only=False)
            for low, end, data, offsets in slices(batch.column(1)):
                score = model.scores(Words(data, offsets), n_chars[low:end]) if model else np.full(end - low, 0.5)
                own = [batch.column(i).slice(low, end - low) for i in (0, 3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return with_chars(docs).withColumn("held_out", F.coalesce(labelled.held_out(), F.lit(False))).mapInArrow(run, COLUMNS)


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit(labelled.sample(with_chars(docs), labels, "quality", labelled.FIT_ROWS, "_n_chars"))
