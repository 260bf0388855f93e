"""Periodic runs of words: every maximal stretch that repeats its own first words four times or more.

Words are runs of characters other than x20 and x09-x0D, compared exactly. A run is a stretch of consecutive words with
smallest period q and at least max(``LEAST``, ``TIMES`` * q) words, which no neighbouring word extends with that period.

A run of period q holds, at the dyadic scale L with L <= q < 2 L, at least two neighbouring blocks of L words (blocks start at
multiples of L) that recur q words later. So at each scale every block is laid over the words that follow it: the sum
of squared differences at each distance from L to 2 L - 1 is a correlation, computed for many blocks at once by a number
theoretic transform modulo a prime. Words stand in it as numbers so small that the sum stays below the prime, hence it is
the exact integer, and zero where the block recurs. Neighbouring blocks with one distance are joined, verified by the words
themselves and extended, by less than a block on either side.

What lies wholly in a run of a smaller period is left out: its recurrences are multiples of that period. A block whose
first, middle or last word doesn't recur at a distance in question can't recur either and isn't transformed.

A null or empty text has no words and no run; a text of any length is one row in one task, with memory in proportion to it.
Rows are independent: repeated rows and shared or missing ids each give a row of their own, an empty table gives none,
and columns other than ``doc_id`` and ``text`` are not read, whatever they are called.
"""

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cotejo.llm.batches import slices
from cotejo.llm.common import small_batches

LEAST, TIMES = 6, 4
PRIME, ROOT = 15 * 2**27 + 1, 31  # the prime leaves sums of 2 ** 30 exact; the root generates its units
P = np.uint64(PRIME)
CELLS = 1 << 18  # numbers that are transformed at once, unless one block alone has more
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

_twiddles: dict[tuple[int, bool], np.ndarray] = {}


def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of the root of unity of order 2 ``half``."""
    if (half, inverse) not in _twiddles:
        base = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        base = pow(base, -1, PRIME) if inverse else base
        out = np.ones(1, np.uint64)
        while len(out) < half:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % P])
        _twiddles[half, inverse] = out
    return _twiddles[half, inverse]


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers modulo the prime; division by a constant is several times faster than the remainder."""
    return x - x // P * P


def transformed(x: np.ndarray) -> np.ndarray:
    """Number theoretic transform of each row (a power of two long), its places in bit-reversed order."""
    rows, size = x.shape
    half = size // 2
    while half:
        x = x.reshape(-1, 2, half)
        low, high = x[:, 0], x[:, 1]
        total = low + high
        x = np.stack([np.minimum(total, total - P), _reduced((low + (P - high)) * _powers(half, False))], axis=1)
        half //= 2
    return x.reshape(rows, size)


def restored(x: np.ndarray) -> np.ndarray:
    """Inverse of ``transformed``."""
    rows, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(-1, 2, half)
        low, high = x[:, 0], _reduced(x[:, 1] * _powers(half, True))
        total, apart = low + high, low + (P - high)
        x = np.stack([np.minimum(total, total - P), np.minimum(apart, apart - P)], axis=1)
        half *= 2
    return _reduced(x.reshape(rows, size) * np.uint64(pow(size, -1, PRIME)))


def recurrences(ids: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of the places, ``size`` to 2 ``size`` - 1 words on, where a block of ``size`` words may recur.

    No recurrence is missing; the few others are those of words that share their small number. ``ids`` ends in at
    least 3 ``size`` numbers that belong to no block.
    """
    bits = np.uint64((30 - (size.bit_length() - 1)) // 2)
    small = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> (np.uint64(64) - bits)
    squares = np.concatenate([[0], np.cumsum((small * small).astype(np.int64))])
    inside, at_once = np.arange(size), max(1, CELLS // (2 * size))
    found = []
    for i in range(0, len(blocks), at_once):
        own = blocks[i : i + at_once, None]
        kernel = np.zeros((len(own), 2 * size), np.uint64)
        kernel[:, :size] = small[own + inside[::-1]]
        window = small[own + size + np.arange(2 * size)]
        product = restored(_reduced(transformed(kernel) * transformed(window)))[:, size - 1 : 2 * size - 1].astype(np.int64)
        after = own + size + inside
        apart = squares[own + size] - squares[own] + squares[after + size] - squares[after] - 2 * product
        found.append(np.argwhere(apart == 0) + [i, size])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.concatenate(found)
    return blocks[found[:, 0]], found[:, 1]


def _recurring(ids: np.ndarray, places: np.ndarray, blocks: np.ndarray, size: int) -> np.ndarray:
    """Blocks whose first, middle and last words each recur ``size`` to 2 ``size`` - 1 words on.

    ``places`` are the numbers (id, place), ascending.
    """
    for offset in sorted({0, size // 2, size - 1}):
        at = blocks + offset
        key = ids[at] * np.int64(len(ids)) + at
        after = np.searchsorted(places, key + size)
        after = places[np.minimum(after, len(places) - 1)]
        blocks = blocks[(after >= key + size) & (after < key + 2 * size)]
    return blocks


def _stretch(ids: np.ndarray, at: np.ndarray, other: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from ``at`` on (in the direction of ``step``) equal those from ``other`` on, up to ``most``."""
    out = np.zeros(len(at), np.int64)
    live, width = np.arange(len(at)), 8
    while len(live) and (out[live[0]] < most):
        width = min(width, most - int(out[live[0]]))
        reach = step * (out[live, None] + np.arange(width))
        last = len(ids) - 1
        same = ids[np.clip(at[live, None] + reach, 0, last)] == ids[np.clip(other[live, None] + reach, 0, last)]
        full = same.all(1)
        out[live] += np.where(full, width, same.argmin(1))
        live, width = live[full], min(4 * width, max(8, (1 << 20) // max(1, len(live))))
    return out


def runs(ids: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period.

    ``ids`` are texts as word numbers from 0, each text followed by a number that occurs once; ``longest`` is the length of
    the longest of them.
    """
    if longest < LEAST:
        return np.zeros((0, 3), np.int64)
    count, padding = 1 + len(ids), 4 * longest + 4
    ids = np.concatenate([[-1], ids, np.arange(padding) + (ids.max() + 1)]).astype(np.int64) + 1
    places = np.sort(ids[:count] * np.int64(len(ids)) + np.arange(count))
    out = np.zeros((0, 3), np.int64)
    size = 1
    while TIMES * size <= longest:
        blocks = np.arange(0, count, size)
        if len(out):
            out = out[np.argsort(out[:, 0], kind="stable")]
            furthest = np.maximum.accumulate(out[:, 0] + out[:, 1])

            def reach(at):
                """How far the runs known at a place go."""
                nth = np.searchsorted(out[:, 0], at, "right") - 1
                return np.where(nth >= 0, furthest[nth], -1)

            blocks = blocks[reach(blocks) < blocks + 3 * size - 1]
        blocks, apart = recurrences(ids, _recurring(ids, places, blocks, size), size)
        if len(out) and len(blocks):
            new = reach(blocks) < blocks + size + apart
            blocks, apart = blocks[new], apart[new]
        out = np.concatenate([out, _joined(ids, blocks, apart, size)])
        size *= 2
    return out[np.lexsort((out[:, 2], out[:, 0]))] - [1, 0, 0]


def _joined(ids: np.ndarray, blocks: np.ndarray, apart: np.ndarray, size: int) -> np.ndarray:
    """Runs that hold two or more neighbouring ones of these blocks, all of which recur at a distance of its own."""
    order = np.lexsort((blocks, apart))
    blocks, apart = blocks[order], apart[order]
    new = np.ones(len(blocks), bool)
    new[1:] = (np.diff(blocks) != size) | (np.diff(apart) != 0)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(blocks)))
    several = n > 1
    start, q, n = blocks[first[several]], apart[first[several]], n[several]
    # Numbers may be shared by words: the words of the blocks are compared too.
    true = np.zeros(len(start), bool)
    for length in np.unique(n).tolist():
        own = np.flatnonzero(n == length)
        true[own] = _stretch(ids, start[own], start[own] + q[own], 1, size * length) == size * length
    torn = ~true
    pieces = [np.column_stack([start[true], start[true] + size * n[true], q[true]])]
    for a, period, length in zip(start[torn].tolist(), q[torn].tolist(), n[torn].tolist()):
        same = ids[a : a + size * length] == ids[a + period : a + period + size * length]
        whole = same.reshape(length, size).all(1)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], whole.astype(np.int8), [0]]))).reshape(-1, 2)
        pieces.append(np.column_stack([a + size * edge[:, 0], a + size * edge[:, 1], np.full(len(edge), period)]))
    low, high, q = np.concatenate(pieces).astype(np.int64).T
    low = low - _stretch(ids, low - 1, low - 1 + q, -1, size)
    end = high + _stretch(ids, high, high + q, 1, size) + q
    found = np.unique(np.column_stack([low, end - low, q]), axis=0)
    found = found[found[:, 1] >= np.maximum(LEAST, TIMES * found[:, 2])]
    # The same stretch with a smaller period came first (np.unique sorts by period last).
    once = np.ones(len(found), bool)
    once[1:] = (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0)
    return found[once]


def find(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start and then period) and text without the repetitions.

    A word goes if a run contains it after that run's first ``period`` words; kept words are joined by one space.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, end, data, offsets in slices(batch.column(1)):
                raw = data.tobytes()
                found, texts = _of_texts([raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
                cells = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in found], KIND)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, end - low), cells, pa.array(texts)], names=["doc_id", "runs", "text"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, f"doc_id bigint, runs {RUNS}, text string")


KIND = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _of_texts(texts: list[list[bytes]]) -> tuple[list[list[list[int]]], list[str]]:
    number = {}
    sizes = np.array([len(words) for words in texts], np.int64)
    ids = np.zeros(int(sizes.sum()) + len(texts), np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes + 1)])
    for at, words in zip(edges.tolist(), texts):
        ids[at : at + len(words)] = [number.setdefault(w, len(number)) for w in words]
    ids[edges[1:] - 1] = len(number) + np.arange(len(texts))
    all_runs = runs(ids, int(sizes.max(initial=0)))
    owner = np.searchsorted(edges, all_runs[:, 0], "right") - 1
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, all_runs[:, 0] + all_runs[:, 2], 1)
    np.add.at(gone, all_runs[:, 0] + all_runs[:, 1], -1)
    gone = np.cumsum(gone) > 0
    found, out = [[] for _ in texts], []
    for k, (start, length, period) in zip(owner.tolist(), all_runs.tolist()):
        found[k].append([start - int(edges[k]), length, period])
    for k, (at, words) in enumerate(zip(edges.tolist(), texts)):
        if found[k]:
            words = [words[i] for i in np.flatnonzero(~gone[at : at + len(words)]).tolist()]
        out.append(b" ".join(words).decode())
    return found, out


def words_of(text: Column) -> Column:
    """The words of a text as an array; none of a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, a fixed tenth of the texts made periodic: with h = crc32(doc_id), those where h % 10 is 0.

    In such a text of n > 0 words each word i >= a = (h div 10) % n becomes word a + (i - a) % p, where p is
    1 + (n - a) div (3 + (h div 10) % 8). A text without an id stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("h", h).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % F.when(n > 0, n))).withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.array_join(F.transform("words", lambda w, i: F.get("words", place(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row per document: the number of runs, the longest one (the first of those, then the least period) and digests."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    ends = F.when(F.size("runs") > 0, "\n").otherwise("")
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), operator.neg(r["start"]).alias("start"), operator.neg(r["period"]).alias("period"))))
    rows = found.withColumn("top", top)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("(1000 * top.length) div -top.period").alias("exponent_milli"),
        F.sha2(F.concat(lines, ends), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
