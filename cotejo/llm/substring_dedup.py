"""Substring dedup: words covered by a window of 20 words whose sequence also starts earlier in the corpus.

Super-k-mer partitioning. The minimiser of a window is the least hash among its runs of four words; it depends on the
window's words alone, so equal windows have equal minimisers. Consecutive windows of a document that share a minimiser
travel together, as one string of their words, to that minimiser's bucket. There the windows are cut out again and
sorted as texts with their places: in a run of equal windows all but the first place are repeats. Windows are compared
word by word, never by hash alone.

* A string seen before in the same task at an earlier place is known to repeat as a whole; only its place travels.
* Strings of one bucket travel as compressed blocks, which takes about the corpus's own size of shuffle instead of three times
  that. Buckets follow ``spark.sql.shuffle.partitions``; a task sorts its buckets one after another, and unpacks
  a bucket by shares of its minimisers, so memory holds its blocks and ``SHARE_BYTES`` or an eighth of their strings at a time.
* Windows are counted per minimiser first, by slots of its hash whose number follows the corpus. Windows of a minimiser with
  more than ``HOT`` take a longer one, of 8 and then of 16 words, and travel as strings of that: a common run of words stands in
  many contexts, which the longer runs tell apart. Which minimiser a window takes depends on its words and the counts alone,
  so equal windows still meet. What is common at 16 words, too, is mostly one text many times over: it is cut into windows in
  the map tasks and travels by document, and Spark aggregates it by window. No task receives a common minimiser as a whole.

A missing text has no words; a missing doc_id is the smallest id. Rows that share a doc_id are documents of their own,
one after the other. Further columns of the input play no part.
"""

import hashlib
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cotejo.llm.batches import Words, mixed, slices
from cotejo.llm.common import partitions, row_keyed, small_batches, stored
from cotejo.operators.skew import join_unique

WINDOW, MINIMISERS = 20, (4, 8, 16)
BUCKETS_PER_PARTITION, BUCKET_BYTES = 2, 64 << 20  # so many buckets at least, and of no more text than this on average
LONGEST = 4096  # windows in one string; longer ones are cut
HOT = 20_000  # windows of one minimiser that a bucket sorts itself
SLOTS, MOST_SLOTS, SLOT_BYTES = 21, 27, 2 << 10  # bits of a minimiser by which windows are counted: one slot for so much text
COUNTED = 2 << 20  # counts that a task holds before it hands them on
REMEMBERED = 16 << 20  # bytes of strings that a task remembers
GATHERED = 16 << 20  # bytes of strings that a task makes into blocks at a time
SHARE_BYTES, MOST_SHARES = 8 << 20, 8  # bytes of a bucket's strings that are unpacked at a time, in so many rounds at most
SLICE_BYTES = 512 << 10  # bytes of text whose windows a task numbers at a time
BLOCK = "bucket int, block binary, doc_id bigint, start int, end int, window binary"
COVERED = "doc_id bigint, start int, end int"


def strings(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each string of the shortest minimisers: first word, end word, minimiser, and whether it occurs there more than once."""
    return _strings(words.hashes(), words.text, window, sizes(window)[0])


def sizes(window: int) -> list[int]:
    """Words of the minimisers, from the shortest to the longest."""
    return list(dict.fromkeys(min(size, window) for size in MINIMISERS))


def levelled(words: Words, window: int, hot: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``strings``, of windows by the shortest minimiser that isn't hot, and the level of each string's minimiser.

    ``hot`` holds the hot slots of the levels that are known, as bits. Strings beyond them have the level ``len(hot)``; where
    there is no such minimiser, they are strings of the longest.
    """
    hashes, text = words.hashes(), words.text
    origin = np.arange(len(hashes))  # of the words in hand, those of hot strings laid end to end
    found = []
    for level, size in enumerate(sizes(window)[: len(hot) + 1]):
        begin, stop, least, twice = _strings(hashes, text, window, size)
        common = _is_hot(least, hot[level]) if level < len(hot) else np.zeros(len(begin), bool)
        last = level + 1 == len(sizes(window))
        for own, at in ((~common, level), (common & last, level + 1)):
            found.append((origin[begin[own]], origin[stop[own] - 1] + 1, least[own] ^ np.uint64(at), twice[own], np.full(own.sum(), at)))
        if last or not common.any():
            break
        begin, end = begin[common], stop[common] - window + 1
        new = np.flatnonzero(np.concatenate([[True], (begin[1:] != end[:-1]) | (text[begin[1:]] != text[begin[:-1]])]))
        begin, lengths = begin[new], end[np.append(new[1:], len(end)) - 1] - begin[new] + window - 1
        text = np.repeat(np.arange(len(new)), lengths)
        inside = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        hashes, origin = hashes[inside], origin[inside]
    begin, stop, least, twice, at = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(begin, kind="stable")
    return begin[order], stop[order], least[order], twice[order], at[order]


def _strings(hashes: np.ndarray, text: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    span = window - size + 1  # runs in a window
    runs = len(hashes) - size + 1
    windows = len(hashes) - window + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool)
    run = hashes[:runs].copy()
    for i in range(1, size):
        run = run * np.uint64(0x100000001B3) + hashes[i : i + runs]
    run = mixed(run)
    least = _sliding(run, span, np.minimum)
    valid = text[:windows] == text[window - 1 :]
    cut = np.ones(windows, bool)
    cut[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1]) | (text[1:windows] != text[: windows - 1])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], windows)
    begin, end = begin[valid[begin]], end[valid[begin]]
    if len(begin) and (end - begin).max() > LONGEST:
        pieces = [(a, min(a + LONGEST, b)) for x, y in zip(begin.tolist(), end.tolist()) for a, b in [(a, y) for a in range(x, y, LONGEST)]]
        begin, end = (np.array(x) for x in zip(*pieces))
    # Places that are the minimiser of some window; two of one value side by side mean that a string has it twice.
    padded = np.concatenate([np.zeros(span - 1, np.uint64), np.where(valid, least, np.uint64(0)), np.zeros(span - 1, np.uint64)])
    place = np.flatnonzero(_sliding(padded, span, np.maximum)[:runs] == run)
    twice = place[1:][(run[place[1:]] == run[place[:-1]]) & (place[1:] - place[:-1] <= span)]
    marked = np.zeros(windows + 1, np.int64)
    np.add.at(marked, np.clip(twice - span + 1, 0, windows - 1), 1)
    total = np.concatenate([[0], np.cumsum(marked)])
    return begin, end + window - 1, least[begin], total[end] > total[begin]


def _sliding(x: np.ndarray, size: int, of) -> np.ndarray:
    """of() over every run of ``size`` values, by doubling."""
    out, have = x, 1
    while have < size:
        step = min(have, size - have)
        out = of(out[: len(out) - step], out[step:])
        have += step
    return out


def _slots(least: np.ndarray, bits: int) -> np.ndarray:
    return (least >> np.uint64(64 - bits)).astype(np.int64)


def _is_hot(least: np.ndarray, hot: np.ndarray) -> np.ndarray:
    slot = _slots(least, (8 * len(hot)).bit_length() - 1)
    return (hot[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def slot_bits(text_bytes: int) -> int:
    return min(max(SLOTS, (text_bytes // SLOT_BYTES).bit_length()), MOST_SLOTS)


def hot_slots(docs: DataFrame, window: int, hot: int, bits: int = SLOTS) -> list[np.ndarray]:
    """Per length of minimisers, one bit per slot: whether it has more than ``hot`` windows in all documents.

    Later levels count the windows that reach them. The driver holds these bits only, 16 MB a level at most, and no list of
    slots or minimisers.
    """
    known: list[np.ndarray] = []
    for _ in sizes(window):
        over = _counts(docs, window, known, bits).where(F.col("n") > hot)
        found = np.zeros((1 << bits) // 8, np.uint8)
        marked = over.groupBy(F.col("slot").bitwiseAND(~32_767).alias("first")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(32_767).cast("bigint")).alias("bits"))
        for row in marked.collect():
            found[row["first"] // 8 : row["first"] // 8 + 4_096] = np.frombuffer(row["bits"], np.uint8)
        known.append(found)
        if not found.any():
            break
    return known


def _counts(docs: DataFrame, window: int, known: list[np.ndarray], bits: int) -> DataFrame:
    """(slot, n): windows by the minimisers of the level after the known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            slot, n = (np.concatenate(x) for x in zip(*held))
            used, at = np.unique(slot, return_inverse=True)
            return used, np.bincount(at, n, len(used)).astype(np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            used, n = summed()
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n)], names=["slot", "n"])

        for batch in batches:
            for _, _, data, offsets in slices(batch.column(1), SLICE_BYTES):
                begin, stop, least, _, level = levelled(Words(data, offsets), window, known)
                own = level == len(known)
                held.append((_slots(least[own] ^ np.uint64(len(known)), bits), (stop - begin - window + 1)[own]))
                if sum(len(slot) for slot, _ in held) > COUNTED:
                    held = [summed()]
                    if len(held[0][0]) > COUNTED // 2:
                        yield from rows()
                        held = []
        if held:
            yield from rows()

    return docs.select("doc_id", "text").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))


def _cut(docs: DataFrame, window: int, buckets: int, hot: list[np.ndarray]) -> DataFrame:
    """Strings in compressed blocks by bucket, places already known to repeat, and the windows that are hot at every level."""

    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    names = ["bucket", "block", "doc_id", "start", "end", "window"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=6)
        seen: dict[bytes, tuple[int, int]] = {}
        held = gathered = 0
        waiting: list[tuple[np.ndarray, ...]] = []  # bucket, doc_id, start, twice and minimiser of gathered strings
        texts: list[bytes] = []

        def blocks() -> pa.RecordBatch:
            bucket, *head = (np.concatenate(x) for x in zip(*waiting))
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            out = []
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                own = order[x:y]
                out.append(pack.compress(_head(*[column[own] for column in head]) + b"\n".join(texts[i] for i in own.tolist())))
            none = [None] * len(out)
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip((bucket[order[edges[:-1]]], out, none, none, none, none), kinds)], names=names)

        def windows(own: list[tuple[bytes, int, int]]) -> Iterator[tuple]:
            for text, doc, at in own:
                split = text.split(b" ")
                for k in range(len(split) - window + 1):
                    yield (doc + at + k) % buckets, None, doc, at + k, at + k + window, b" ".join(split[k : k + window])

        for batch in batches:
            for low, end, data, offsets in slices(batch.column(1), SLICE_BYTES):
                words = Words(data, offsets)
                begin, stop, least, twice, level = levelled(words, window, hot)
                if not len(begin):
                    continue
                ids = batch.column(0).slice(low, end - low).to_numpy()[words.text[begin]]
                after = np.zeros(len(data), bool)
                after[1:] = words.inside[:-1] & ~words.inside[1:]
                kept = words.inside | after
                joined = np.where(words.inside, data, np.uint8(32))[kept].tobytes()
                place = np.concatenate([[0], np.cumsum(kept)])
                froms, tos = place[words.starts[begin]].tolist(), place[words.ends[stop - 1]].tolist()
                start = words.place[begin]
                known: list[int] = []
                travel: list[int] = []
                dealt: list[tuple[bytes, int, int]] = []
                is_hot = (level == len(sizes(window))).tolist()
                for i, (a, b, at) in enumerate(zip(froms, tos, zip(ids.tolist(), start.tolist()))):
                    text = joined[a:b]
                    first = seen.get(text)
                    if first is not None and first < at:
                        known.append(i)
                        continue
                    if is_hot[i]:
                        dealt.append((text, *at))
                    else:
                        travel.append(i)
                        texts.append(text)
                        gathered += b - a
                    if first is None:
                        held += b - a + 200
                        if held > REMEMBERED:
                            seen.clear()
                            held = b - a
                    seen[text] = at
                for chunk in itertools.batched(windows(dealt), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*chunk), kinds)], names=names)
                own = np.array(travel, np.int64)
                waiting.append(((least[own] % np.uint64(buckets)).astype(np.int32), ids[own], start[own], twice[own], least[own]))
                if known:
                    own = np.array(known)
                    none = [None] * len(own)
                    columns = ((ids[own] % buckets).astype(np.int32), none, ids[own], start[own].astype(np.int32), (start + stop - begin)[own].astype(np.int32), none)
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=names)
                if gathered > GATHERED and texts:
                    yield blocks()
                    waiting, texts, gathered = [], [], 0
        if texts:
            yield blocks()

    return docs.mapInArrow(run, BLOCK)


def _head(ids: np.ndarray, start: np.ndarray, twice: np.ndarray, least: np.ndarray) -> bytes:
    """Count, then doc_id (as steps), start, twice and the minimiser's upper half of each string, column by column."""
    steps = np.diff(ids.astype("<i8"), prepend=np.int64(0))
    columns = (steps, start.astype("<i4"), twice.astype("u1"), (least >> np.uint64(32)).astype("<u4"))
    return len(ids).to_bytes(4, "little") + b"".join(column.tobytes() for column in columns)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    n = int.from_bytes(raw[:4], "little")
    ids, start, twice, least = (np.frombuffer(raw, kind, n, 4 + at * n) for kind, at in (("<i8", 0), ("<i4", 8), ("u1", 12), ("<u4", 13)))
    return np.cumsum(ids), start, twice, least, raw[4 + 17 * n :].split(b"\n")


def _share(parts: list[bytes], share: int, shares: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """As ``_unpacked``, of all the blocks together, the strings of one share of the minimisers."""
    unpack = zstandard.ZstdDecompressor()
    found: list[tuple[np.ndarray, ...]] = []
    texts: list[bytes] = []
    for part in parts:
        *columns, own = _unpacked(unpack.decompress(part))
        here = np.flatnonzero(mixed(columns[3].astype(np.uint64)) % np.uint64(shares) == share)
        found.append(tuple(column[here] for column in columns))
        texts += [own[i] for i in here.tolist()]
    return *(np.concatenate(x) for x in zip(*found)), texts


def _sorted(blocks: DataFrame, window: int) -> DataFrame:
    """Covered places; windows cut in the map tasks pass with their place."""

    def covered(entries: list[tuple[bytes, int, int]]) -> Iterator[tuple[int, int, int]]:
        """Ranges of the repeated windows, those that touch or overlap as one."""
        entries.sort()
        previous, first, later = None, None, []
        for text, doc, start in entries:
            if text != previous:
                previous, first = text, (doc, start)
            elif (doc, start) > first:
                later.append((doc, start))
        later.sort()
        for i, (doc, start) in enumerate(later):
            if i == 0 or later[i - 1][0] != doc or start > later[i - 1][1] + window:
                begin = start
            if i + 1 == len(later) or later[i + 1][0] != doc or later[i + 1][1] > start + window:
                yield doc, begin, start + window

    def bucket(parts: list[bytes]) -> Iterator[tuple[int, int, int, bytes | None]]:
        """Covered places of a bucket, whose strings are unpacked a share of the minimisers at a time."""
        shares = min(-(-sum(zstandard.frame_content_size(part) for part in parts) // SHARE_BYTES), MOST_SHARES)
        for share in range(shares):
            ids, starts, twice, least, texts = _share(parts, share, shares)
            if not texts:
                continue
            order = np.argsort(least, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(least[order]) != 0, [True]]))
            alone = (np.diff(edges) == 1) & (twice[order[edges[:-1]]] == 0)
            for x, y in zip(edges[:-1][~alone].tolist(), edges[1:][~alone].tolist()):
                own = (
                    (b" ".join(words[k : k + window]), int(ids[i]), int(starts[i]) + k)
                    for i in order[x:y].tolist()
                    for words in (texts[i].split(b" "),)
                    for k in range(len(words) - window + 1)
                )
                yield from ((*place, None) for place in covered(list(own)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, bytes | None, int, int, int, bytes | None]]:
            for batch in batches:
                yield from zip(*[column.to_pylist() for column in batch.columns])

        def found() -> Iterator[tuple[int, int, int, bytes | None]]:
            for _, own in itertools.groupby(rows(), key=lambda row: row[0]):
                parts = []
                for _, block, doc, start, end, text in own:
                    if block is None:
                        yield doc, start, end, text
                    else:
                        parts.append(block)
                if parts:
                    yield from bucket(parts)

        for chunk in itertools.batched(found(), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*chunk), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["doc_id", "start", "end", "window"])

    return blocks.sortWithinPartitions("bucket").mapInArrow(run, COVERED + ", window binary")


def covered_words(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(doc_id, start, end) of word ranges covered by repeated windows; ranges may overlap. No two documents share a doc_id.

    Windows that are hot at every level are settled by an aggregation and a join on the window.
    """
    small_batches(docs.sparkSession)
    tasks = partitions(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(tasks * BUCKETS_PER_PARTITION, size // BUCKET_BYTES)
    bits = slot_bits(size)
    # Beyond MOST_SLOTS a slot holds ever more minimisers; what they have together isn't held against one of them.
    cut = _cut(docs, window, buckets, hot_slots(docs, window, hot + (size >> bits), bits))
    found = stored(_sorted(cut.repartitionById(tasks, "bucket"), window))
    plain = found.where("window is null").select("doc_id", "start", "end")
    dealt = found.where("window is not null")
    first = dealt.groupBy(F.col("window").alias("_window")).agg(F.min(F.struct("doc_id", "start")).alias("_first"))
    later = join_unique(dealt, ["window"], first, ["_window"], "inner").where(F.struct("doc_id", "start") > F.col("_first"))
    return plain.union(later.select("doc_id", "start", "end"))


def dedup(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and removed (merged word ranges) of every document."""
    rows, key = row_keyed(docs.select(F.col("doc_id").cast("bigint"), "text"))
    covered = covered_words(rows.select(F.col(key).alias("doc_id"), "text"), window, hot)
    ranges = covered.groupBy(F.col("doc_id").alias("_doc")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges"))
    joined = rows.join(ranges, F.col(key) == F.col("_doc"), "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, own in zip(*[column.to_pylist() for column in batch.columns]):
                words = (text or "").encode().split()
                spans: list[list[int]] = []
                for x in own or ():
                    if spans and x["start"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x["end"])
                    else:
                        spans.append([x["start"], x["end"]])
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "end": b} for a, b in spans]))
            if out:
                names = ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<start:int,end:int>>")

SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)"""
