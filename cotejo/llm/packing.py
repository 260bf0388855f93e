"""Best-fit packing: token pieces of documents into as few sequences of a fixed length as possible.

Only the number of pieces of each length matters for packing, and there are at most ``CAPACITY`` lengths. So the
lengths are counted on the cluster, the driver packs that bounded table, and pieces find their places by their rank
among the pieces of their length. Nothing the driver holds grows with the number of documents.

Reduction (Martello and Toth): a set with the largest piece that dominates every other set with it is fixed for good, as many times
as the counts allow: the piece alone where nothing else fits, with the piece that fills the rest exactly, or with the
largest piece that fits where no two pieces can fill the rest better. The instance shrinks, and the rules are tried again;
what remains is placed best-fit, longest first.

Tokens are the tokenizer's ids of the text and an end id; a document over ``CAPACITY`` is cut into full pieces, the
first piece takes the remainder. A null text is empty: the end id alone. Rows that share a doc_id are packed each;
a missing doc_id stays null.
"""

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cotejo.llm.common import identified, ranked, real_id, small_batches, stored

CAPACITY, END = 2048, 0
VOCABULARY = "byte_bpe_50k"
KNOWN_CHUNKS = 400_000  # chunks of text whose ids a task remembers
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
SPECIAL = "<|endoftext|>"  # the vocabulary's one special token
# A single space or line feed between other characters always starts a new pre-token.
CUT = re.compile(r"(?<=\S)([ \n])(?=\S)")


class Encoder:
    """Little-endian 32-bit ids of texts; ids of chunks between single spaces are remembered."""

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.file = public_tokenizers.path(f"{vocabulary}.json")
        self.plain = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.chunks = {separator: Chunks(self.plain, separator) for separator in (" ", "\n")}

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:  # the tokenizer's own reading of its special token
            from tokenizers import Tokenizer

            return np.array(Tokenizer.from_file(self.file).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = CUT.split(text)
        spaced, lined = self.chunks[" "], self.chunks["\n"]
        out = [self.plain_ids(parts[0])]
        out += [(spaced if separator == " " else lined)[part] for separator, part in zip(parts[1::2], parts[2::2])]
        return b"".join(out)

    def plain_ids(self, text: str) -> bytes:
        return np.array(self.plain.encode_ordinary(text), "<u4").tobytes()


class Chunks(dict):
    """Ids of a separator and the chunk after it."""

    def __init__(self, encoding, separator: str):
        self.encoding, self.separator = encoding, separator

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(self.separator + chunk), "<u4").tobytes()
        if len(self) < KNOWN_CHUNKS and len(chunk) < 100:
            self[chunk] = ids
        return ids


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents (doc_id never null): place, length and checksum of their ids."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview((encoder.ids(text) if text else b"") + END.to_bytes(4, "little"))
                total = len(ids) // 4
                edges = [0, *range(total % capacity or capacity, total + 1, capacity)] if total > capacity else [0, total]
                out += [(doc, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return identified(docs).mapInArrow(run, PIECES)


def packed(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Sequences for so many pieces of each length: (pieces of each length in a sequence, number of such sequences)."""
    left = {length: n for length, n in counts.items() if n > 0}
    fixed = reduced(left, capacity)
    return fixed + best_fit(left, capacity)


def reduced(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Sets that dominate all others with their largest piece; they are taken out of ``left``."""
    fixed: list[tuple[dict[int, int], int]] = []

    def fix(pattern: dict[int, int], times: int) -> None:
        fixed.append((pattern, times))
        for length, n in pattern.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]

    changed = True
    while changed and left:
        changed = False
        for largest in sorted(left, reverse=True):
            while largest in left:
                partner = dominating(left, largest, capacity)
                if partner is None:
                    break
                changed = True
                if partner == 0:
                    fix({largest: 1}, left[largest])
                elif partner == largest:
                    fix({largest: 2}, left[largest] // 2)
                else:
                    fix({largest: 1, partner: 1}, min(left[largest], left[partner]))
    return fixed


def dominating(left: dict[int, int], piece: int, capacity: int) -> int | None:
    """Length of the one partner in a dominating set, 0 for the piece alone, None where no rule applies."""
    room = capacity - piece
    others = sorted(length for length in left if length <= room and (length != piece or left[length] > 1))
    if not others:
        return 0
    best = others[-1]
    if best == room:
        return best
    small = [length for length in others for _ in range(min(3, left[length] - (length == piece)))][:3]
    if len(small) > 1 and small[0] + small[1] <= room:
        if len(small) > 2 and sum(small) <= room:
            return None
        low, high, pair = 0, len(others) - 1, 0  # the largest sum of two that fits
        while low <= high:
            total = others[low] + others[high]
            if total > room:
                high -= 1
            else:
                if low < high or left[others[low]] - (others[low] == piece) > 1:
                    pair = max(pair, total)
                low += 1
        if pair > best:
            return None
    return best


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest pieces first, each into the fullest sequence with room for it; equal sequences are handled as one."""
    rooms: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for length in sorted(left, reverse=True):
        n = left[length]
        for room in sorted(room for room in rooms if room >= length):
            each = room // length  # a sequence that took a piece is the fullest with room until it has no more
            own, rooms[room] = rooms.pop(room), []
            for i, (pattern, times) in enumerate(own):
                filled, rest = min(times, n // each), 0
                if filled < times and n > filled * each:
                    rest = n - filled * each
                if filled:
                    rooms[room - each * length].append((pattern | {length: each}, filled))
                if rest:
                    rooms[room - rest * length].append((pattern | {length: rest}, 1))
                n -= filled * each + rest
                if times > filled + (rest > 0):
                    rooms[room].append((pattern, times - filled - (rest > 0)))
            if not rooms[room]:
                del rooms[room]
            if not n:
                break
        each = capacity // length
        if n // each:
            rooms[capacity - each * length].append(({length: each}, n // each))
        if n % each:
            rooms[capacity - n % each * length].append(({length: n % each}, 1))
    return [own for room in rooms.values() for own in room]


def places(spark: SparkSession, patterns: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Which ranks of each length go where; its rows are bounded by the number of lengths, not of pieces."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, each in pattern.items():
            rows.append((length, used[length], used[length] + each * times, sequence, each, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return spark.createDataFrame(rows, "_length long, _low long, _high long, _sequence long, _each long, _offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    own = stored(pieces(docs, capacity, vocabulary))
    counts = {row["length"]: row["n"] for row in own.groupBy("length").agg(F.count("*").alias("n")).collect()}
    numbered = ranked(own, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")])
    where = F.broadcast(places(docs.sparkSession, packed(counts, capacity)))
    here = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_low")) & (F.col("rank") < F.col("_high"))
    nth = F.col("rank") - F.col("_low")
    at = F.col("_offset") + nth % F.col("_each") * F.col("length")
    out = numbered.join(where, here).withColumns({"sequence_id": F.col("_sequence") + F.floor(nth / F.col("_each")), "offset": at})
    return out.select(real_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
