"""SentencePiece encoding and decoding with a byte-pair model, in vectorised rounds of merges.

Encoding: a space becomes the mark U+2581 and one mark is put in front; an empty text has no ids. Text is cut in front of every run
of marks, where the vocabulary has no piece that crosses it. Distinct words of a slice of texts are laid end to end
as one flat array of symbols, first the characters. A cell per neighbouring pair holds the rank of the piece it would make.
In each round the least rank of every word is found (a segmented minimum), the pairs of that rank are merged from left to right
in all words at once, the arrays are compacted and the changed pairs looked up again; words without a pair leave. The library
merges one pair after the other, the best first and then the leftmost. A round takes several pairs of a word only as far as
that is the same: up to the first one whose new neighbourhood makes a pair of the same or a better rank. Characters outside the
vocabulary become their UTF-8 bytes.

A long run of marks would need a round per mark, since pieces of marks share the worst rank: its head is cut into the longest
such pieces at once, which is what growing from the left comes to.

Decoding: bytes of the pieces are laid end to end, marks become spaces and the first is dropped; byte pieces that aren't
UTF-8 become U+FFFD, one for each byte; control pieces are silent and the unknown piece is `` ⁇ ``, as in the library.

A null text is an empty one. Texts of any length are whole rows of one task, with memory in proportion to them. Rows are
independent, so repeated rows and ids, missing ids and empty tables need no rule; other columns are not read, whatever they are
called. Words without spaces are cut further, between characters that no piece holds side by side; what is left of any length
takes a round per rank at most. The model file is found on each executor by ``path`` (see ``model_path``); it must be a byte-pair model without
normalisation rules, anything else is an error.
"""

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from cotejo.llm.batches import slices
from cotejo.llm.common import small_batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"
REMEMBERED, POOL = 200_000, 1 << 21  # distinct words and their ids that a task remembers before it begins anew
NONE = np.int64(2**62)  # the rank of a pair that makes no piece


def model_path() -> str:
    return public_tokenizers.path(MODEL)


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(field number, value) of a serialised message; nested messages are bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        out, shift = 0, 0
        while True:
            byte, at = raw[at], at + 1
            out, shift = out | (byte & 127) << shift, shift + 7
            if byte < 128:
                return out

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, raw[at : at + size]
            at += size


class Pieces:
    """A model's pieces as lookup tables."""

    # Field numbers and kinds of the model file.
    PIECE, TRAINER, NORMALIZER = 1, 2, 3
    NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
    TYPE_OF_MODEL, BPE = 3, 2
    RULES, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE = 2, 3, 4, 5
    UNKNOWN_TEXT = " ⁇ "

    def __init__(self, path: str):
        parts = list(_fields(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto()))
        trainer = dict(_fields(next(v for f, v in parts if f == self.TRAINER)))
        rules = dict(_fields(next(v for f, v in parts if f == self.NORMALIZER)))
        if trainer.get(self.TYPE_OF_MODEL) != self.BPE or rules.get(self.RULES) or rules.get(self.EXTRA_SPACES, 1) or not rules.get(self.DUMMY_PREFIX, 1) or not rules.get(self.ESCAPE, 1):
            raise ValueError(f"{path} is not a byte-pair model with a leading mark and no normalisation")
        pieces = []
        for f, v in parts:
            if f == self.PIECE:
                own = dict(_fields(v))
                pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, bytes(4)))[0], own.get(3, self.NORMAL)))
        kinds = {kind for _, _, kind in pieces}
        if kinds & {self.USER, self.UNUSED}:
            raise ValueError(f"{path} has pieces of a kind that isn't handled: {sorted(kinds)}")
        self.size = len(pieces)
        found = {text: (k, score) for k, (text, score, kind) in enumerate(pieces) if kind == self.NORMAL}
        rank = {score: k for k, score in enumerate(sorted({score for _, score in found.values()}, reverse=True))}
        # Characters get a number of their own where they aren't pieces; such a one can still be a part of a piece.
        numbers = {text: k for text, (k, _) in found.items()}
        for char in sorted({c for text in found for c in text}):
            numbers.setdefault(char, len(pieces) + len(numbers))
        self.unknown = len(pieces) + len(numbers) + 1  # any other character
        self.width = self.unknown + 1
        chars = sorted((ord(c), n) for c, n in numbers.items() if len(c) == 1)
        self.char, self.char_number = (np.array(x, np.int64) for x in zip(*chars))
        # Neighbours inside pieces: between any others no piece is ever made.
        inside = {numbers[a] * self.width + numbers[b] for text in found for a, b in zip(text, text[1:])}
        self.neighbours = np.array(sorted(inside), np.int64)
        pairs = {}
        for text, (k, score) in found.items():
            for i in range(1, len(text)):
                a, b = numbers.get(text[:i]), numbers.get(text[i:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (rank[score], k)
        keys = sorted(pairs)
        self.pair = np.array([*keys, 2**62], np.int64)
        self.rank, self.merged = (np.array(x, np.int64) for x in zip(*[pairs[k] for k in keys], (NONE, 0)))
        self.byte = np.full(256, -1, np.int64)
        for k, (text, _, kind) in enumerate(pieces):
            if kind == self.BYTE:
                self.byte[int(text[1:-1], 16)] = k
        if (self.byte < 0).any():
            raise ValueError(f"{path} has no pieces for bytes")
        # Cut text in front of marks only if no piece crosses such a cut.
        crossed = any(re.search(f"[^{MARK}]{MARK}", text) for text in found)
        self.words = re.compile(".+" if crossed else f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.S)
        runs = {len(text) for text in found if text == MARK * len(text)}
        longest = max(runs, default=1)
        # Pieces of marks that share the worst rank are made from the left, whatever stands behind a long enough run.
        worst = min(score for _, score in found.values())
        mixed = any(text.startswith(MARK * 2) and text != MARK * len(text) for text in found)
        self.run = 0
        if longest > 1 and not mixed and not crossed and all(found[MARK * n][1] == worst for n in runs if n > 1):
            row = merged(self, np.full(2 * longest, ord(MARK)), np.zeros(2 * longest, np.int64))[2]
            self.run = longest if row[0] == numbers[MARK * longest] else 0
        raw = []
        for text, _, kind in pieces:
            raw.append(
                bytes([int(text[1:-1], 16)]) if kind == self.BYTE else b"" if kind == self.CONTROL
                else self.UNKNOWN_TEXT.encode() if kind == self.UNKNOWN else text.replace(MARK, " ").encode()
            )
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.silent = np.array([kind == self.CONTROL for _, _, kind in pieces])
        self.marked = np.array([text.startswith(MARK) and kind == self.NORMAL for text, _, kind in pieces])

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of pairs of symbols; the rank is ``NONE`` where they make no piece."""
        key = left * self.width + right
        at = np.searchsorted(self.pair, key)
        hit = self.pair[at] == key
        return np.where(hit, self.rank[at], NONE), self.merged[at]

    def apart(self, codes: np.ndarray) -> np.ndarray:
        """For each character whether no piece holds it right behind the one before it."""
        symbol = self.symbols(codes)
        key = symbol[:-1] * self.width + symbol[1:]
        at = np.minimum(np.searchsorted(self.neighbours, key), len(self.neighbours) - 1)
        return np.concatenate([[True], self.neighbours[at] != key])

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.char, codes), len(self.char) - 1)
        return np.where(self.char[at] == codes, self.char_number[at], self.unknown)


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """The model of a file, read once per worker process."""
    return Pieces(path)


def merged(model: Pieces, codes: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place of its first character, symbol) of the symbols of words that are left when no pair remains.

    ``codes`` are the characters of all words end to end and ``word`` (ascending) says whose each is.
    """
    symbol, place = model.symbols(codes), np.arange(len(codes))
    same = np.zeros(len(codes), bool)
    same[:-1] = word[:-1] == word[1:]
    rank, piece = model.looked_up(symbol, np.append(symbol[1:], 0))
    rank = np.where(same, rank, NONE)
    done = []
    while len(symbol):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        least = np.minimum.reduceat(rank, first)
        count = np.diff(np.append(first, len(word)))
        live = np.repeat(least < NONE, count)
        if not live.all():
            done.append((word[~live], place[~live], symbol[~live]))
            word, place, symbol, rank, piece = (x[live] for x in (word, place, symbol, rank, piece))
            if not len(symbol):
                break
            count, least = count[least < NONE], least[least < NONE]
            first = np.cumsum(count) - count
        nth = np.repeat(np.arange(len(first)), count)
        at = np.flatnonzero(rank == least[nth])
        # Of pairs that overlap in a chain every second one is merged, from the left.
        chain = np.diff(at, prepend=-2) != 1
        head = np.flatnonzero(chain)
        at = at[(np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))) % 2 == 0]
        own, made = nth[at], piece[at]
        # The pairs that a merge makes with what stands before it by then, and with what stands after it as yet.
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, len(symbol) - 1)
        joined = np.zeros(len(at), bool)
        joined[1:] = (at[1:] - at[:-1] == 2) & (own[1:] == own[:-1])
        left = np.where(joined, np.roll(made, 1), symbol[before])
        better = ((at > 0) & (nth[before] == own) & (model.looked_up(left, made)[0] <= least[own])) | (
            (at + 2 < len(symbol)) & (nth[after] == own) & (model.looked_up(made, symbol[after])[0] <= least[own])
        )
        if better.any():
            start = np.flatnonzero(np.diff(own, prepend=-1))
            total = np.cumsum(better) - better
            earlier = total - np.repeat(total[start], np.diff(np.append(start, len(own))))
            at, made = at[earlier == 0], made[earlier == 0]
        symbol[at] = made
        kept = np.ones(len(symbol), bool)
        kept[at + 1] = False
        to = np.cumsum(kept) - 1
        word, place, symbol, rank, piece, nth = (x[kept] for x in (word, place, symbol, rank, piece, nth))
        changed = to[at]
        changed = np.concatenate([changed, np.maximum(changed - 1, 0)])
        following = np.minimum(changed + 1, len(symbol) - 1)
        new, what = model.looked_up(symbol[changed], symbol[following])
        rank[changed] = np.where((following > changed) & (nth[following] == nth[changed]), new, NONE)
        piece[changed] = what
    if not done:
        return word, place, symbol
    word, place, symbol = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(place)
    return word[order], place[order], symbol[order]


def _word_ids(model: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words end to end, number of ids of each)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    part = np.cumsum(model.apart(codes) | (np.diff(word, prepend=-1) != 0))
    _, place, symbol = merged(model, codes, part)
    word = word[place]
    alone = np.flatnonzero(symbol >= model.size)  # characters that aren't pieces
    spelled = [chr(c).encode() for c in codes[place[alone]].tolist()]
    count = np.ones(len(symbol), np.int64)
    count[alone] = [len(x) for x in spelled]
    ids = np.repeat(symbol, count)
    ids[np.repeat(symbol >= model.size, count)] = model.byte[np.frombuffer(b"".join(spelled), np.uint8)]
    return ids.astype(np.int32), np.bincount(word, count, minlength=len(words)).astype(np.int64)


class Encoder:
    """Texts to ids; words that were seen are remembered, up to ``REMEMBERED`` of them or ``POOL`` ids at a time."""

    def __init__(self, model: Pieces):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        words = self.model.words.findall(text)
        if not self.model.run or MARK * (3 * self.model.run) not in text:
            return words
        return [part for word in words for part in self._short_runs(word)]

    def _short_runs(self, word: str) -> list[str]:
        """The word, the long run of marks that it may begin with cut into pieces of marks but for its end."""
        run = self.model.run
        heads = max(0, (len(word) - len(word.lstrip(MARK)) - 2 * run) // run)
        return [*[MARK * run] * heads, word[heads * run :]]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, places where each begins and the last ends)."""
        if len(self.number) > REMEMBERED or len(self.ids) > POOL:
            self.forget()
        split = [self.words(text) for text in texts]
        new = list({word for own in split for word in own if word not in self.number})
        if new:
            ids, count = _word_ids(self.model, new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        words = np.fromiter((self.number[word] for own in split for word in own), np.int64, sum(map(len, split)))
        count = self.count[words]
        end = np.cumsum(count)
        begin = np.cumsum(self.count) - self.count
        ids = self.ids[np.repeat(begin[words] - (end - count), count) + np.arange(int(count.sum()))]
        edges = np.cumsum([0, *map(len, split)])
        return ids, np.concatenate([[0], end])[edges]


def decoded(model: Pieces, ids: np.ndarray, edges: np.ndarray) -> list[str]:
    """Texts of runs of ids, which begin and end at ``edges``."""
    length = model.length[ids]
    end = np.cumsum(length)
    begin = end - length
    at = np.repeat(model.start[ids] - begin, length) + np.arange(int(length.sum()))
    raw = model.bytes[at]
    bounds = np.concatenate([[0], end])[edges]
    loud = np.concatenate([[0], np.cumsum(~model.silent[ids])])
    out = []
    for a, b, x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        if a < b:
            k = int(np.searchsorted(loud, loud[a], "right")) - 1  # the first id that isn't silent
            x += int(k < b and model.marked[ids[k]])
        own = raw[x:y].tobytes()
        try:
            out.append(own.decode())
        except UnicodeDecodeError:
            out.append(_repaired(own))
    return out


def _repaired(own: bytes) -> str:
    """Text of bytes that aren't all UTF-8: each byte that belongs to no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(own):
        lead = own[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            out.append(own[at : at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every document; ``path`` names the model file on every executor."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces(path or model_path()))
        for batch in batches:
            for low, end, data, offsets in slices(batch.column(1)):
                raw = data.tobytes()
                ids, edges = encoder([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
                cells = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, end - low), cells], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and text of rows (doc_id, ids); null ids are no ids, ids outside the vocabulary are an error."""
    small_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path or model_path())
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            texts = decoded(model, lists.flatten().to_numpy().astype(np.int64), edges)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of ids and text of rows (doc_id, ids, text)."""
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
