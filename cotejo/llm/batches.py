"""Words of whole Arrow batches as arrays: places, hashes and counts without a loop over words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b"\t\n\x0b\x0c\r "  # what separates words: x20 and x09 to x0D
IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 2 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
POWER = np.uint64(0x100000001B3)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Words:
    """Words of some texts laid end to end: byte range, text number and position within the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n_texts = data, offsets, len(offsets) - 1
        inside = IS_WORD[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts[first] = inside[first]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[last] = inside[last]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.per_text = np.bincount(self.text, minlength=self.n_texts)
        self.first = np.concatenate([[0], np.cumsum(self.per_text)])  # of each text, among all words
        self.place = np.arange(len(self.starts)) - self.first[self.text]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()), POWER)]))
        flat = self.data[self.inside].astype(np.uint64) + np.uint64(1)
        begins = np.cumsum(lengths) - lengths
        flat *= powers[np.arange(len(flat)) - np.repeat(begins, lengths)]
        return mixed(np.add.reduceat(flat, begins) + lengths.astype(np.uint64))

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of each run of ``size`` consecutive words of one text."""
        if len(hashes) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        count = len(hashes) - size + 1
        out = hashes[:count].copy()
        for i in range(1, size):
            out = out * POWER + hashes[i : i + count]
        at = np.flatnonzero(self.text[:count] == self.text[size - 1 :])
        return at, mixed(out[at])

    def texts(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            yield raw[a:b]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def means(values: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Mean of the values of each owner, 0 where it has none."""
    count = np.bincount(owner, minlength=owners)
    return np.bincount(owner, values, minlength=owners) / np.maximum(count, 1)
