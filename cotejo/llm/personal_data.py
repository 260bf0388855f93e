"""Personal data: base patterns, and a bidirectional character LSTM with CRF transitions that adds further spans.

Base spans (email, ip, card, phone) are found by fixed rules in whole texts, per kind leftmost and non-overlapping. The
model is trained in numpy, on the driver, from labelled spans: base spans in a bounded sample of documents, and the
same values in disguises the rules don't know (masked at signs, numbers without a plus or with other separators), each in its
surroundings; look-alikes (versions, hashes, keys, ids) are labelled as nothing.

Windows are laid over the whole text, overlapping by half, and each place takes the tag of the window in whose middle it
stands. A span is accepted only with a digit or where it touches an address, plain or with "at" and "dot" spelled out in
any case, which it then covers as a whole. So the windows with those are decoded first, and from them on to either side as long as a span goes on: the accepted spans are those of
decoding every window. Windows of many texts are scored together and decoded by Viterbi. Spans that cross windows come out whole. A span is added if it meets its kind's own conditions (Luhn, number of
digits, parts up to 255) and touches no base span.

Offsets count code points. Null and empty texts have no spans; missing ids stay null, repeated rows are judged alike,
further columns play no part. Without labelled spans to learn from, the base spans stand alone.
"""

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from cotejo.llm import labelled
from cotejo.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
FIT_DOCUMENTS = 1500  # documents with an at sign or a digit that the model may learn from
WINDOW, STRIDE = 64, 32
HIDDEN, SYMBOLS = 20, 130  # units per direction; characters: ASCII, other letters, padding
TAGS = 1 + 2 * len(KINDS)  # nothing, then begin and inside of each kind
AT_ONCE = 4096  # windows decoded together
COLUMNS = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]+|(?<![^\W_])at(?![^\W_])", re.I)  # every span that is accepted holds one
_DOT = r"(?:\s?[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s?|\s+dot\s+)"
# An address is its at sign (or "at"), the host behind it, and the name before, which is read backwards.
AT = re.compile(r"[(\[{<]\s?(?:at|@)\s?[)\]}>]|@|(?<=\s)at(?=\s)", re.I)
HOST = re.compile(rf"(?:(?<=\sat)\s++|\s?)[\w-]++(?:(?:\.|{_DOT})[\w-]++)++", re.I)
NAME = regex.compile(rf"(?r)(?<![\w.%+-])[\w.%+-]++(?:{_DOT}[\w.%+-]++)*", regex.I)
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def is_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    return len(parts) == 4 and all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in parts)


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 10 <= len(digits_of(text)) <= 15


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:  # the pattern starts where the run of local characters before an at sign does
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if is_ip(m.group())]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m.group())]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if is_phone(m.group())]
    return sorted(out)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, points, 128).astype(np.int16)


@dataclass
class Network:
    """Weights of both directions (input rows, recurrent, per gate: in, forget, out, new), of the tags, and transitions."""

    inputs: np.ndarray  # 2 x SYMBOLS x 4H
    recurrent: np.ndarray  # 2 x H x 4H
    output: np.ndarray  # 2H x TAGS
    bias: np.ndarray  # TAGS
    transitions: np.ndarray  # TAGS x TAGS

    @staticmethod
    def new(seed: int = 5) -> "Network":
        rng = np.random.default_rng(seed)
        inputs = rng.normal(0, 0.3, (2, SYMBOLS, 4 * HIDDEN))
        inputs[:, :, HIDDEN : 2 * HIDDEN] += 1.0
        weights = inputs, rng.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)), rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS))
        return Network(*[x.astype(np.float32) for x in weights])

    def run(self, x: np.ndarray, keep: bool = False):
        """Emissions of windows (N x T codes), and what the backward pass needs."""
        n, t = x.shape
        outputs = np.empty((2, t, n, HIDDEN), np.float32)
        kept: list[list] = [[], []]
        for way in (0, 1):
            h = np.zeros((n, HIDDEN), np.float32)
            c = np.zeros((n, HIDDEN), np.float32)
            for step in range(t) if way == 0 else range(t - 1, -1, -1):
                gates = self.inputs[way][x[:, step]] + h @ self.recurrent[way]
                act = 0.5 + 0.5 * np.tanh(0.5 * gates[:, : 3 * HIDDEN])
                new = np.tanh(gates[:, 3 * HIDDEN :])
                before = c
                c = act[:, HIDDEN : 2 * HIDDEN] * c + act[:, :HIDDEN] * new
                top = np.tanh(c)
                if keep:
                    kept[way].append((step, act, new, before, top, h))
                h = act[:, 2 * HIDDEN :] * top
                outputs[way, step] = h
        states = np.concatenate([outputs[0], outputs[1]], axis=2)  # T x N x 2H
        return states @ self.output + self.bias, states, kept

    def tags(self, x: np.ndarray) -> np.ndarray:
        """Best tags of windows by Viterbi."""
        emissions, _, _ = self.run(x)
        t, n, _ = emissions.shape
        score, back = emissions[0], np.empty((t, n, TAGS), np.int8)
        for step in range(1, t):
            both = score[:, :, None] + self.transitions
            back[step] = both.argmax(1)
            score = both.max(1) + emissions[step]
        out = np.empty((n, t), np.int8)
        out[:, -1] = score.argmax(1)
        for step in range(t - 1, 0, -1):
            out[:, step - 1] = np.take_along_axis(back[step], out[:, step, None].astype(np.int64), 1)[:, 0]
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of tags y of windows x, and the slopes of all weights."""
        emissions, states, kept = self.run(x, keep=True)
        t, n, _ = emissions.shape
        trans = self.transitions.astype(np.float64)
        forward = [emissions[0].astype(np.float64)]
        for step in range(1, t):
            forward.append(_sum_exp(forward[-1][:, :, None] + trans, 1) + emissions[step])
        total = _sum_exp(forward[-1], 1)
        backward = np.zeros((n, TAGS))
        slope_e = np.empty((t, n, TAGS))
        slope_t = np.zeros((TAGS, TAGS))
        rows = np.arange(n)
        gold = emissions[0][rows, y[:, 0]].astype(np.float64)
        for step in range(1, t):
            gold = gold + emissions[step][rows, y[:, step]] + trans[y[:, step - 1], y[:, step]]
            np.add.at(slope_t, (y[:, step - 1], y[:, step]), -1.0)
        for step in range(t - 1, -1, -1):
            slope_e[step] = np.exp(forward[step] + backward - total[:, None])
            slope_e[step][rows, y[:, step]] -= 1
            if step:
                ahead = backward + emissions[step]
                pair = np.exp(forward[step - 1][:, :, None] + trans + ahead[:, None, :] - total[:, None, None])
                slope_t += pair.sum(0)
                backward = _sum_exp(trans + ahead[:, None, :], 2)
        slope_e = (slope_e / n).astype(np.float32)
        flat, states_flat = slope_e.reshape(-1, TAGS), states.reshape(-1, 2 * HIDDEN)
        slopes = [np.zeros_like(self.inputs), np.zeros_like(self.recurrent), states_flat.T @ flat, flat.sum(0), (slope_t / n).astype(np.float32)]
        slope_h = (slope_e @ self.output.T).reshape(t, n, 2, HIDDEN)
        for way in (0, 1):
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for step, act, new, before, top, h in reversed(kept[way]):
                into, forget, out = (act[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(3))
                dh = dh + slope_h[step, :, way]
                dc = dc + dh * out * (1 - top * top)
                gates = np.concatenate([dc * new * into * (1 - into), dc * before * forget * (1 - forget), dh * top * out * (1 - out), dc * into * (1 - new * new)], axis=1)
                np.add.at(slopes[0][way], x[:, step], gates)
                slopes[1][way] += h.T @ gates
                dh, dc = gates @ self.recurrent[way].T, dc * forget
        return float((total - gold).mean()), slopes


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(x: np.ndarray, y: np.ndarray, steps: int = 560, batch: int = 48, seed: int = 5) -> Network:
    """Adam on the CRF's likelihood; x are windows of codes, y their tags."""
    network, rng = Network.new(seed), np.random.default_rng(seed)
    weights = [network.inputs, network.recurrent, network.output, network.bias, network.transitions]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    waiting = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(waiting) < min(batch, len(x)):
            waiting = rng.permutation(len(x))
        own, waiting = waiting[:batch], waiting[batch:]
        _, slopes = network.gradients(x[own], y[own])
        rate = 0.02 * (1 - 0.9 * step / steps)
        for w, a, b, slope in zip(weights, first, second, slopes):
            np.clip(slope, -1, 1, out=slope)
            a += 0.1 * (slope - a)
            b += 0.01 * (slope * slope - b)
            w -= rate * a / (1 - 0.9**step) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
    return network


def disguises(value: str, kind: int, rng: np.random.Generator) -> str:
    """The value as a writer might hide or reformat it."""
    if kind == 0:
        local, _, domain = value.partition("@")
        if rng.random() < 0.2:
            local = (local + "." + local[::-1]) * 3
        form = rng.integers(9)
        at = (" [at] ", " (at) ", "[at]", "(at)", " @ ", " at ", " (AT) ", " {at} ", " AT ")[form]
        dot = (".", " dot ", "[dot]", " DOT ")[rng.integers(4)] if form < 5 else (" dot ", " dot ", ".", " DOT ")[form - 5]
        return local + at + domain.replace(".", dot)
    digits = digits_of(value)
    if kind == 1:
        return value
    if kind == 2:
        return [".", "/", "_", "  "][rng.integers(4)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if len(digits) < 11:
        return value
    own = digits[-10:]
    forms = ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "00 1 {} {} {}")
    return forms[rng.integers(len(forms))].format(own[:3], own[3:6], own[6:])


def examples(texts: list[str], most: int = 2400, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags around base spans, disguised ones and look-alikes of the texts."""
    rng = np.random.default_rng(seed)
    made: list[tuple[str, list[Span]]] = []
    for text in texts:
        spans = base_spans(text)
        if any(a[2] > b[0] for a, b in zip(spans, spans[1:])):
            continue
        for start, kind, end in spans:
            low, high = max(0, start - 40), min(len(text), end + 40)
            near = [(a - low, k, b - low) for a, k, b in spans if a >= low and b <= high]
            made.append((text[low:high], near))
            before, after = text[max(0, start - 30) : start], text[end : end + 30]
            for other in dict.fromkeys(disguises(text[start:end], kind, rng) for _ in range(4 if kind != 1 else 1)):
                if other != text[start:end] and not ANCHOR.search(before + after):
                    made.append((before + other + after, [(len(before), kind, len(before) + len(other))]))
        taken = {p for a, _, b in spans for p in range(a, b)}
        odd = [m.start() for m in ANCHOR.finditer(text) if m.start() not in taken]
        for at in odd[:2]:
            low, high = max(0, at - 40), min(len(text), at + 50)
            made.append((text[low:high], [(a - low, k, b - low) for a, k, b in spans if a >= low and b <= high]))
    order = rng.permutation(len(made))[:most]
    x, y = np.full((len(order), WINDOW), SYMBOLS - 1, np.int16), np.zeros((len(order), WINDOW), np.int8)
    for row, i in enumerate(order.tolist()):
        text, spans = made[i]
        shift = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        own = codes(text)[shift : shift + WINDOW]
        x[row, : len(own)] = own
        for start, kind, end in spans:
            a, b = max(0, start - shift), min(WINDOW, end - shift)
            if a < b:
                y[row, a:b] = 2 + 2 * kind
                if start >= shift:
                    y[row, a] = 1 + 2 * kind
    return x, y


def found(texts: list[str], network: Network) -> list[list[Span]]:
    """Spans that hold an anchor, from the decoded tags of each text."""
    quarter = (WINDOW - STRIDE) // 2
    coded: dict[int, np.ndarray] = {}
    tags: dict[int, np.ndarray] = {}
    waiting: list[tuple[int, int]] = []  # text, number of the window
    for i, text in enumerate(texts):
        last = (max(1, len(text) - WINDOW + STRIDE) - 1) // STRIDE
        own = {min(max(0, p - quarter) // STRIDE, last) for m in ANCHOR.finditer(text) for p in range(m.start(), m.end())}
        if own:
            own |= {min(max(0, p - quarter) // STRIDE, last) for a, b in addresses(text) for p in range(a, b)}
            coded[i], tags[i] = codes(text), np.zeros(len(text), np.int8)
            waiting += [(i, j) for j in sorted(own)]
    seen = set(waiting)
    while waiting:
        own, waiting = waiting[:AT_ONCE], waiting[AT_ONCE:]
        x = np.full((len(own), WINDOW), SYMBOLS - 1, np.int16)
        for row, (i, j) in enumerate(own):
            piece = coded[i][j * STRIDE : j * STRIDE + WINDOW]
            x[row, : len(piece)] = piece
        for (i, j), got in zip(own, network.tags(x)):
            s, end = j * STRIDE, len(tags[i])
            low = s if s == 0 else s + quarter  # the middle of a window counts, and its ends where no other has them
            high = end if s + WINDOW >= end else s + WINDOW - quarter
            tags[i][low:high] = got[low - s : high - s]
            # A span that reaches the end of the middle goes on in the next window.
            for edge, near in ((low, (i, j - 1)), (high - 1, (i, j + 1))):
                if got[edge - s] and 0 < (edge if near[1] < j else end - high) and near not in seen:
                    seen.add(near)
                    waiting.append(near)
    out: list[list[Span]] = [[] for _ in texts]
    for i, own in tags.items():
        inside = np.flatnonzero(own)
        if not len(inside):
            continue
        kind = (own[inside] - 1) // 2
        cut = np.concatenate([[True], (np.diff(inside) > 1) | (np.diff(kind) != 0) | (own[inside[1:]] % 2 == 1), [True]])
        edges = np.flatnonzero(cut)
        out[i] += [(int(inside[x]), int(kind[x]), int(inside[y - 1]) + 1) for x, y in zip(edges[:-1], edges[1:])]
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Places of what is written like an address, plain or spelled out; ``accepted`` takes those that the network touches.

    Every at sign looks ahead once, and back as far as the address before, so the time is linear in the text.
    """
    out: list[tuple[int, int]] = []
    end = 0
    for at in AT.finditer(text):
        stop = at.start()
        if at.group()[0].isalpha():
            while stop > end and text[stop - 1].isspace():
                stop -= 1
        elif stop and text[stop - 1].isspace():
            stop -= 1
        if stop > end and (text[stop - 1].isalnum() or text[stop - 1] in "_.%+-"):
            host = HOST.match(text, at.end())
            name = NAME.match(text, end, stop) if host else None
            if name:
                end = host.end()
                out.append((name.start(), end))
    return out


def accepted(text: str, base: list[Span], more: list[Span]) -> list[Span]:
    """The further spans that stand free of base spans and look like their kind."""
    fits = (lambda x: True, is_ip, is_card, is_phone)
    written_so = addresses(text) if any(kind == 0 for _, kind, _ in more) else []
    ends = [end for _, end in written_so]
    out: list[Span] = []
    starts = [start for start, _, _ in base]
    for start, kind, end in more:
        raw = text[start:end]
        start, end = start + len(raw) - len(raw.lstrip(" ,;:")), end - (len(raw) - len(raw.rstrip(" ,;:.-")))
        if kind == 0:  # an address is taken as a whole, and once
            first = bisect_right(ends, start)
            if first == len(ends) or written_so[first][0] >= end or (written_so[first][0], 0, ends[first]) in out[-1:]:
                continue
            start, end = written_so[first]
        value = text[start:end]
        if not value or (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()) or not fits[kind](value):
            continue
        near = bisect_left(starts, end)
        if any(e > start for _, _, e in base[max(0, near - 8) : near]):
            continue
        out.append((start, kind, end))
    return out


def detect(docs: DataFrame, network: Network | None) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    small_batches(docs.sparkSession)
    kinds = (pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string())
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            more = found(texts, network) if network else [[] for _ in texts]
            out = []
            for doc, text, own in zip(batch.column(0).to_pylist(), texts, more):
                base = base_spans(text)
                spans = sorted(base + accepted(text, base, own)) if own else base
                count = [sum(kind == k for _, kind, _ in base) for k in range(4)]
                out.append((doc, *count, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, COLUMNS)


def fitted(docs: DataFrame, most: int = FIT_DOCUMENTS) -> Network | None:
    """The network, trained on base spans of at most ``most`` documents (those with the least id hash)."""
    some = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id", "text")
    rows = labelled.least_hashed(some, most).collect()
    x, y = examples([row["text"] for row in rows])
    return train(x, y) if (y > 0).any() else None
