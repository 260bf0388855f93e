"""SimHash near-dedup: fingerprints of word shingles, a trie self-join under a Hamming budget, and classes of linked texts.

Fingerprint: A-Z lower-cased, words as runs of characters other than x20 and x09-x0D, shingles of four words joined by one
space (a shorter text is one shingle), XXH64 with seed 42 of each; a bit is 1 if it is set in over half of them. A text
without words (or a null) has fingerprint zero and is linked like any other.

Equal fingerprints are one node, so copies never meet in pairs. Two fingerprints within the budget of ``BITS`` agree in
one of ``BITS`` + 1 blocks of their bits (pigeonhole), so the nodes are dealt by each block's value. In a group, a binary
trie over the sorted fingerprints is joined with itself: pairs of trie nodes descend together, the differing bits
accumulate, and a pair is dropped when they exceed the budget. Nodes that are linked already need no further link
within the group: a group returns a star per class, at most one link per member. A group of more than ``MOST`` members is
dealt again by the blocks of the remaining bits, which is exact for the same reason, until groups are small or all
blocks are used. Classes are the components of all links.

Nodes are fingerprints, so rows that share a doc_id are linked only by their texts. A missing doc_id is the smallest id
and comes back null, also as component.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cotejo.llm.batches import LOWER, Words, slices
from cotejo.llm.common import components, fresh, identified, partitions, real_id, row_keyed, small_batches, stored
from cotejo.operators.skew import join_unique

SHINGLE, BITS, SEED = 4, 4, 42
MOST = 2_000  # fingerprints that a group joins itself, unless no block is left to deal by
LEVELS = 3  # rounds of dealing by blocks
PAIRS = 1 << 18  # pairs of trie nodes that descend at once


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id (never null) and fingerprint, as a signed 64-bit number, of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, end, data, offsets in slices(batch.column(1)):
                prints = _prints(Words(LOWER[data], offsets), shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, end - low), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"])

    return identified(docs).mapInArrow(run, "doc_id bigint, fingerprint bigint")


def _prints(words: Words, shingle: int) -> np.ndarray:
    out = np.zeros(words.n_texts, np.uint64)
    if not len(words.starts):
        return out
    after = np.zeros(len(words.data), bool)
    after[1:] = words.inside[:-1] & ~words.inside[1:]
    kept = words.inside | after
    joined = memoryview(np.where(words.inside, words.data, 32)[kept].astype(np.uint8).tobytes())
    place = np.concatenate([[0], np.cumsum(kept)])
    begins, ends = place[words.starts], place[words.ends]
    count = np.where(words.per_text > 0, np.maximum(1, words.per_text - shingle + 1), 0)
    owner = np.repeat(np.arange(words.n_texts), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = words.first[owner] + at
    last = np.minimum(first + shingle, words.first[owner + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins[first].tolist(), ends[last].tolist())), np.uint64, len(first))
    full = np.flatnonzero(count)
    edges = (np.cumsum(count) - count)[full]
    for bit in range(64):
        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), edges).astype(np.int64)
        out[full] |= (2 * ones > count[full]).astype(np.uint64) << np.uint64(bit)
    return out


def blocks(width: int, budget: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of budget + 1 blocks of that many bits."""
    edges = [width * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def linked(prints: np.ndarray, budget: int) -> np.ndarray:
    """Class (index of its least member) of each of the distinct, ascending prints linked within the budget."""
    label = np.arange(len(prints))

    def join(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal label
        while True:  # hook the larger root to the smaller, then shorten paths
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (label[label] != label).any():
                label = label[label]

    # A trie node is a range of the sorted prints that share their upper bits.
    stack = [(64, np.array([[0, len(prints), 0, len(prints), 0]]))] if len(prints) > 1 else []
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > PAIRS:
            stack += [(depth, pairs[i : i + PAIRS]) for i in range(0, len(pairs), PAIRS)]
            continue
        a, b, c, d, differ = pairs.T
        single = (b - a == 1) & (d - c == 1)
        if single.any():
            x, y = a[single], c[single]
            near = np.bitwise_count(prints[x] ^ prints[y]) <= budget
            join(x[near], y[near])
            a, b, c, d, differ = pairs[~single].T
        if not len(a) or not depth:
            continue
        bit = np.uint64(depth - 1)
        # The place in each range where the next bit turns 1: prints of a node agree above it.
        ones = np.concatenate([[0], np.cumsum((prints >> bit) & np.uint64(1))]).astype(np.int64)
        m, n = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])
        same = a == c
        below = np.concatenate([
            np.column_stack([a, m, c, n, differ]), np.column_stack([m, b, n, d, differ]), np.column_stack([a, m, n, d, differ + 1]),
            np.column_stack([m, b, c, n, differ + 1])[~same],
        ])
        fits = (below[:, 1] > below[:, 0]) & (below[:, 3] > below[:, 2]) & (below[:, 4] <= budget)
        fits &= ~((below[:, 0] == below[:, 2]) & (below[:, 1] - below[:, 0] == 1))
        below = below[fits]
        if len(below):
            stack.append((depth - 1, below))
    return label


def _dealt(nodes: DataFrame, width: int, budget: int) -> DataFrame:
    """Each member once per block, in the group of those with its value there; ``rest`` loses the bits of the block."""

    def of(low: int, size: int):
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1))
        upper = F.shiftleft(F.shiftrightunsigned("rest", low + size), low) if low + size < 64 else F.lit(0).cast("bigint")
        rest = upper.bitwiseOR(F.col("rest").bitwiseAND(F.lit((1 << low) - 1)))
        return F.struct(F.xxhash64("group", F.lit(low), value).alias("group"), rest.alias("rest"))

    dealt = nodes.select("node", F.explode(F.array(*[of(*block) for block in blocks(width, budget)])).alias("_to"))
    return dealt.select("_to.group", "node", "_to.rest")


def links(nodes: DataFrame, budget: int = BITS, most: int = MOST) -> DataFrame:
    """(a, b) links of nodes (node, fingerprint), whose fingerprints are distinct, that give all classes within the budget."""
    found, width = None, 64
    waiting = nodes.select(F.lit(0).cast("bigint").alias("group"), "node", F.col("fingerprint").alias("rest"))
    for level in range(LEVELS):
        groups = stored(_dealt(waiting, width, budget))
        large = stored(groups.groupBy(F.col("group").alias("_group")).agg(F.count("*").alias("_n")).where(F.col("_n") > most))
        many = level + 1 < LEVELS and not large.isEmpty()
        small = groups.join(large, F.col("group") == F.col("_group"), "left_anti") if many else groups
        own = _joined(small, budget)
        found = own if found is None else found.union(own)
        if not many:
            break
        waiting = groups.join(large, F.col("group") == F.col("_group"), "left_semi")
        width -= min(size for _, size in blocks(width, budget))
    return found


def _joined(groups: DataFrame, budget: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(node: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            order = np.argsort(prints)
            label = linked(prints[order], budget)
            node = node[order]
            apart = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(node[label[apart]])], names=["a", "b"])

        rest = None  # the last group may go on in the next batch
        for batch in batches:
            own = [batch.column(i).to_numpy() for i in range(3)]
            own = own if rest is None else [np.concatenate(x) for x in zip(rest, own)]
            edges = np.flatnonzero(np.diff(own[0])) + 1
            starts, ends = np.concatenate([[0], edges[:-1]]).astype(np.int64), edges
            if len(edges):
                for x, y in zip(starts.tolist(), ends.tolist()):
                    if y - x > 1:
                        yield settle(own[1][x:y], own[2][x:y].view(np.uint64))
            cut = edges[-1] if len(edges) else 0
            rest = [x[cut:] for x in own]
        if rest is not None and len(rest[0]) > 1:
            yield settle(rest[1], rest[2].view(np.uint64))

    # Dealt by a hash of the group: by the group itself, Spark takes a shuffled join's deal for this one, and adaptive execution may undo that.
    spread = groups.repartition(partitions(groups.sparkSession), F.xxhash64("group")).sortWithinPartitions("group")
    return spread.select("group", "node", "rest").mapInArrow(run, "a bigint, b bigint")


def _classes(prints: DataFrame, budget: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(fingerprint and class of every node, class and component_id of every class) of stored prints (doc_id, fingerprint)."""
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    linked_nodes = components(links(nodes.select(F.col("fingerprint").alias("node"), "fingerprint"), budget, most))
    of_node = nodes.join(linked_nodes, F.col("fingerprint") == F.col("node"), "left")
    of_node = stored(of_node.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("class")))
    return of_node.drop("least"), of_node.groupBy("class").agg(F.min("least").alias("component_id"))


def near_classes(docs: DataFrame, budget: int = BITS, most: int = MOST) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable, of every document.

    An empty table gives no rows; other columns of the table, whatever their names, are not read.
    """
    prints = stored(fingerprints(docs))
    of_node, of_class = _classes(prints, budget, most)
    of_print = join_unique(of_node, ["class"], of_class, ["class"], "inner").select(F.col("fingerprint").alias("_print"), "component_id")
    rows = prints.join(of_print, F.col("fingerprint") == F.col("_print"))
    return rows.select(real_id(), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), real_id("component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, budget: int = BITS, most: int = MOST) -> DataFrame:
    """One document of each class, with all its columns: the first by doc_id (a missing one is the smallest).

    Rows that share a doc_id are documents of their own. All texts without words, nulls among them, are one class.
    An empty table stays empty; column names of the table don't clash with any made here.
    """
    rows, key = row_keyed(docs)
    prints = stored(fingerprints(rows.select(F.col(key).alias("doc_id"), "text"), shingle))
    chosen = stored(_classes(prints, budget, most)[1].select(F.col("component_id").alias(fresh(rows, "_chosen"))))
    return rows.join(chosen, F.col(key) == F.col(fresh(rows, "_chosen")), "left_semi").drop(key)
