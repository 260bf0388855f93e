"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Each shard has ``NODES`` points on the ring. A key belongs to the arc that its hash falls in, and asks the shard at the
arc's end. Shards are bounded: together they hold exactly all rows, and their loads differ by one row at most (law
``rows``). Keys that overflow a full shard continue clockwise to the next shard with room. Arcs are served in rounds: in
the first round every arc asks its own shard, in each next round the overflow asks the next other shard clockwise;
within a shard earlier arcs are served first, within an arc lower ranks.

Only the number of keys of each arc decides that flow, and there are ``shards * NODES`` arcs whatever the data; the driver turns
those counts into at most that many times ``shards`` ranges of ranks. Rows find shard and slot by their rank in their
arc. The hash is of the text, so equal texts share an arc and mostly a shard; a group larger than a shard flows on.

The bounds are exact and shrink when a shard is added, and ranks depend on the number of rows, so how many rows move
then is not bounded; only the bare ring moves no more than the new points take over. A null text has no bytes and is
the empty text's equal; missing ids and repeated rows get a place each; further columns play no part.
"""

import zlib

from pyspark.sql import DataFrame, functions as F

from cotejo.llm.common import ranked, stored

SHARDS, NODES = 8, 32
RING_BITS = 32


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(point, shard) of all virtual nodes, ascending; a fixed function of the two numbers."""
    return sorted((zlib.crc32(f"shard {s} node {v}".encode()) & (2**RING_BITS - 1), s) for s in range(shards) for v in range(nodes))


def flow(keys: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges (arc, first rank, end rank, shard, first slot) for so many keys in each arc, whose end belongs to its owner.

    Loads are as equal as can be: the lowest-numbered shards hold one row more where the rows don't divide evenly.
    """
    total = sum(keys)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled, served, ranges = [0] * shards, [0] * len(keys), []
    clockwise = []
    for arc in range(len(owners)):
        seen = dict.fromkeys(owners[arc:] + owners[:arc])
        clockwise.append(list(seen))
    for turn in range(shards):
        for arc, n in enumerate(keys):
            if turn >= len(clockwise[arc]):
                continue
            shard = clockwise[arc][turn]
            take = min(n - served[arc], room[shard] - filled[shard])
            if take:
                ranges.append((arc, served[arc], served[arc] + take, shard, filled[shard]))
                served[arc] += take
                filled[shard] += take
    return ranges


def shard(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and arc of every row."""
    points = ring(shards, nodes)
    edges = [point for point, _ in points]
    text = F.coalesce("text", F.lit(""))
    at = F.xxhash64(text).bitwiseAND(F.lit(2**RING_BITS - 1))
    # The arc is the number of points before the key's place; past the last point the ring closes at the first.
    before = sum((at > F.lit(edge)).cast("int") for edge in edges)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(before, F.lit(len(edges))).cast("int").alias("arc"),
    )
    rows = stored(rows)
    counts = {row["arc"]: row["n"] for row in rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    ranges = flow([counts.get(arc, 0) for arc in range(len(points))], [s for _, s in points], shards)
    schema = "_arc int, _low long, _high long, shard int, _slot long"
    where = F.broadcast(docs.sparkSession.createDataFrame(ranges, schema))  # at most arcs times shards rows
    numbered = ranked(rows, ["arc"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    here = (F.col("arc") == F.col("_arc")) & (F.col("rank") >= F.col("_low")) & (F.col("rank") < F.col("_high"))
    placed = numbered.join(where, here)
    slot = F.col("_slot") + F.col("rank") - F.col("_low")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "arc")
