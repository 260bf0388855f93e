"""Hard negatives for contrastive training: rows of other labels that score nearly as high as an anchor's positives.

Each component x of an embedding becomes floor(``SCALE`` * x), and a score is the exact integer inner product. Anchors are the
rows whose vec_id is divisible by ``EVERY``; all rows are scored against all of them, in blocks:

- All rows are packed once: a plane per bit of the components (two's complement), eight dimensions to a byte.
- For each group of eight dimensions of an anchor a table holds the sums of all 256 subsets of its components. A byte of a
  plane is an index into it; planes are added from the highest down, doubling the sum at each step (the sign plane counts
  negative). That is the full score of a pair, by lookups, shifts and additions only.
- ``BLOCK`` anchors at most travel with the tasks at a time (a fixed number of bytes, whatever the table's size). Every task
  keeps the best rows of each anchor it has seen and hands on only those; the first pass over rows of the same label gives the
  positives, the second one, over the others, the negatives between the bounds that the positives set.

Higher scores come first, ties by the smaller vec_id. Rows with a null label, a null vector or a null or non-finite component
take no part; a missing vec_id is the smallest one, no anchor, and comes back null. Rows are their own, also where they share an
id or repeat one another: a copy of an anchor is another row of its label, and each copy is an anchor. Vectors shorter than
the longest count as ending in zeros. An empty table, or one without anchors, gives no rows. Other columns are not read,
whatever they are called. Scores of 2 ** 47 or more are an error.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cotejo.llm.common import NO_ID, real_id, small_batches, stored

SCALE, EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # a negative's score in hundredths of the positive's
BLOCK = 1 << 15  # anchors that travel with the tasks at a time
ANCHORS, ROWS = 64, 4_096  # pairs that are scored at once
LARGEST = 2**47

# The rows as they take part, and their scores, in the checking engine's words.
SQL = """
    WITH named AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
    ), cells AS (
        SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM named
    ), bad AS (SELECT DISTINCT vec_id FROM cells WHERE x IS NULL OR NOT isfinite(x)
    ), whole AS (
        SELECT vec_id, label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS c FROM cells
        WHERE vec_id NOT IN (SELECT vec_id FROM bad)
    ), scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.c * b.c) AS BIGINT) AS score
        FROM whole a JOIN whole b ON a.i = b.i WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER own AS INTEGER) AS rank, s.vec_id AS negative_id,
           p.positive_score, s.score AS negative_score
    FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
    WINDOW own AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
    QUALIFY row_number() OVER own <= 5
"""


def shifted_labels(embeddings: DataFrame) -> DataFrame:
    """The rows, label becoming (label + 1) % 10 where vec_id is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.select("vec_id", "embedding", moved.alias("label"))


def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id (never null), label and the whole-numbered components of the rows that take part."""

    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    cells = F.col("embedding").cast("array<double>")
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(cells, unusable))
    return rows.select(
        F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.transform(cells, lambda x: F.floor(x * SCALE)).alias("cells"),
    )


def packed(cells: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of rows of components, eight dimensions to a byte: (rows, bits, groups), lowest plane first."""
    return np.stack([np.packbits((cells >> k) & 1, axis=1, bitorder="little") for k in range(bits)], axis=1)


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The components behind ``packed`` planes, padded to whole groups."""
    bits = planes.shape[1]
    weight = np.array([1 << k if k < bits - 1 else -(1 << k) for k in range(bits)], np.int64)
    return np.einsum("nkd,k->nd", np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64), weight)


def subset_sums(cells: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every eight dimensions of each anchor the sums of all subsets of its components."""
    anchors, width = cells.shape
    bound = int(np.abs(cells).sum(1).max(initial=0))
    kind = np.int16 if bound < 2**15 else np.int32 if bound < 2**31 else np.int64
    parts = cells.reshape(anchors, width // 8, 8).transpose(1, 2, 0).astype(kind)
    out = np.zeros((width // 8, 256, anchors), kind)
    for i in range(8):
        out[:, 1 << i : 2 << i] = out[:, : 1 << i] + parts[:, i, None]
    return out


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(rows, anchors): inner products of packed rows with the anchors of the tables."""
    rows, bits, groups = planes.shape
    out = np.zeros((rows, tables.shape[2]), np.int64)
    own, part = np.empty((2, *out.shape), tables.dtype)
    for k in reversed(range(bits)):
        own[:] = 0
        for group in range(groups):
            own += np.take(tables[group], planes[:, k, group], axis=0, out=part, mode="clip")
        out = (out << 1) + own if k < bits - 1 else -own.astype(np.int64)
    return out


class Best:
    """The best rows of each slot: the highest scores, ties by the smaller id."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.extra = np.zeros(0, bool)
        self.least = np.full(slots, np.iinfo(np.int64).min)  # no lower score can enter

    def offer(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray, extra: np.ndarray) -> None:
        """Consider further rows; ``extra`` is a flag that stays with a row."""
        if not len(slot):
            return
        slot, score, row = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, row)))
        extra = np.concatenate([self.extra, extra])
        order = np.lexsort((row, -score, slot))
        slot, score, row, extra = slot[order], score[order], row[order], extra[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        nth = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = nth < self.most
        last = nth == self.most - 1
        self.least[slot[last]] = score[last]
        self.slot, self.score, self.id, self.extra = slot[kept], score[kept], row[kept], extra[kept]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.slot, self.score, self.id, self.extra)], names=["slot", "score", "id", "own"])


FOUND = "slot bigint, score bigint, id bigint, own boolean"


def _rows(batch: pa.RecordBatch, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """vec_id, label and planes of a batch of packed rows."""
    raw = batch.column(2).cast(pa.large_binary())
    size = len(raw[0].as_py())
    planes = np.frombuffer(raw.buffers()[2], np.uint8, len(raw) * size, np.frombuffer(raw.buffers()[1], np.int64, 1, raw.offset * 8)[0])
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), planes.reshape(len(raw), bits, -1)


def _pairs(rows: tuple, anchors: tuple, same: bool) -> Iterator[tuple]:
    """(row numbers, anchor numbers, scores) of all rows against all anchors of the same label, or of any label.

    Anchors are ordered by label.
    """
    ids, labels, planes = rows
    label, cells = anchors
    starts = np.flatnonzero(np.diff(label, prepend=label[0] - 1)) if same else np.zeros(1, np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(label)]):
        at = np.flatnonzero(labels == label[a]) if same else np.arange(len(ids))
        for i in range(a, b if len(at) else a, ANCHORS):
            own = np.arange(i, min(i + ANCHORS, b))
            tables = subset_sums(cells[own])
            for k in range(0, len(at), ROWS):
                some = at[k : k + ROWS]
                yield some, own, scores(planes[some], tables)


def _positives(packed_rows: DataFrame, bits: int, anchors: tuple, most: int) -> DataFrame:
    """(slot, score, id, own) of each task's best rows of each anchor's label; ``own`` marks rows equal to the anchor."""
    anchor_id, label, planes = anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchor_id), most + 1)  # the anchor itself may be among them
        cells = unpacked(planes)
        for batch in batches:
            rows = _rows(batch, bits) if len(batch) else None
            for at, own, score in _pairs(rows, (label, cells), True) if rows else ():
                r, a = np.nonzero(score >= best.least[own])
                row, anchor = at[r], own[a]
                alike = (rows[0][row] == anchor_id[anchor]) & (score[r, a] == score[r, a])
                alike[alike] = (rows[2][row[alike]] == planes[anchor[alike]]).all((1, 2))
                best.offer(anchor, score[r, a], rows[0][row], alike)
        yield best.batch()

    return packed_rows.mapInArrow(run, FOUND)


def _negatives(packed_rows: DataFrame, bits: int, anchors: tuple, bounds: np.ndarray, wanted: tuple) -> DataFrame:
    """(slot, score, id, own) of each task's best negatives; slot is anchor number times positives plus the positive's place.

    ``bounds`` are the positives' scores, (anchors, positives), the least number where there is none.
    """
    _, label, planes = anchors
    most, low, high = wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = bounds.shape[1]
        best = Best(bounds.size, most)
        cells = unpacked(planes)
        there = bounds > np.iinfo(np.int64).min
        # high * positive >= 100 * score >= low * positive, in whole numbers
        top = np.where(there, np.floor_divide(high * np.where(there, bounds, 0), 100), -1)
        bottom = np.where(there, -np.floor_divide(-low * np.where(there, bounds, 0), 100), 0)
        for batch in batches:
            rows = _rows(batch, bits) if len(batch) else None
            for at, own, score in _pairs(rows, (label, cells), False) if rows else ():
                other = rows[1][at][:, None] != label[own]
                for place in range(each):
                    slot = own * each + place
                    near = (score <= top[own, place]) & (score >= np.maximum(bottom[own, place], best.least[slot]))
                    r, a = np.nonzero(near & other)
                    best.offer(slot[a], score[r, a], rows[0][at[r]], np.zeros(len(r), bool))
        yield best.batch()

    return packed_rows.mapInArrow(run, FOUND)


def mine(
    embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, every: int = EVERY, block: int = BLOCK
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    For each anchor and each of its first ``positives`` rows of the same label: the first ``negatives`` rows of other labels
    with ``low`` * positive_score <= 100 * negative_score <= ``high`` * positive_score.
    """
    spark = embeddings.sparkSession
    small_batches(spark)
    rows = _usable(embeddings)
    width, most, least = rows.agg(
        F.max(F.size("cells")), F.max(F.array_max("cells")), F.min(F.array_min("cells"))
    ).first()
    width = -(-max(width or 0, 1) // 8) * 8
    most, least = max(most or 0, 0), min(least or 0, 0)
    if width * max(most, -least) ** 2 >= LARGEST:
        raise ValueError(f"components from {least} to {most} in {width} dimensions: scores may reach {LARGEST}")
    bits = max(most.bit_length(), (-least - 1).bit_length() if least else 0) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((len(batch), width), np.int64)
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            cells[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
            planes = pa.array([row.tobytes() for row in packed(cells, bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), planes], names=["vec_id", "label", "planes"])

    packed_rows = stored(rows.mapInArrow(pack, "vec_id bigint, label bigint, planes binary"))
    anchors = stored(packed_rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "label", "planes").agg(F.count("*").alias("copies")))
    blocks = max(1, -(-anchors.count() // block))
    out = None
    for nth in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "planes"), F.lit(blocks)) == nth)
        found = _of_block(packed_rows, bits, own, positives, (negatives, low, high))
        if found is not None:
            found = stored(found) if blocks > 1 else found
            out = found if out is None else out.union(found)
    return spark.createDataFrame([], RESULT) if out is None else out


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _of_block(packed_rows: DataFrame, bits: int, anchors: DataFrame, positives: int, wanted: tuple) -> DataFrame | None:
    """The result for one block of distinct anchors (vec_id, label, planes, copies); None where there are none."""
    spark = anchors.sparkSession
    some = anchors.orderBy("label", "vec_id", "planes").toArrow()
    if not some.num_rows:
        return None
    anchor_id, label, copies = (some.column(c).to_numpy() for c in ("vec_id", "label", "copies"))
    planes = np.stack([np.frombuffer(x, np.uint8).reshape(bits, -1) for x in some.column("planes").to_pylist()])
    held = (anchor_id, label, planes)

    in_order = [F.desc("score"), F.asc("id")]
    found = _positives(packed_rows, bits, held, positives)
    first = found.withColumn("_n", F.row_number().over(Window.partitionBy("slot").orderBy(*in_order, F.desc("own")))).where(F.col("_n") <= positives + 1)
    itself = F.row_number().over(Window.partitionBy("slot", "own").orderBy(*in_order))
    others = first.withColumn("_itself", F.col("own") & (itself == 1)).where("not _itself")
    ranked = others.withColumn("place", F.row_number().over(Window.partitionBy("slot").orderBy(*in_order)) - 1).where(F.col("place") < positives)
    known = ranked.select("slot", "place", "id", "score").toArrow()  # at most ``positives`` rows for each anchor of the block
    slot, place, row, score = (known.column(i).to_numpy() for i in range(4))
    bounds = np.full((len(anchor_id), positives), np.iinfo(np.int64).min)
    bounds[slot, place] = score

    near = _negatives(packed_rows, bits, held, bounds, wanted)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("slot").orderBy(*in_order))).where(F.col("rank") <= wanted[0])
    named = pa.table({
        "_slot": slot * positives + place, "anchor": anchor_id[slot], "positive_id": row, "positive_score": score, "copies": copies[slot],
    })
    named = spark.createDataFrame(named)
    joined = best.join(named, F.col("slot") == F.col("_slot")).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return joined.select(
        F.col("anchor").alias("anchor_id"), real_id("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.when(F.col("id") != F.lit(NO_ID), F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
