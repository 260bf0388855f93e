"""Which parts of a table may hold a key, told by bitmaps of key hashes instead of the rows.

Keys are spread over buckets by hash, the keys of a bucket over chunks of about ``KEYS``, and every key sets ``PROBES``
bits in the bitmap of its chunk. Four bytes a key make one in some 5,000 unknown keys look known; a known one always does.
Bitmaps are built by an aggregation and met by an equi join on bucket and chunk, so neither side is gathered anywhere.
"""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cotejo.operators.shape import quoted

BITS = 32_768  # of a bitmap; Spark's bitmap functions fix it
KEYS = 1_024  # a bitmap is for
PROBES = 4  # 15 bits each, of one 64-bit hash


@dataclass(frozen=True, order=True)
class Shape:
    """How the keys of one part are spread."""

    buckets: int
    chunks: int = 1

    @classmethod
    def of(cls, buckets: int, rows: int) -> "Shape":
        """Chunks for this many keys, as a power of two: parts of alike size share a shape."""
        return cls(buckets, 1 << max(0, -(-rows // (buckets * KEYS)) - 1).bit_length())

    def bucket(self, names: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(F.lit("bucket"), *map(quoted, names)), F.lit(self.buckets)).cast("int")

    def chunk(self, names: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(F.lit("chunk"), *map(quoted, names)), F.lit(self.chunks))


def positions(names: Sequence[str]) -> list[Column]:
    bits = F.xxhash64(F.lit("bits"), *map(quoted, names))
    return [F.shiftrightunsigned(bits, 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(PROBES)]


def bitmaps(keys: DataFrame, names: Sequence[str], shape: Shape) -> DataFrame:
    """(buckets, chunks, bucket, chunk, bitmap) of the keys; no row where a chunk has none."""
    bits = keys.select(shape.bucket(names).alias("bucket"), shape.chunk(names).alias("chunk"), F.explode(F.array(*positions(names))).alias("position"))
    found = bits.groupBy("bucket", "chunk").agg(F.bitmap_construct_agg("position").alias("bitmap"))
    return found.select(F.lit(shape.buckets).alias("buckets"), F.lit(shape.chunks).cast("bigint").alias("chunks"), "bucket", "chunk", "bitmap")


def parts_that_may_hold(keys: DataFrame, names: Sequence[str], marked: DataFrame, shapes: Iterable[Shape], part: str) -> DataFrame:
    """Distinct (part, bucket) whose bitmaps in ``marked`` have all bits of some key. Keys must have the types of the marked ones."""
    spread = [F.struct(F.lit(s.buckets).alias("buckets"), F.lit(s.chunks).cast("bigint").alias("chunks"), s.bucket(names).alias("bucket"), s.chunk(names).alias("chunk")) for s in sorted(set(shapes))]
    probes = keys.select(F.explode(F.array(*spread)).alias("at"), F.array(*positions(names)).alias("positions")).select("at.*", "positions")
    met = probes.join(marked, ["buckets", "chunks", "bucket", "chunk"])
    return met.where(F.forall("positions", lambda p: _is_set(F.col("bitmap"), p))).select(part, "bucket").distinct()


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, position.bitwiseAND(F.lit(7)).cast("int")) == 1
