"""Rows of a very large table that may match a small one, kept before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key of the small side, bits of one bitmap (Spark's bitmaps have as many), most bytes that are
#: sent to the executors.
BITS, BITMAP, MOST_BYTES = 16, 8 * 4096, 64 << 20


def may_match(large: DataFrame, small: DataFrame, keys: list[str], bits: int = BITS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of ``large`` whose keys occur in ``small``, and by chance about one of ``bits`` others: a
    Bloom filter with one hash, made of bitmaps by an aggregate over ``small`` and broadcast, as its size is
    known. Where it would pass ``most_bytes``, ``large`` comes back as it is. Rows with a null key go."""
    size = -(-max(1, small.count()) * bits // BITMAP) * BITMAP
    if size // 8 > most_bytes:
        return large
    place = F.pmod(F.xxhash64(*keys), F.lit(size))
    has_keys = " and ".join(f"`{k}` is not null" for k in keys)
    bitmaps = small.where(has_keys).select(place.alias("_at")).groupBy(F.expr(f"_at div {BITMAP}").alias("_map")).agg(F.bitmap_construct_agg(F.col("_at") % BITMAP).alias("_bits"))
    rows = large.where(has_keys).withColumn("_at", place)
    met = rows.join(F.broadcast(bitmaps), F.expr(f"_at div {BITMAP}") == F.col("_map"))
    return met.where(_bit(F.col("_bits"), (F.col("_at") % BITMAP).cast("int"))).select(*[F.col(f"`{c}`") for c in large.columns])


def _bit(bitmap: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, at % 8).bitwiseAND(F.lit(1)) == 1
