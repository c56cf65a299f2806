"""Sharding by a Feistel permutation with cycle walking over global row numbers, in SQL functions only.

Rows are numbered 0 to n - 1; a keyed permutation of that range gives each its place in a shuffle;
place ``p`` lies in shard ``p mod shards`` at slot ``p div shards``. Shard sizes are at most one row
apart and slots have no gaps. Both ways are computable: ``permuted`` gives the place of a row,
``unpermuted`` the row at a place.

The permutation acts on pairs (left, right) of ``a x b >= n`` values, the smallest near-square such
grid: each round adds a hash of one half to the other. A value of n or more is permuted again
(cycle walking). A walk leaves the ``a * b - n < a`` values outside after at most as many steps; from
n = 4096 on, 64 steps fail with probability under ``2**-384``, and then the row raises an error.

Equal rows are counted before they are dealt out, so no task meets all of them; a row that stands for
very many copies is spread over tasks before it is multiplied.

Nulls: a null text has size 1 and the checksum of no bytes; null ids are numbered like others. Equal
rows get different places, either way round. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import BUCKET, RANGE, copies, running_sum
from .scratch import materialize

ROUNDS, WALK = 6, 64


def _grid(n: int) -> tuple[int, int]:
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by).cast("long"))


def _rounds(x: Column, n: int, seed: int, back: bool) -> Column:
    a, b = _grid(n)
    left, right = _div(x, b), F.pmod(x, F.lit(b))
    for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
        sign = -1 if back else 1
        noise = F.xxhash64(right if k % 2 == 0 else left, F.lit(seed), F.lit(k))
        if k % 2 == 0:
            left = F.pmod(left + sign * F.pmod(noise, F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + sign * F.pmod(noise, F.lit(b)), F.lit(b))
    return left * F.lit(b) + right


def _walked(x: Column, n: int, seed: int, back: bool) -> Column:
    a, b = _grid(n)
    steps = min(a * b - n, WALK)
    once = _rounds(x, n, seed, back)
    if not steps:
        return once
    y = F.aggregate(F.array_repeat(F.lit(0), steps), once, lambda at, _: F.when(at < n, at).otherwise(_rounds(at, n, seed, back)))
    return y if steps == a * b - n else F.when(y < n, y).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def permuted(row: Column, n: int, seed: int) -> Column:
    """Place of row number ``row`` of ``n`` in the shuffle of ``seed``."""
    return _walked(row, n, seed, False)


def unpermuted(place: Column, n: int, seed: int) -> Column:
    """Row number at a place: the inverse of ``permuted``."""
    return _walked(place, n, seed, True)


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET, in_range: int = RANGE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number`` for each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    kinds = materialize(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_n")))
    n_kinds, n, most = kinds.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    kinds = running_sum(kinds, "_n", [], ["doc_id", "text_crc32", "size"], n_kinds, "_first", bucket, in_range)
    rows = copies(kinds, "_n", "_copy", most).withColumn("row_number", F.col("_first") + F.col("_copy"))
    rows = rows.withColumn("_place", permuted(F.col("row_number"), max(n, 1), seed))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        _div(F.col("_place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
