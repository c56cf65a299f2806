"""Queries against all vectors: vectors lie in shards, each query visits each shard once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .numbering import dealt
from .tasks import tidy

#: Vectors of a shard and queries that share a copy of it, on average; queries answered at once; vectors
#: of the sample that tasks get.
SHARD, QUERIES, AT_ONCE, SAMPLE = 4096, 65_536, 256, 4096


def usable(table: DataFrame, queries: str, id_col: str, vector_col: str) -> DataFrame:
    """``row, id, vector, asked`` of the rows with an id and a vector of finite components: each row has
    a number of its own (rows may share an id); ``asked`` marks the queries."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(~bad)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(F.expr(queries), F.lit(False)).alias("asked"))


def sample_of(vectors: DataFrame, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """At most ``size`` rows, chosen by a hash of the number and the vector."""
    rows = vectors.orderBy(F.xxhash64("id", "vector"), "row").limit(size).collect()
    return np.array([r.row for r in rows], np.int64), [np.array(r.vector, np.float64) for r in rows]


def with_bounds(queries: DataFrame, bound: Callable, sample: tuple[np.ndarray, list[np.ndarray]]) -> DataFrame:
    """``row, id, vector, bound``: a number for each query from the sample's vectors of its dimension, by
    ``bound(queries, sample vectors, is the query itself)``."""
    known, rows = sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, dims = batch.column(0).to_numpy(), batch.column(2).value_lengths().to_numpy()
            out = np.zeros(len(own))
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            start = np.cumsum(dims) - dims
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                like = [k for k, r in enumerate(rows) if len(r) == dim]
                for part in np.array_split(at, -(-len(at) // 512)):
                    q = flat[start[part][:, None] + np.arange(dim)]
                    out[part] = bound(q, np.stack([rows[k] for k in like]) if like else np.zeros((0, dim)), own[part][:, None] == known[like][None, :])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["row", "id", "vector", "bound"])

    return queries.select("row", "id", "vector").mapInArrow(tidy(run), "row long, id long, vector array<double>, bound double")


def visit(vectors: DataFrame, queries: DataFrame, n: int, n_queries: int, index: Callable, score_type: str, shard: int = SHARD, group: int = QUERIES) -> DataFrame:
    """``query, query_id, vec_id, score``: what each query finds in each shard of vectors of its dimension.

    ``index(rows, ids, vectors)`` builds a shard's index once; it then answers the queries that come,
    some at a time, by ``index.find(query rows, query vectors, bounds)``: arrays of query place, vector
    id and score. A very long list of queries is dealt out in groups, each with its own copy of a shard.
    """
    shards, groups = max(1, -(-n // shard)), max(1, -(-n_queries // group))
    part = lambda k, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(k)).cast("int")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    columns = ["shard", "group", F.size("vector").alias("dim"), "side", "row", "id", "vector", "bound"]
    left = vectors.withColumn("shard", part(shards, 1)).withColumn("group", each(groups)).withColumn("side", F.lit(0)).withColumn("bound", F.lit(0.0)).select(*columns)
    right = queries.withColumn("group", part(groups, 2)).withColumn("shard", each(shards)).withColumn("side", F.lit(1)).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, built = None, [], None
        for rows in _stretches(batches):
            key, side = tuple(rows.column(c)[0].as_py() for c in ("shard", "group", "dim")), rows.column("side")[0].as_py()
            if key != now:
                now, held, built = key, [], None
            own, ids, bound = (rows.column(c).to_numpy() for c in ("row", "id", "bound"))
            x = rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
            if side == 0:
                held.append((own, ids, x))
                continue
            if built is None:
                if not held:
                    continue
                built = index(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held = []
            for lo in range(0, len(own), AT_ONCE):
                cut = slice(lo, lo + AT_ONCE)
                place, vec, score = built.find(own[cut], x[cut], bound[cut])
                if len(place):
                    yield pa.RecordBatch.from_arrays([pa.array(own[cut][place]), pa.array(ids[cut][place]), pa.array(vec), pa.array(score)], names=["query", "query_id", "vec_id", "score"])

    both = dealt(left.unionByName(right), F.col("shard").cast("long") * groups + F.col("group"), shards * groups)
    return both.sortWithinPartitions("shard", "group", "dim", "side", "row").mapInArrow(tidy(run), f"query long, query_id long, vec_id long, score {score_type}")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where shard, group, dimension or side change."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "group", "dim", "side")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield batch.slice(lo, hi - lo)


def top_pairs(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's best ``k`` pairs: greatest score, then smallest vector id."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    first = np.maximum.accumulate(np.where(np.concatenate(([True], q[1:] != q[:-1])), np.arange(len(q)), 0)) if len(q) else order
    return order[np.arange(len(q)) - first < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` over all shards: ``query, query_id, rank, vec_id, score``."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "query_id", "rank", "vec_id", "score")
