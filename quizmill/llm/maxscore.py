"""Exact top-k search with MaxScore over integer vectors.

Components become ``floor(64 * x)``. A dimension is a term; its postings in a block of vectors are the
vectors with a component other than 0, with the components as impacts and the list's greatest and least
impact. A query's terms are sorted by weight. What the terms from some place on can add to a score is
bounded by the sum of their weights times the lists' extreme impacts, and by the length of that part of
the query times the greatest length of a vector. The last terms whose bound stays under the query's
threshold are non-essential: a vector in none of the other lists can't get in. Only the lists of the
essential terms are traversed; the vectors that are then still competitive (score so far, and the bound
with the rest of the vector's own length) are probed for the other terms, a few at a time, and leave
as soon as they can't reach the threshold. Scores of the survivors are computed in integers.

A query's threshold begins with its k-th score over a bounded sample of vectors, so it is reached by k
vectors and safe in every shard; it rises to the k-th score seen from block to block of a shard. Shards'
best k are merged by Spark. Ties go to the smaller id; a vector that equals the threshold is kept.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part.
Rows that share an id are vectors of their own: a query's candidates are all rows but its own. Only
vectors of the query's dimension are its candidates. Where the product of the two vectors with the largest
components could pass 63 bits, an error names the first; one large vector among small ones is no error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .vector_blocks import QUERIES, SAMPLE, SHARD, ranked, sample_of, top_pairs, usable, visit, with_bounds

#: Vectors of a block of a shard, and non-essential terms that are probed at once.
BLOCK, PROBED = 1024, 8


def best_scores(table: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, group: int = QUERIES, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds, the ``k`` other rows with
    the greatest integer inner products."""
    whole = F.transform("vector", lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    vectors = materialize(usable(table, queries, id_col, vector_col).withColumn("vector", whole))
    n = vectors.count()
    large = vectors.select(F.array_max(F.transform("vector", F.abs)).alias("most"), "id", F.size("vector").alias("dim")).orderBy(F.desc("most"), F.desc("id")).limit(2).collect()
    if len(large) == 2 and max(r.dim for r in large) * large[0].most * large[1].most >= 2.0**63:
        raise ValueError(f"components of vector {large[0].id} are so large that its products may pass 63 bits")
    asked = materialize(with_bounds(vectors.where("asked"), _thresholds(k), sample_of(vectors.select("row", "id", "vector"), sample)))
    found = visit(vectors, asked, n, asked.count(), lambda rows, ids, x: PostingIndex(rows, ids, x, k, block), "long", shard, group)
    return ranked(found, k).drop("query")


class PostingIndex:
    """The posting lists of a shard, block by block, and the search in them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, block: int = BLOCK) -> None:
        self.rows, self.ids, self.k = rows, ids, k
        self.blocks = [(lo, Postings(x[lo : lo + block])) for lo in range(0, len(x), block)]

    def find(self, rows: np.ndarray, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        least = least.copy()
        place, at, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo, block in self.blocks:
            i, j, s = block.competitive(q, least)
            other = rows[i] != self.rows[lo + j]
            place, at, score = (np.concatenate(x) for x in ((place, i[other]), (at, lo + j[other]), (score, s[other])))
            best = top_pairs(place, self.ids[at], score, self.k)
            place, at, score = place[best], at[best], score[best]
            full = np.flatnonzero(np.bincount(place, minlength=len(q)) == self.k)
            last = np.searchsorted(place, full, "right") - 1
            least[full] = np.maximum(least[full], score[last])
        return place, self.ids[at], score


class Postings:
    """The lists of a block: per dimension the vectors that have it, their impacts, and extremes."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.lists = []
        for column in np.ascontiguousarray(x.T):
            has = np.flatnonzero(column)
            # a list that most vectors are in is kept as a column, with impact 0 for the others
            self.lists.append((slice(None), column) if 2 * len(has) > len(column) else (has, column[has]))
        self.most, self.least = np.maximum(x.max(axis=0), 0), np.minimum(x.min(axis=0), 0)
        self.square = (x * x).sum(axis=1)

    def competitive(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a query and a vector whose product is at least the query's threshold, and the products."""
        dims = q.shape[1]
        order = np.argsort(-np.abs(q), axis=1, kind="stable")
        place = np.argsort(order, axis=1, kind="stable")
        sorted_q = np.take_along_axis(q, order, axis=1)
        tail = lambda x: np.concatenate((np.cumsum(x[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))), axis=1)
        by_lists = tail(np.take_along_axis(np.maximum(q * self.most, q * self.least), order, axis=1))
        length = np.sqrt(tail(sorted_q * sorted_q))  # of the query from each term on
        # sums of doubles may be off in the last digits where products pass 53 bits
        spare = 1e-12 * length[:, 0] * np.sqrt(self.square.max()) + 1e-6
        floor = least - spare
        essential = (np.minimum(by_lists, length * np.sqrt(self.square.max())) >= floor[:, None]).sum(axis=1)
        essential = np.minimum(essential, dims)
        score = np.zeros((len(q), len(self.x)))
        for d, (vectors, impacts) in enumerate(self.lists):
            asking = np.flatnonzero(place[:, d] < essential)
            if not len(asking) or not len(impacts):
                continue
            if isinstance(vectors, slice):
                score[asking] += q[asking, d][:, None] * impacts
            else:
                score[np.ix_(asking, vectors)] += q[asking, d][:, None] * impacts
        # the part of each vector's squared length that the essential terms have used up
        seen = (place < essential[:, None]).astype(float) @ (self.x * self.x).T
        rest = np.sqrt(np.maximum(self.square - seen, 0.0)) * np.take_along_axis(length, essential[:, None], axis=1)
        rest = np.minimum(rest, np.take_along_axis(by_lists, essential[:, None], axis=1))
        i, j = np.nonzero(score + rest >= floor[:, None])
        score, seen = score[i, j], seen[i, j]
        for step in range(0, dims, PROBED):
            at = essential[i] + step
            if not len(i) or at.min() >= dims:
                break
            terms = np.minimum(at[:, None] + np.arange(PROBED), dims - 1)
            d = order[i[:, None], terms]
            impact = np.where(at[:, None] + np.arange(PROBED) < dims, self.x[j[:, None], d], 0.0)
            score, seen = score + (q[i[:, None], d] * impact).sum(axis=1), seen + (impact * impact).sum(axis=1)
            after = np.minimum(at + PROBED, dims)
            rest = np.minimum(np.sqrt(np.maximum(self.square[j] - seen, 0.0)) * length[i, after], by_lists[i, after])
            keep = score + rest >= floor[i]
            i, j, score, seen = i[keep], j[keep], score[keep], seen[keep]
        exact = np.zeros(len(i), np.int64)
        for a, b in zip(np.ascontiguousarray(q.T).astype(np.int64), np.ascontiguousarray(self.x.T).astype(np.int64), strict=True):
            exact += a[i] * b[j]
        keep = exact >= least[i]
        return i[keep], j[keep], exact[keep]


def _thresholds(k: int):
    """Each query's k-th score over the sample's other vectors; minus infinity if they are fewer. It is a
    sum of doubles, so it is taken a little lower."""

    def bound(q: np.ndarray, sample: np.ndarray, own: np.ndarray) -> np.ndarray:
        if len(sample) <= k:
            return np.full(len(q), -np.inf)
        score = q @ sample.T
        score[own] = -np.inf
        best = -np.partition(-score, k - 1, axis=1)[:, k - 1]
        return best - 1e-12 * np.abs(q).max(axis=1) * np.abs(sample).max() * q.shape[1] - 1e-6

    return bound
