"""Approximate nearest neighbours by collision counting.

Inner products become distances on a sphere: vectors are divided by the greatest norm and get one
more component that fills them up to length 1; queries are normalised. Each shard of vectors is indexed
by ``PROJECTIONS`` directions, the axes of random rotations: per direction one array of the vectors
sorted by their projection, cut into ``STEPS`` steps of equal size. A query opens a window around its
own projection in each array, and a vector that lies in at least a threshold of the windows is verified:
its exact inner product must lie inside the radius. Axes of one rotation share out a distance between
them, so the number of collisions tells near from far better than independent directions would.

Windows are as wide as a radius calls for (virtual rehashing: the arrays stay, only windows grow, by
whole steps). A query's first radius is its distance to a neighbour in a bounded sample of vectors, taken
so far that about ``MARGIN * k`` of all vectors should lie inside; a vector at just that distance falls
into a window with probability ``HIT``, and the threshold lies ``DEVIATIONS`` binomial standard
deviations under the mean. Queries that have found fewer than k vectors go on with wider windows, at last
with whole arrays, so each gets k neighbours if there are as many.

Collisions are counted for all vectors of a shard together: a step's end is a bitmap of the vectors
before it, a window is the difference of two bitmaps, and bitmaps are added bit by bit.

Vectors that are null, zero or hold null or non-finite components, and rows without an id, take no
part. Rows that share an id are vectors of their own: a query's candidates are all rows but its own. Only
vectors of the query's dimension are its candidates. Vectors whose squares overflow raise an error.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .vector_blocks import QUERIES, SAMPLE, SHARD, ranked, sample_of, top_pairs, usable, visit, with_bounds

PROJECTIONS, STEPS, MARGIN, HIT, DEVIATIONS = 64, 128, 2.0, 0.86, 0.3
_WIDER = (1.0, 1.08, 1.2, np.inf)


def nearest(table: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 1, shard: int = SHARD, group: int = QUERIES, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``table`` where ``queries`` holds, the ``k``
    nearest other rows found, by inner product in double precision."""
    # lengths by way of the largest component, whose square may be 0 or infinite
    most = F.array_max(F.transform("vector", F.abs))
    length = F.least(F.col("most") * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("most")) * (x / F.col("most")))), F.lit(float(np.finfo(float).max)))
    vectors = materialize(usable(table, queries, id_col, vector_col).withColumn("most", most).where("most > 0").withColumn("norm", length).drop("most"))
    n, longest = vectors.agg(F.count("*"), F.max("norm")).first()
    longest = longest or 1.0
    asked = materialize(with_bounds(vectors.where("asked"), _radii(n, longest, k), sample_of(vectors.select("row", "id", "vector"), sample)))
    same = vectors.groupBy(F.size("vector").alias("dim")).agg((F.count("*") - 1).alias("others"))
    results = None
    for wider in _WIDER:
        n_asked = asked.count()
        if not n_asked and results is not None:
            break
        found = visit(vectors, asked, n, n_asked, _index(longest, k, wider, seed), "double", shard, group)
        found = materialize(ranked(found, k))
        if np.isfinite(wider):
            have = asked.select("row", F.size("vector").alias("dim")).join(F.broadcast(same), "dim").join(found.groupBy(F.col("query").alias("row")).count(), "row")
            full = materialize(have.where(F.col("count") >= F.least(F.lit(k), "others")).select(F.col("row").alias("query")))
            asked = materialize(asked.join(full, asked["row"] == full["query"], "left_anti"))
            found = found.join(full, "query", "left_semi")
        results = found if results is None else results.unionByName(found)
    return results.drop("query")


def _index(longest: float, k: int, wider: float, seed: int):
    return lambda rows, ids, x: CollisionIndex(rows, ids, x, longest, k, wider, seed)


def directions(dim: int, seed: int) -> np.ndarray:
    """``PROJECTIONS`` directions as columns: axes of random rotations, as long as ``dim`` normal
    deviates on average."""
    draw, axes = np.random.default_rng([seed, dim]), []
    while sum(a.shape[1] for a in axes) < PROJECTIONS:
        axes.append(np.linalg.qr(draw.standard_normal((dim, dim)))[0] * np.sqrt(dim))
    return np.concatenate(axes, axis=1)[:, :PROJECTIONS]


def lengths(x: np.ndarray) -> np.ndarray:
    """Of the rows; their squares may pass what a double holds, either way."""
    most = np.abs(x).max(axis=1)
    return np.minimum(most * np.linalg.norm(x / most[:, None], axis=1), np.finfo(float).max)


class CollisionIndex:
    """The sorted arrays of a shard, and the search in them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, longest: float, k: int, wider: float = 1.0, seed: int = 1) -> None:
        self.rows, self.ids, self.x, self.longest, self.k, self.wider = rows, ids, x, longest, k, wider
        scaled = x / longest
        fill = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        self.axes = directions(x.shape[1] + 1, seed)
        projected = scaled @ self.axes[:-1] + fill[:, None] * self.axes[-1]
        n = len(x)
        ends = np.arange(STEPS + 1) * n // STEPS
        words = -(-n // 64)
        #: Per direction: last value before each end, first value from each end on, vectors before each end.
        self.last, self.first = np.empty((PROJECTIONS, STEPS)), np.empty((PROJECTIONS, STEPS))
        self.before = np.zeros((PROJECTIONS, STEPS + 1, words), np.uint64)
        for j in range(PROJECTIONS):
            order = np.argsort(projected[:, j], kind="stable")
            line = projected[order, j]
            self.last[j] = np.where(ends[1:] > 0, line[np.maximum(ends[1:], 1) - 1], -np.inf)
            self.first[j] = np.where(ends[:-1] < n, line[np.minimum(ends[:-1], n - 1)], np.inf)
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            bits = np.zeros((STEPS + 1, words * 64), bool)
            bits[:, :n] = rank[None, :] < ends[:, None]
            self.before[j] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def collided(self, q: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the queries and vectors that collide often enough."""
        own = (q / lengths(q)[:, None]) @ self.axes[:-1]
        width = NormalDist().inv_cdf((1 + HIT) / 2) * radius

        def windows():
            for j in range(PROJECTIONS):
                lo = np.searchsorted(self.last[j], own[:, j] - width, "left")
                hi = np.searchsorted(self.first[j], own[:, j] + width, "right")
                yield self.before[j, hi] & ~self.before[j, lo]

        enough = int(PROJECTIONS * HIT - DEVIATIONS * np.sqrt(PROJECTIONS * HIT * (1 - HIT)))
        often = at_least(sums(windows()), enough)
        return np.nonzero(np.unpackbits(often.view(np.uint8), axis=1, bitorder="little")[:, : len(self.x)])

    def find(self, rows: np.ndarray, q: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        radius = np.where(radius > 0, self.wider * radius, np.inf if self.wider == np.inf else 0.0)
        i, j = self.collided(q, radius)
        other = rows[i] != self.rows[j]
        i, j = i[other], j[other]
        score = inner_products(q, self.x, i, j)
        near = score / lengths(q)[i] >= ((1 - radius * radius / 2 - 1e-9) * self.longest)[i]
        i, j, score = i[near], j[near], score[near]
        best = top_pairs(i, self.ids[j], score, self.k)
        return i[best], self.ids[j[best]], score[best]


def sums(bitmaps) -> list[np.ndarray]:
    """How many of the bitmaps have each bit set: the binary digits of the sums, lowest first."""
    digits: list[list[np.ndarray]] = [[]]

    def put(at: int, x: np.ndarray) -> None:
        if at == len(digits):
            digits.append([])
        digits[at].append(x)
        if len(digits[at]) == 3:
            a, b, c = digits[at]
            ab = a ^ b
            digits[at] = [ab ^ c]
            put(at + 1, (a & b) | (ab & c))

    for x in bitmaps:
        put(0, x)
    at = 0
    while at < len(digits):
        if len(digits[at]) == 2:
            a, b = digits[at]
            digits[at] = [a ^ b]
            put(at + 1, a & b)
        at += 1
    return [d[0] for d in digits]


def at_least(digits: list[np.ndarray], least: int) -> np.ndarray:
    """Bitmap of the places whose sum is ``least`` or more."""
    if least >> len(digits):
        return np.zeros_like(digits[0])
    more, equal = np.zeros_like(digits[0]), np.full_like(digits[0], 2**64 - 1)
    for at in reversed(range(len(digits))):
        if least >> at & 1:
            equal = equal & digits[at]
        else:
            more |= equal & digits[at]
            equal = equal & ~digits[at]
    return more | equal


def inner_products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of pairs of rows; components are added in their order, so equal vectors have equal products."""
    total = np.zeros(len(i))
    for a, b in zip(np.ascontiguousarray(q.T), np.ascontiguousarray(x.T), strict=True):
        total += a[i] * b[j]
    return total


def _radii(n: int, longest: float, k: int):
    """Distance within which about ``MARGIN * k`` of ``n`` vectors should lie, by the sample."""

    def bound(q: np.ndarray, sample: np.ndarray, own: np.ndarray) -> np.ndarray:
        place = int(np.ceil(MARGIN * k * len(sample) / max(n, 1))) - 1
        if place >= len(sample) - 1:
            return np.full(len(q), np.inf)
        cosine = (q / lengths(q)[:, None]) @ (sample / longest).T
        cosine[own] = -2.0
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * -np.partition(-cosine, place, axis=1)[:, place]))

    return bound
