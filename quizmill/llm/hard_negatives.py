"""Hard negatives by Fagin's threshold algorithm: for each anchor and each of its nearest rows of the same
label, the best rows of other labels whose score lies in a window under that of the positive.

Components become ``floor(scale * x)``; a score is the integer inner product with the anchor. Candidates
lie in blocks, and a block holds, for each dimension, its candidates sorted by that component. Sorted access
goes down the lists, from the large end where the anchor's component is positive and from the small end
where it is negative, so that the anchor's products only fall; a candidate that is met in any list is scored
on its whole vector (random access). What no list has shown yet can't score more than the sum of the
products last read. An anchor stops once that sum falls strictly below the k-th score of each of its
windows: a candidate that ties with the k-th may have a smaller id. A window that isn't full has its lower
end in place of the k-th score. Where the lists have shown all candidates there is nothing left to stop for.

First the positives: blocks of one label each, of at most about ``block`` rows, so that an anchor meets
those of its own label only, however many rows the label has. Then the negatives: blocks of rows of any
label. Both start from the k-th score over a bounded sample, which real candidates reach; Spark merges
the blocks' best. A very long list of anchors is dealt out in groups, each with its own copy of a block.

Rows whose id, label or vector is null, or whose vector is empty or holds a null or non-finite component,
take no part; nor do positives whose window is empty (negative scores). Rows that share an id are rows of
their own: an anchor's candidates are all rows but itself, of its dimension; equal ids with equal scores
are both returned. Scores are exact; an error says so where one passes 63 bits. Labels are integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .tasks import tidy

#: Candidates of a block on average, anchors that share a copy of a block, anchors answered at once, rows of
#: the sample that tasks get, places of each list that are read first.
BLOCK, ANCHORS, AT_ONCE, SAMPLE, FIRST = 4096, 65_536, 256, 2048, 32
_LOW, _MOST = -(2**63), 2**63 - 1

_ANCHOR = "array<struct<id: long, score: long, low: long, high: long>>"


def hard_negatives(
    table: DataFrame,
    anchors: str = "vec_id % 50 = 0",
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    scale: int = 256,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
    group: int = ANCHORS,
    sample: int = SAMPLE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``label`` replaces
    the column ``label_col``, of which a null still leaves the row out."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    used = table.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(~bad)
    rows = materialize(
        used.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            (F.col(label_col) if label is None else label).cast("long").alias("label"),
            F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale).cast("double")).alias("vector"),
            F.coalesce(F.expr(anchors), F.lit(False)).alias("asked"),
            F.size(vector_col).alias("dim"),
        )
    )
    asked = rows.where("asked").drop("asked")
    n, n_asked = rows.count(), asked.count()
    drawn = F.xxhash64("row", "id", "vector")
    few = rows.where(F.pmod(drawn, F.lit(max(1, n // (2 * sample)))) == 0)  # so that tasks send few rows
    known = [(r.row, r.label, np.array(r.vector)) for r in few.orderBy(drawn, "row").limit(sample).collect()]

    # positives: an anchor meets the blocks of its label
    parts = rows.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    of_label = rows.drop("asked").join(parts, "label")
    tasks = max(1, -(-n // block))
    part = lambda k, salt: F.pmod(F.xxhash64("row", F.lit(salt)), k).cast("int")
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("score"), F.lit(_LOW).alias("low"), F.lit(_MOST).alias("high")))
    wanted = _with_floors(asked.withColumn("windows", any_score.cast(_ANCHOR)), known, positives, same=True)
    left = of_label.select(F.col("label").alias("cell"), part(F.col("parts"), 1).alias("part"), "dim", F.lit(0).alias("side"), "row", "id", "label", "vector", F.lit(None).cast(_ANCHOR).alias("windows"))
    right = wanted.join(parts, "label").select(F.col("label").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "dim", F.lit(1).alias("side"), "row", "id", "label", "vector", "windows")
    near = _meet(left.unionByName(right).repartition(tasks, "cell", "part"), positives, same=True)
    first = near.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "other"))).where(F.col("rank") <= positives)
    # lowest and highest score of a window in whole numbers, without products that may pass 63 bits
    share = lambda p: F.expr(f"score div 100 * {p}"), lambda p: F.expr(f"score % 100 * {p}")
    low = share[0](percent[0]) + F.ceil(share[1](percent[0]) / 100).cast("long")
    high = share[0](percent[1]) + F.floor(share[1](percent[1]) / 100).cast("long")
    windows = first.select("row", F.col("other").alias("id"), "score", low.alias("low"), high.alias("high")).where("low <= high")
    windows = windows.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("id", "score", "low", "high"))).cast(_ANCHOR).alias("windows"))

    # negatives: an anchor meets all blocks, with one window a positive
    wanted = materialize(_with_floors(asked.join(windows, "row"), known, negatives, same=False))
    groups = max(1, -(-n_asked // group))
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = rows.select(part(F.lit(tasks), 2).alias("cell"), each(groups).alias("part"), "dim", F.lit(0).alias("side"), "row", "id", "label", "vector", F.lit(None).cast(_ANCHOR).alias("windows"))
    right = wanted.withColumn("part", part(F.lit(groups), 3)).select(each(tasks).alias("cell"), "part", "dim", F.lit(1).alias("side"), "row", "id", "label", "vector", "windows")
    both = left.unionByName(right).withColumn("cell", F.col("cell").cast("long")).repartition(tasks * groups, "cell", "part")
    found = _meet(both, negatives, same=False)
    order = Window.partitionBy("row", "positive_id", "which").orderBy(F.desc("score"), "other")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def _with_floors(asked: DataFrame, known: list[tuple[int, int, np.ndarray]], k: int, same: bool) -> DataFrame:
    """Windows whose lower end is the k-th score in them over the sample, where the sample has as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, label, x, dims = _columns(batch)
            ids, score, low, high, owner = _windows(batch.column("windows"))
            low = low.copy()
            for dim in np.unique(dims):
                like = [r for r in known if len(r[2]) == dim]
                if not like:
                    continue
                rows, labels, vectors = np.array([r[0] for r in like]), np.array([r[1] for r in like]), np.stack([r[2] for r in like])
                for at in np.array_split(np.flatnonzero(dims == dim), -(-int((dims == dim).sum()) // AT_ONCE)):
                    s = products(np.stack([x[i] for i in at]), vectors)
                    usable = (rows != own[at][:, None]) & ((labels == label[at][:, None]) == same)
                    _fit(s, usable)
                    for w in np.flatnonzero(np.isin(owner, at)):
                        i = np.searchsorted(at, owner[w])
                        inside = s[i][usable[i] & (s[i] >= low[w]) & (s[i] <= high[w])]
                        if len(inside) >= k:
                            low[w] = np.partition(inside, len(inside) - k)[len(inside) - k]
            windows = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(c) for c in (ids, score, low, high)], names=["id", "score", "low", "high"]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "id", "label", "vector", "dim")] + [windows], names=["row", "id", "label", "vector", "dim", "windows"])

    return asked.select("row", "id", "label", "vector", "dim", "windows").mapInArrow(tidy(run), f"row long, id long, label long, vector array<double>, dim int, windows {_ANCHOR}")


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    dims = batch.column("vector").value_lengths().to_numpy()
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return batch.column("row").to_numpy(), batch.column("label").to_numpy(), np.split(flat, np.cumsum(dims)[:-1]) if len(dims) else [], dims


def _windows(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Positive's id and score, lowest and highest score of each window, and the row that it belongs to."""
    flat = column.flatten()
    return *(flat.field(k).to_numpy() for k in range(4)), np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())


def _meet(both: DataFrame, k: int, same: bool) -> DataFrame:
    """``row, id, which, positive_id, positive_score, other, score``: of each block and window the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, built = None, [], None
        for rows in _stretches(batches):
            key, side = tuple(rows.column(c)[0].as_py() for c in ("cell", "part", "dim")), rows.column("side")[0].as_py()
            if key != now:
                now, held, built = key, [], None
            own, ids, labels = (rows.column(c).to_numpy() for c in ("row", "id", "label"))
            x = rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
            if side == 0:
                held.append((own, ids, labels, x))
                continue
            if built is None:
                if not held:
                    continue
                built = SortedLists(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held = []
            for lo in range(0, len(own), AT_ONCE):
                cut = slice(lo, lo + AT_ONCE)
                pid, pscore, low, high, owner = _windows(rows.column("windows").slice(lo, AT_ONCE))
                window, at, score = built.search(own[cut], labels[cut], x[cut], owner, low, high, k, same)
                if len(at):
                    which = window - np.searchsorted(owner, owner[window])
                    out = (own[cut][owner[window]], ids[cut][owner[window]], which, pid[window], pscore[window], built.ids[at], score)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["row", "id", "which", "positive_id", "positive_score", "other", "score"])

    return both.sortWithinPartitions("cell", "part", "dim", "side", "row").mapInArrow(tidy(run), "row long, id long, which long, positive_id long, positive_score long, other long, score long")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where a block, a dimension or a side ends."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "part", "dim", "side")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield batch.slice(lo, hi - lo)


class SortedLists:
    """A block's candidates, sorted by each dimension, and the threshold algorithm over them.

    ``read`` counts sorted accesses, ``scored`` random ones."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        self.rows, self.ids, self.labels, self.x = rows, ids, labels, x
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.read = self.scored = 0

    def search(self, rows: np.ndarray, labels: np.ndarray, q: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, candidate and score of the best ``k`` of each window; ``owner`` is each window's anchor."""
        n, least = len(self.x), low.copy()
        seen = np.zeros((len(q), n), bool)
        window, at, score = (np.zeros(0, np.int64),) * 3
        active, depth, step = np.unique(owner), 0, FIRST
        while len(active) and depth < n:
            to = min(n, depth + step)
            before = seen[active]
            for d, order in enumerate(self.order):
                for go, part in ((q[active, d] > 0, order[n - to : n - depth]), (q[active, d] < 0, order[depth:to])):
                    if go.any():
                        seen[np.ix_(active[go], part)] = True
                        self.read += int(go.sum()) * len(part)
            new = seen[active] & ~before
            if depth == 0:  # no list orders candidates for an anchor of zeros: all score 0
                zeros = ~q[active].any(axis=1)
                new[zeros] = seen[active[zeros]] = True
            columns = np.flatnonzero(new.any(axis=0))
            if len(columns):
                self.scored += int(new.sum())
                s = products(q[active], self.x[columns])
                usable = new[:, columns] & ((self.labels[columns] == labels[active][:, None]) == same) & (self.rows[columns] != rows[active][:, None])
                _fit(s, usable)
                more = [(window, at, score)]
                of = np.full(len(q), -1)
                of[active] = np.arange(len(active))
                for w in np.flatnonzero(of[owner] >= 0):
                    i = of[owner[w]]
                    inside = np.flatnonzero(usable[i] & (s[i] >= least[w]) & (s[i] <= high[w]))
                    if len(inside) > 4 * k:  # fewer to sort, ties with the k-th kept
                        inside = inside[s[i, inside] >= np.partition(s[i, inside], len(inside) - k)[len(inside) - k]]
                    more.append((np.full(len(inside), w), columns[inside], s[i, inside]))
                window, at, score = (np.concatenate(c) for c in zip(*more, strict=True))
                order = np.lexsort((self.ids[at], -score, window))
                window, at, score = window[order], at[order], score[order]
                place = np.arange(len(window)) - np.searchsorted(window, window)
                least_of, kth = window[place == k - 1], score[place == k - 1]
                least[least_of] = np.maximum(least[least_of], kth)
                window, at, score = window[place < k], at[place < k], score[place < k]
            depth, step = to, to
            if depth < n:
                lists = np.arange(self.x.shape[1])
                top, bottom = self.x[self.order[:, n - depth], lists], self.x[self.order[:, depth - 1], lists]
                # a sum of doubles: it may be a little low where products pass 53 bits
                bound = np.maximum(q[active] * top, q[active] * bottom).sum(axis=1)
                bound += 1e-12 * np.abs(q[active]).max(axis=1) * np.abs(self.x).max() * self.x.shape[1]
                floor = np.full(len(q), np.inf)
                np.minimum.at(floor, owner, least.astype(float))
                active = active[(bound >= floor[active]) & ~seen[active].all(axis=1)]
        return window, at, score


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: by doubles where they pass no 53 bits, else by Python's
    integers; what passes 63 bits is cut to the most that they hold."""
    most = int(np.sqrt(2.0**53 / q.shape[1])) - 1
    small_q, small_x = (np.abs(m).max(axis=1, initial=0) <= most for m in (q, x))
    out = np.empty((len(q), len(x)), np.int64)
    out[np.ix_(small_q, small_x)] = (q[small_q] @ x[small_x].T).astype(np.int64)
    for rows, columns in ((~small_q, np.ones(len(x), bool)), (small_q, ~small_x)):
        if rows.any() and columns.any():
            whole = _whole(q[rows]) @ _whole(x[columns]).T
            out[np.ix_(rows, columns)] = np.clip(whole, -_MOST, _MOST).astype(np.int64)
    return out


def _fit(scores: np.ndarray, wanted: np.ndarray) -> None:
    if (wanted & (np.abs(scores) == _MOST)).any():
        raise ValueError("vectors are so large that a score passes 63 bits")


def _whole(m: np.ndarray) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(m)
