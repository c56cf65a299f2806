"""Hard negatives against plain searches; blocks, anchor groups and samples are small, so that all borders are crossed."""

import numpy as np
import pytest

from quizmill.llm.hard_negatives import SortedLists, hard_negatives, products

SCHEMA = "vec_id long, label int, embedding array<double>, row int, windows string"


def plain(rows, positives=5, negatives=3, low=50, high=95, scale=256, anchor=lambda i: i % 50 == 0):
    """``rows``: id, label, vector."""
    used = [(i, lab, [int(np.floor(scale * x)) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(used):
        if not anchor(i):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=True)), j, other == lab) for b, (j, other, w) in enumerate(used) if b != a and len(w) == len(v)))
        for s, j, _ in [r for r in scored if r[2]][:positives]:
            window = [(-n, k) for n, k, same in scored if not same and low * -s <= -100 * n <= high * -s]
            out += [(i, j, rank + 1, k, -s, n) for rank, (n, k) in enumerate(window[:negatives])]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(i, lab, v, 1, "w") for i, lab, v in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in hard_negatives(df, **how).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(seed, n, dim, zeros=0.0, grid=None):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, dim)) * np.linspace(0.5, 2, n)[draw.permutation(n)][:, None]
    x = np.where(draw.random((n, dim)) < zeros, 0.0, x)
    return np.round(x * grid) / grid if grid else x


@pytest.mark.parametrize(("dim", "zeros", "grid", "labels"), [(16, 0.0, None, 10), (6, 0.5, 2, 3), (3, 0.0, 1, 2), (16, 0.7, None, 200)])
def test_all_windows(spark, dim, zeros, grid, labels):
    """Coarse grids make many ties, within blocks and across them; many labels leave some alone."""
    x = vectors(dim, 500, dim, zeros, grid)
    label = np.random.default_rng(1).integers(0, labels, 500)
    label[::3] = 0  # a third of all rows
    rows = [(int(i), int(label[i]), x[i].tolist()) for i in range(500)]
    for how in ({"block": 40, "group": 3, "sample": 30}, {"block": 10_000, "sample": 1}):
        assert mined(spark, rows, anchors="vec_id % 10 = 0", **how) == plain(rows, anchor=lambda i: i % 10 == 0)


def test_odd_rows(spark):
    """Nulls, non-finite parts, other dimensions, zeros, repeated ids and rows, labels that occur once."""
    x = vectors(3, 120, 4, grid=4)
    rows = [(i, i % 3, x[i].tolist()) for i in range(120)]
    rows += [(0, 1, x[0].tolist()), (0, 1, x[0].tolist()), (50, 2, [0.0] * 4), (51, 2, [0.0] * 4), (None, 1, x[1].tolist()), (200, None, x[2].tolist()), (250, 1, None), (300, 1, [1.0, float("nan"), 0.0, 0.0]), (350, 1, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(400, 9, x[3].tolist()), (450, 1, [1.0, 2.0]), (451, 1, [1.0, 1.0]), (452, 2, [1.0, 0.7]), (500, 1, [])]
    got, want = mined(spark, rows, block=30, sample=10), plain(rows)
    assert got == want and {r[0] for r in got} >= {0, 450}
    assert mined(spark, rows[:0]) == []
    assert mined(spark, [(0, None, [1.0])]) == []


def test_large_parts(spark):
    """Products beyond 53 bits are exact; beyond 63 bits is an error."""
    big = 2.0**22
    rows = [(0, 0, [big, 1.0]), (1, 0, [big, 3.0]), (2, 1, [big * 0.9, 0.3]), (3, 1, [big * 0.9, 0.7]), (4, 1, [big * 0.6, 1.0]), (5, 1, [1.0, 1.0])]
    assert mined(spark, rows) == plain(rows)
    one = [(0, 0, [1.0, 1.0]), (1, 0, [1.0, 0.9]), (2, 1, [0.9, 0.7]), (3, 1, [1e10, 0.0])]
    assert mined(spark, one) == plain(one) != []
    with pytest.raises(Exception, match="63 bits"):
        mined(spark, [*rows, (6, 1, [1e20, 0.0])])
    q = np.array([[2.0**40, 3.0], [1.0, 2.0]])
    x = np.array([[2.0**20 + 1, 5.0], [7.0, 2.0**45]])
    assert products(q, x).tolist() == [[2**60 + 2**40 + 15, 7 * 2**40 + 3 * 2**45], [2**20 + 11, 7 + 2**46]]


def test_lists_stop_early():
    """On vectors whose length lies in few parts, most of the lists isn't read and most candidates aren't scored."""
    draw = np.random.default_rng(4)
    x = np.floor(256 * draw.standard_normal((4000, 24)) * 0.5 ** np.arange(24))
    rows = np.arange(4000)
    block = SortedLists(rows, rows, rows % 10, x)
    q, n = x[:40], 40
    wide = np.full(n, np.iinfo(np.int64).min), np.full(n, 2**62)
    window, at, score = block.search(rows[:n], rows[:n] % 10, q, np.arange(n), *wide, 3, same=False)
    s = (x @ q.T).T
    for i in range(n):
        other = rows[rows % 10 != i % 10]
        best = other[np.lexsort((other, -s[i, other]))][:3]
        assert at[window == i].tolist() == best.tolist() and score[window == i].tolist() == s[i, best].tolist()
    assert block.read < 0.5 * n * x.size and block.scored < 0.5 * n * len(x)


def test_ties_with_the_last_one():
    """The threshold must fall strictly below the k-th score: equal scores further down have smaller ids."""
    x = np.full((300, 2), 5.0)
    ids = np.arange(300)[::-1].copy()
    block = SortedLists(np.arange(300), ids, np.ones(300, int), x)
    low, high = np.array([1]), np.array([2**62])
    _, at, _ = block.search(np.array([-1]), np.array([0]), np.array([[1.0, 1.0]]), np.array([0]), low, high, 3, same=False)
    assert ids[at].tolist() == [0, 1, 2]
