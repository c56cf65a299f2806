"""Searches whose shards, blocks, query groups and samples are small, so that all borders are crossed."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from quizmill.llm.ann_search import CollisionIndex, at_least, nearest, sums
from quizmill.llm.maxscore import Postings, best_scores

SCHEMA = "vec_id long, embedding array<double>"


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((r.vec_id, r.score))
    return out


def vectors(seed, n, dim, zeros=0.0):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, dim)) * np.linspace(0.5, 2, n)[draw.permutation(n)][:, None]
    return np.where(draw.random((n, dim)) < zeros, 0.0, x)


@pytest.mark.parametrize("zeros", [0.0, 0.8])
def test_maxscore_over_shards_and_blocks(spark, zeros):
    x = vectors(5, 600, 24, zeros)
    found = answers(best_scores(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA).repartition(5), k=7, shard=90, group=11, block=16, sample=60))
    whole = np.floor(64 * x)
    assert set(found) == set(range(0, 600, 20))
    for q, got in found.items():
        s = whole @ whole[q]
        best = [int(i) for i in np.lexsort((np.arange(600), -s)) if i != q][:7]
        assert got == [(i, int(s[i])) for i in best]


def test_maxscore_skips_pairs():
    """Far pairs leave before their scores are complete, and no pair at the threshold is lost."""
    x = np.floor(64 * vectors(6, 900, 32))
    q = x[:40]
    scores = q @ x.T
    least = np.sort(scores, axis=1)[:, -10]
    i, j, s = Postings(x).competitive(q, least)
    assert {(a, b, c) for a, b, c in zip(i.tolist(), j.tolist(), s.tolist(), strict=True)} == {(a, b, int(scores[a, b])) for a, b in zip(*np.nonzero(scores >= least[:, None]), strict=True)}


def test_large_components(spark):
    large = [(0, [2.0**20, 1.0]), (1, [2.0**20, 1.0 - 2.0**-7]), (2, [-(2.0**20), 1.0]), (3, [2.0**20, 1.0])]
    got = answers(best_scores(spark.createDataFrame(large, SCHEMA)))
    # products beyond 53 bits are exact
    assert got[0] == [(3, 2**52 + 64 * 64), (1, 2**52 + 64 * 63), (2, -(2**52) + 64 * 64)]
    with pytest.raises(ValueError, match="vector 7 "):
        best_scores(spark.createDataFrame([*large, (7, [1e300, 1.0])], SCHEMA)).collect()


def test_rows_that_share_an_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (25, [0.1, 0.0]), (25, [0.9, 0.0]), (25, [-1.0, 0.0]), (26, [0.5, 0.0])]
    for search in (nearest, best_scores):
        assert [i for i, _ in answers(search(spark.createDataFrame(rows, SCHEMA)))[0]] == [25, 26, 25, 25]


def test_collisions_over_shards(spark):
    x = vectors(7, 1500, 48)
    found = answers(nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA).repartition(5), k=10, shard=200, group=30, sample=300))
    hits = 0
    assert set(found) == set(range(0, 1500, 20))
    for q, got in found.items():
        s = x @ x[q]
        best = [int(i) for i in np.lexsort((np.arange(1500), -s)) if i != q][:10]
        assert len(got) == 10 and all(abs(s[i] - v) < 1e-9 for i, v in got)
        assert [i for i, _ in got] == sorted((i for i, _ in got), key=lambda i: (-s[i], i))
        hits += len(set(best) & {i for i, _ in got})
    assert hits >= 0.9 * 10 * len(found)


def test_collision_counts():
    """Bitmaps are added and compared as numbers, and few pairs are verified."""
    bits = np.random.default_rng(8).random((19, 3, 128)) < 0.4
    digits = sums(np.packbits(b, axis=1, bitorder="little").view(np.uint64) for b in bits)
    total = bits.sum(axis=0)
    for least in (0, 1, 5, 8, 19, 20, 64):
        assert (np.unpackbits(at_least(digits, least).view(np.uint8), axis=1, bitorder="little").astype(bool) == (total >= least)).all()
    x = vectors(9, 4000, 64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = CollisionIndex(np.arange(4000), np.arange(4000), x, 1.0, 5)
    s = x[:50] @ x.T
    s[np.arange(50), np.arange(50)] = -1
    near = np.sort(s, axis=1)[:, -5]
    i, j = index.collided(x[:50], np.sqrt(2 - 2 * near))
    verified = Counter(zip(i.tolist(), j.tolist(), strict=True))
    wanted = list(zip(*np.nonzero(s >= near[:, None]), strict=True))
    assert len(verified) < 0.15 * s.size and sum((a, b) in verified for a, b in wanted) >= 0.6 * len(wanted)


def test_tiny_and_huge_vectors_take_part(spark):
    """Vectors whose squares a double can't hold, either way, are queries and candidates like any other."""
    x = vectors(11, 80, 8)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(100, [1e-200] * 8), (101, [1e-170, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (120, [1e200, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (140, [0.0] * 8)]
    found = answers(nearest(spark.createDataFrame(rows, SCHEMA), k=5))
    assert set(found) == {0, 20, 40, 60, 100, 120}
    for q, got in found.items():
        own = np.array(dict(rows)[q])
        want = sorted(((-float(np.array(v) @ own), i) for i, v in rows if i not in (q, 140)))[:5]
        assert len(got) == 5 and got[0][0] == want[0][1]
        assert all(s == pytest.approx(float(np.array(dict(rows)[i]) @ own)) for i, s in got)


def test_one_large_vector_is_no_error(spark):
    x = vectors(12, 60, 4)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, [1e10, 0.0, 0.0, 0.0])]
    found = answers(best_scores(spark.createDataFrame(rows, SCHEMA), k=5))
    whole = {i: [int(np.floor(64 * c)) for c in v] for i, v in rows}
    for q, got in found.items():
        scores = {i: sum(a * b for a, b in zip(whole[q], v, strict=True)) for i, v in whole.items() if i != q}
        assert got == sorted(scores.items(), key=lambda r: (-r[1], r[0]))[:5]
