"""The n-gram join with small blocks, so that trees have several levels and groups several blocks."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quizmill.llm import ngram_join
from quizmill.llm.ngram_join import GROUPS, CountTree, _packed, _unpacked, near_copies
from quizmill.llm.packing_rows import whole_groups


def shingles(text, k):
    w = text.split()
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def components(docs, k, percent):
    sets = {d: shingles(t, k) for d, t in docs}
    head = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        now = dict(head)
        for a, b in links:
            head[a] = head[b] = min(head[a], head[b])
        if now == head:
            return {d: (len(s), head[d]) for d, s in sets.items()}, links


def chains(seed, families, members, words, edits):
    """Families in which each document is the one before with some words changed: near ones link, far ones don't."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    docs = []
    for _ in range(families):
        text = [word() for _ in range(words)]
        for _ in range(members):
            docs.append(" ".join(text))
            for _ in range(edits):
                text[draw.randrange(words)] = word()
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block,wide_block", [(512, 2048), (5, 7), (20, 40)])
def test_chains(spark, block, wide_block):
    docs = chains(block, 3, 60, 60, 1) + [(1000 + i, t) for i, t in chains(9, 30, 2, 12, 1)]
    want, links = components(docs, 3, 80)
    got = near_copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), 3, 80, block=block, wide_block=wide_block)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) < len(docs) - 100 and len(links) > 300


def test_trees_find_what_first_pairs_miss(spark, monkeypatch):
    """With a tree for every few documents the first pairs leave groups open: wider trees close them."""
    docs = chains(4, 2, 80, 50, 1)
    want, _ = components(docs, 3, 80)
    seen = []
    kept = ngram_join._open_pairs
    monkeypatch.setattr(ngram_join, "_open_pairs", lambda *a: seen.append(kept(*a)) or seen[-1])
    got = near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 3, 80, block=3, wide_block=8).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: c for d, (_, c) in want.items()}
    assert seen[0].count() > 0


def test_documents_of_one_template_give_few_pairs(spark, monkeypatch):
    """Each has words of its own that keep it from linking: candidates don't grow with the square of their number."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    template, docs = [word() for _ in range(400)], []
    for i in range(120):
        text = list(template)
        for at in draw.sample(range(400), 3 if i < 20 else 8):
            text[at] = word()
        docs.append((i, " ".join(text)))
    want, links = components(docs, 5, 80)
    seen = []
    for name in ("_first_pairs", "_open_pairs"):
        kept = getattr(ngram_join, name)
        monkeypatch.setattr(ngram_join, name, lambda *a, kept=kept: seen.append(kept(*a)) or seen[-1])
    got = near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and 100 < len(links) < 1000
    assert sum(pairs.count() for pairs in seen) < 3 * len(docs)


@pytest.mark.parametrize("percent", [80, 90])
def test_tree_of_several_levels(percent):
    draw = np.random.default_rng(percent)
    centres = draw.poisson(3, (40, GROUPS))
    points = np.maximum(centres[draw.integers(0, 40, 900)] + draw.integers(-1, 2, (900, GROUPS)) * (draw.random((900, GROUPS)) < 0.1), 0).astype(np.int64)
    size = points.sum(axis=1)
    tree = CountTree(points, size)
    i, j = tree.pairs(percent)
    need = {(a, b) for a in range(900) for b in range(900) if (100 + percent) * np.minimum(points[a], points[b]).sum() >= percent * (size[a] + size[b]) and 100 * min(size[a], size[b]) >= percent * max(size[a], size[b])}
    assert len(tree.levels) > 2 and need == set(zip(i.tolist(), j.tolist(), strict=True)) and len(need) < 0.1 * 900 * 900


def test_points_never_lose_counts():
    draw = np.random.default_rng(5)
    counts = [draw.integers(0, m, GROUPS) for m in (2, 255, 256, 300, 5000, 10**6)] + [np.full(GROUPS, m) for m in (255, 256, 510, 511)]
    back = _unpacked(pa.chunked_array([[_packed(c) for c in counts]]))
    assert all((b >= c).all() and (b <= c * 1.01 + 2 ** max(0, int(c.max()).bit_length() - 8)).all() for b, c in zip(back, counts, strict=True))
    assert (back[0] == counts[0]).all() and (back[1] == counts[1]).all()


def test_whole_groups():
    key = np.sort(np.random.default_rng(1).integers(0, 40, 300))
    batches = [pa.RecordBatch.from_arrays([pa.array(key[lo : lo + 7])], names=["k"]) for lo in range(0, 300, 7)]
    parts = [t["k"].to_numpy() for t in whole_groups(iter(batches), ["k"])]
    assert np.concatenate(parts).tolist() == key.tolist() and len(parts) > 20
    assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False))
