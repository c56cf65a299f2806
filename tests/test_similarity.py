"""Similarity of whole batches against the ratio of one pair and a table of all prefixes."""

import random

import numpy as np
import pytest

from quizmill.functions import similarity
from quizmill.functions.similarity import common_length, common_lengths, token_set_ratios
from quizmill.functions.text import token_set_ratio

from test_operators import plain_ratio


def by_prefixes(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0] * (len(b) + 1)
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def texts(draw: random.Random, n: int, words: int, letters: str = "abcé日𝄞") -> list:
    return [" ".join("".join(draw.choices(letters, k=draw.randint(1, 7))) for _ in range(draw.randint(0, words))) for _ in range(n)]


def test_many_pairs_equal_one_by_one():
    draw = random.Random(7)
    x, y = texts(draw, 100_000, 6), texts(draw, 100_000, 6)
    y[::3] = [" ".join(draw.sample(t.split(), len(t.split()))) + draw.choice(["", " a", "b"]) for t in x[::3]]
    assert token_set_ratios(x, y).tolist() == [token_set_ratio(a, b) for a, b in zip(x, y)]


@pytest.mark.parametrize("few", [0, 32])
def test_lengths_at_the_borders_of_numbers(few, monkeypatch):
    monkeypatch.setattr(similarity, "FEW", few)
    monkeypatch.setattr(similarity, "MASKS", 3000)
    draw = random.Random(3)
    sizes = [0, 1, 2, 63, 64, 65, 127, 128, 129, 191, 192, 193, 255, 256, 257, 300]
    pairs = [(draw.choices(range(k), k=n), draw.choices(range(k), k=m)) for n in sizes for m in sizes for k in (1, 2, 30)]
    flat = [c for p in pairs for side in p for c in side]
    n, m = (np.array([len(p[s]) for p in pairs]) for s in (0, 1))
    a = np.cumsum(n + m) - n - m
    found = common_lengths(np.array(flat), a, n, a + n, m).tolist()
    assert found == [common_length(*p) for p in pairs] == [by_prefixes(*p) for p in pairs]


def test_odd_batches():
    assert token_set_ratios([], []).tolist() == [] and token_set_ratios([None, ""], ["", None]).tolist() == [0, 0]
    assert token_set_ratios(["a\x1cb", " a b　", "a a", "x"], ["b a", "b\ta", "a", None]).tolist() == [100, 100, 100, 0]
    draw = random.Random(5)
    long = [" ".join(texts(draw, 1, 60)) for _ in range(150)]  # some hundred characters each
    other = [" ".join(draw.sample(t.split(), len(t.split()) // 2)) + " tail" for t in long]
    very = "".join(draw.choices("ab ", k=20_000))
    long, other = long + [very, very, "ab"], other + [very[:5000] + " c", "q", very]
    assert token_set_ratios(long, other) == pytest.approx([token_set_ratio(a, b) for a, b in zip(long, other)], abs=0)
    assert token_set_ratios(long[:150], other[:150]) == pytest.approx([plain_ratio(a, b) for a, b in zip(long[:150], other[:150])])
