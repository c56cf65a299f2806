"""Periodic runs against a direct comparison at every lag."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from quizmill.llm import periodic_runs
from quizmill.llm.periodic_runs import Sequences, collapse_runs, minimizer_pairs, runs_of
from quizmill.llm.queries import QUERIES
from quizmill.llm.wordhash import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs int, h string"


def plain_runs(words, least=24):
    number = {}
    a = np.array([number.setdefault(w, len(number)) for w in words])
    period = {}
    for q in range(1, len(a) // 3 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (a[q:] == a[:-q]).view(np.int8), [0]))))
        for lo, hi in zip(edges[::2].tolist(), (edges[1::2] + q).tolist(), strict=True):
            if hi - lo >= max(least, 3 * q):
                period.setdefault((lo, hi), q)
    return sorted((lo, hi - lo, q) for (lo, hi), q in period.items())


def found_in(texts, least=24):
    out = [[] for _ in texts]
    for w in words_of(pa.array(texts)):
        for i, *run in zip(*(x.tolist() for x in runs_of(w, least)), strict=True):
            out[w.lo + i].append(tuple(run))
    return out


def made_text(draw):
    """Words of a small or large alphabet with repetitions planted, some inside others' periods."""
    n, letters = draw.choice([0, 3, 30, 100, 400, 1500, 4000]), draw.choice([1, 2, 3, 50, 5000])
    w = [f"w{draw.randrange(letters)}" for _ in range(n)]
    for _ in range(draw.randrange(4)):
        if n < 10:
            break
        a = draw.randrange(n)
        q = 1 + draw.randrange(max(1, (n - a) // 3))
        inner = 1 + draw.randrange(max(1, q // 2))
        for i in range(a + inner, min(n, a + q) - 1) if draw.random() < 0.3 else ():
            w[i] = w[i - inner]
        for i in range(a + q, min(n, a + int(q * (3 + 4 * draw.random())))):
            w[i] = w[i - q]
    return w


@pytest.mark.parametrize("short", [32, 12])
def test_all_runs(short, monkeypatch):
    """``SHORT`` of 12 makes the first scale 24, where grams have 4 words and windows 2."""
    monkeypatch.setattr(periodic_runs, "SHORT", short)
    draw = random.Random(5)
    texts = [made_text(draw) for _ in range(300)]
    want = [plain_runs(t) for t in texts]
    assert found_in([" ".join(t) for t in texts]) == want
    assert sum(q > short for runs in want for _, _, q in runs) > 50


def test_exact_period_counts_and_borders():
    """Exactly three periods, runs at both ends of a text, of every period around the scales' borders."""
    texts = []
    for q in [*range(1, 40), 63, 64, 65, 66, 127, 128, 129, 255, 256, 257]:
        period = [f"p{i}" for i in range(q)]
        for n in (3 * q - 1, 3 * q, 3 * q + 1, max(24, 3 * q)):
            run = [period[i % q] for i in range(n)]
            texts += [run, ["x", *run, "y"], [*run, *run[:-1], "z", *run]]
    assert found_in([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_few_pairs():
    """Pairs grow with the text, also where one word, or one short period, fills it."""
    for period in (1, 3, 40):
        text = " ".join(f"w{i % period}" for i in range(30_000))
        (w,) = words_of(pa.array([text]))
        pairs = sum(len(minimizer_pairs(w, Sequences(w.hash), np.array([0]), 2**k)[0]) for k in range(6, 14))
        assert pairs < 60_000
        assert found_in([text]) == [[(0, 30_000, period)]]


def test_rows(spark):
    """Nulls, empty texts, repeated rows, missing ids and clashing columns; kept words."""
    loop = " ".join(["a b c"] * 10)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one  two\nthree"), (5, f"start {loop} end"), (5, f"start {loop} end"), (None, loop), (6, f"{loop} x {' '.join(['y'] * 30)}")]
    docs = spark.createDataFrame([(i, t, 7, "h") for i, t in rows], SCHEMA)
    found = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(docs).collect())
    assert found == sorted(
        [
            ("1", 0, [], ""),
            ("2", 0, [], ""),
            ("3", 0, [], ""),
            ("4", 3, [], "one two three"),
            ("5", 32, [(1, 30, 3)], "start a b c end"),
            ("5", 32, [(1, 30, 3)], "start a b c end"),
            ("None", 30, [(0, 30, 3)], "a b c"),
            ("6", 61, [(0, 30, 3), (31, 30, 1)], "a b c x y"),
        ]
    )
    assert collapse_runs(docs.where("false")).collect() == []


def test_query(spark):
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, path).collect()}
    texts = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for doc, text in texts:
        w = WORD.findall(text or "")
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs, keep = plain_runs(w), [True] * len(w)
        for s, n, q in runs:
            keep[s + q : s + n] = [False] * (n - q)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        r = got[doc]
        assert (r.n_runs, r.runs_sha256, r.collapsed_sha256) == (len(runs), digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(x for x, k in zip(w, keep, strict=True) if k)))
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert sum(r.n_runs > 0 for r in got.values()) > 10
