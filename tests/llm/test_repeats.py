"""Substring dedup with small buckets, groups and stretches, held against a plain version."""

import random
import re

import numpy as np
import pytest

from quizmill.llm.substring_dedup import _key, _unkey, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, window):
    seen, out = set(), {}
    for d, t in sorted(docs):
        w = WORD.findall(t or "")
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                gone[i : i + window] = True
            seen.add(k)
        out[d] = (len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("held,bucket", [(50, 300), (10_000, 40)])
def test_borders(spark, held, bucket):
    """Windows leave in many stretches, meet in many buckets and return to many groups."""
    draw = random.Random(3)
    passages = [[draw.choice("abcdefgh") + str(draw.randint(0, 40)) for _ in range(30)] for _ in range(6)]
    docs = []
    for d in range(120):
        w = [draw.choice("mnopq") + str(draw.randint(0, 500)) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(w))
            w[at:at] = draw.choice(passages)[: draw.randint(8, 30)]
        docs.append((d, " ".join(w)))
    docs += [(200 + i, " ".join(passages[0])) for i in range(40)]  # a passage that is many documents
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = remove_repeats(df, 7, held=held, bucket=bucket, group_bytes=500).select("row.doc_id", "n_words", "n_removed", "text").collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == plain(docs, 7)


def test_documents_without_an_id_spread(spark):
    """They are dealt out by their texts, not as one group."""
    docs = [(None, f"w{i} " + " ".join(f"{i}x{k}" for k in range(20))) for i in range(400)]
    out = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 5, group_bytes=2000)
    sizes = [len(p) for p in out.select("n_removed").rdd.glom().collect()]
    assert sum(sizes) == 400 and max(sizes) < 100
    assert {r.n_removed for r in out.collect()} == {0}


@pytest.mark.parametrize("one_id", [None, 7])
def test_equal_rows_spread(spark, one_id):
    """A third of all rows are one document: no task gets them all, and all lose the same."""
    passage = [f"p{k}" for k in range(20)]
    docs = [(-1, "a " + " ".join(passage[:12]), "x")]
    docs += [(None, f"w{i} " + " ".join(f"{i}x{k}" for k in range(20)), "y") for i in range(800)]
    docs += [(one_id, "b c " + " ".join(passage) + " d", "z") for i in range(400)] + [(one_id, "other words", "z")]
    out = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string, bucket string").repartition(6), 5, group_bytes=2000)
    sizes = [len(p) for p in out.select("n_removed").rdd.glom().collect()]
    assert sum(sizes) == len(docs) and max(sizes) < 100
    got = [tuple(r) for r in out.select("row.doc_id", "row.bucket", "n_words", "n_removed", "text").collect()]
    assert got.count((one_id, "z", 23, 12, "b c " + " ".join(passage[12:]) + " d")) == 400
    assert sorted(r[2:4] for r in got if r[1] != "z" or r[2] == 2) == [(2, 0), (13, 0)] + [(21, 0)] * 800


def test_keys_hold_both_hashes():
    draw = np.random.default_rng(1)
    h, more = draw.integers(0, 2**56, 50, dtype=np.uint64), draw.integers(0, 2**24, 50, dtype=np.uint32)
    import pyarrow as pa

    a, b = _unkey(pa.chunked_array([[_key(h[:20], more[:20]), _key(h[20:], more[20:])]]))
    assert (a == h).all() and (b == more).all()
