"""Words and shingles of batches larger than what is taken at once."""

import random
import re

import pyarrow as pa
import pytest

from quizmill.llm import wordhash
from quizmill.llm.wordhash import shingle_sets, words_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("rows,size", [(1024, 1 << 20), (7, 1 << 20), (64, 200)])
def test_chunks(monkeypatch, rows, size):
    monkeypatch.setattr(wordhash, "CHUNK_ROWS", rows)
    monkeypatch.setattr(wordhash, "CHUNK_BYTES", size)
    draw = random.Random(rows)
    texts = [None if draw.random() < 0.05 else "".join(draw.choices("abé日 \n\t", k=draw.randint(0, 60))) for _ in range(3000)]
    column = pa.array(["skipped", *texts]).slice(1)
    found = [[] for _ in texts]
    hashes = {}
    for w in words_of(column):
        for i in range(w.n):
            for j in range(w.first[i], w.first[i + 1]):
                word = w.data[w.start[j] : w.end[j]].tobytes()
                found[w.lo + i].append(word)
                assert hashes.setdefault(word, w.hash[j]) == w.hash[j]
    assert found == [WORD.findall((t or "").encode()) for t in texts]
    assert len(set(hashes.values())) == len(hashes)
    sets = dict(shingle_sets(column, 3))
    assert sorted(sets) == [i for i, w in enumerate(found) if w]
    assert all(len(u) == len({tuple(w[k : k + 3]) for k in range(max(len(w) - 2, 1))}) for u, w in ((sets[i], [x.lower() for x in found[i]]) for i in sets))
