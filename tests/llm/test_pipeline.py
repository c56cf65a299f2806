"""Each stage of the pipeline on its own input, held against a plain Python version; accuracy and recall."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from plain_versions import targets

import corpus_pipeline
from quizmill.llm.queries import QUERIES
from quizmill.llm.scratch import materialize

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """Input of the first stage, and what each returns."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF)))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def words(text):
    return WORD.findall(text or "")


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "substring_dedup", "mixing", "best_fit"]


def test_language_stage(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    gone = set(before) - set(after)
    assert all(before[d] == r for d, r in after.items())
    assert {d for d, r in before.items() if not any(c.isalpha() for c in r.text or "")} <= gone
    assert len(after) >= 0.9 * len(before)


def test_copies_stage(stages):
    before, after = by_id(stages[1]), by_id(stages[2])

    def shingles(text):
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets, head = {d: shingles(r.text) for d, r in before.items()}, {d: d for d in before}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert links
    for _ in ids:
        now = dict(head)
        for a, b in links:
            head[a] = head[b] = min(head[a], head[b])
        if now == head:
            break
    assert set(after) == {d for d in ids if head[d] == d} and all(before[d] == r for d, r in after.items())


def test_repeats_stage(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    seen, want = set(), {}
    for d in sorted(before):
        w = words(before[d].text)
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            if k in seen:
                gone[i : i + 50] = True
            seen.add(k)
        if not gone.any():
            want[d] = before[d].text
        elif not gone.all():
            want[d] = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    assert {d: r.text for d, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)


def test_mixing_stage(stages):
    before, after = by_id(stages[3]), stages[4].collect()
    size, taken, own = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before.values():
        size[r.source] += len(words(r.text))
    for r in after:
        taken[r.source] += len(words(r.text))
        own[r.doc_id] += len(words(r.text))
        assert r.source == before[r.doc_id].source and set(words(r.text)) <= set(words(before[r.doc_id].text))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    for name, target in zip(names, targets([size[s] for s in names]), strict=True):
        assert abs(taken[name] - target) <= max(0.02 * target, 200)
    assert all(n <= 3 * len(words(before[d].text)) for d, n in own.items())


def test_packing_stage(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(int)
    for r in stages[4].collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        cut = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    fill = defaultdict(int)
    for r in sorted(stages[5].collect(), key=lambda r: (r.sequence_id, r.offset)):
        want[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] -= 1
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert not any(want.values()) and max(fill.values()) <= 2048


def test_run_is_the_stages(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*key).collect())) == sorted(map(tuple, stages[5].select(*key).collect()))


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op3_language_id"](spark, SF).collect() if r.held_out and r.lang_pred != "und" and lang[r.doc_id]]
    assert len(rows) > 20 and sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows)


def test_searches_of_whole_tables(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in rows if r.embedding is not None and np.isfinite(np.array(r.embedding, float)).all() and np.any(r.embedding)]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    for name, y in (("op2_collision_counting", x), ("op6_maxscore", np.floor(64 * x))):
        got = defaultdict(list)
        for r in sorted(QUERIES[name](spark, SF).collect(), key=lambda r: (r.query_id, r["rank"])):
            got[r.query_id].append((r.vec_id, r.score))
        hits = 0
        assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
        for q, found in got.items():
            s = y @ y[ids == q][0]
            s[ids == q] = -np.inf
            best = np.lexsort((ids, -s))[:20]
            hits += len(set(ids[best].tolist()) & {i for i, _ in found})
            score = dict(zip(ids.tolist(), s.tolist(), strict=True))
            assert len(found) == 20 and all(abs(score[i] - v) < 1e-9 for i, v in found)
            if name == "op6_maxscore":
                assert [i for i, _ in found] == ids[best].tolist()
        assert hits >= 0.9 * 20 * len(got)
