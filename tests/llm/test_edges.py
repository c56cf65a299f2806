"""Empty tables, clashing columns, nulls, repeated rows, ties and long texts, for each operator."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quizmill.llm.ann_search import nearest
from quizmill.llm.best_fit import pack_documents
from quizmill.llm.chat_format import format_conversations, read_back
from quizmill.llm.components import connected_components
from quizmill.llm.language_id import fit, identify, predict_languages
from quizmill.llm.maxscore import best_scores
from quizmill.llm.mixing import mix, mixed_documents
from quizmill.llm.ngram_join import near_copies
from quizmill.llm.sharding import shard_rows
from quizmill.llm.substring_dedup import remove_repeats
from quizmill.llm.token_counts import count_tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES, BYTES, RANKS = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
DOCS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"w{i % 9973}" for i in range(120_000))
ROWS = [
    (0, None, "en", "a"),
    (1, "", "en", "a"),
    (2, " \t\n", None, None),
    (3, "one", "fr", "b"),
    (4, LONG, "en", "a"),
    (5, LONG + " tail", "en", None),
    (6, "é ü 日本 🙂 the same words again and again", "fr", "b"),
    (7, "é ü 日本 🙂 the same words again and again", "fr", "c"),
    (7, "é ü 日本 🙂 the same words again and again", "fr", "c"),
    (8, "<|endoftext|> inside", "en", "c"),
    (None, "no id", None, None),
    (None, None, None, None),
]
#: Operators over documents, and the columns whose names they use themselves.
ON_DOCS = {
    "near_copies": lambda d: near_copies(d),
    "languages": lambda d: predict_languages(d),
    "shards": lambda d: shard_rows(d),
    "mix": lambda d: mix(d),
    "tokens": lambda d: count_tokens(d, PIECES),
    "repeats": lambda d: remove_repeats(d, 5).select("row.doc_id", "text", "n_words", "n_removed"),
    "packed": lambda d: pack_documents(d, BYTES, RANKS),
}
CLASHES = ["row", "n", "size", "bucket", "score", "rank", "task", "spread", "turns", "_mark", "_one", "_turn", "_parts", "turn", "mark", "own_id", "number", "target", "a b", "doc"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ON_DOCS)
def test_empty_documents(spark, name):
    assert ON_DOCS[name](spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", ON_DOCS)
def test_clashing_columns(docs, name):
    more = docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    assert counted(ON_DOCS[name](more)) == counted(ON_DOCS[name](docs))


def test_whole_rows_survive_clashes(docs):
    more = docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    assert set(remove_repeats(more, 5).select("row.*").columns) == set(more.columns) - {"text"}
    assert set(identify(more, fit(more)).select("row.*").columns) == set(more.columns) - {"text"}
    assert mixed_documents(more).columns == more.columns and mixed_documents(more).count() > 0


def test_one_row_for_each(docs):
    ids = Counter(r[0] for r in ROWS)
    for name in set(ON_DOCS) - {"packed"}:
        assert Counter(r[0] for r in ON_DOCS[name](docs).select("doc_id").collect()) == ids, name


def test_token_counts_are_the_library_s(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((d, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t, *_ in ROWS)
    assert counted(count_tokens(docs, PIECES)) == want


def test_packing_gives_back_all_tokens(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    rows = pack_documents(docs, BYTES, RANKS).collect()
    want = Counter()
    for d, t, *_ in ROWS:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cut = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)))
    assert Counter(tuple(r)[:5] for r in rows) == want
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) == -(-sum(fill.values()) // 2048)


def test_repeats_of_equal_ids_and_long_texts(docs):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in ON_DOCS["repeats"](docs).collect()}
    seen, want = set(), set()
    rows = [r for r in ROWS if r[0] is not None]
    for d, t in sorted({(r[0], r[1] or "") for r in rows}):  # rows that share id and words are one document
        w = WORD.findall(t)
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 4):
            k = tuple(w[i : i + 5])
            if k in seen:
                gone[i : i + 5] = True
            seen.add(k)
        want.add((d, len(w), int(gone.sum())))
    assert want == {r for r in got if r[0] is not None}


def test_shards_are_even_and_repeatable(docs):
    rows = shard_rows(docs, 5).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert counted(shard_rows(docs.repartition(3), 5)) == Counter(tuple(r) for r in rows)


def test_mix_is_repeatable_and_bounded(docs):
    rows = mix(docs).collect()
    assert counted(mix(docs.repartition(5))) == Counter(tuple(r) for r in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 64 * 3


def test_searches_of_ties_and_bad_vectors(spark):
    schema = "vec_id long, embedding array<float>, rank string"
    for search in (nearest, best_scores):
        assert search(spark.createDataFrame([], schema)).collect() == []
    bad = [(120, None, "x"), (40, [], "x"), (60, [float("nan"), 1.0], "x"), (80, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x")]
    table = spark.createDataFrame([(i, [1.0, 2.0], "x") for i in range(20)] + [(20, [0.5, 0.5], "x"), (0, [1.0, 2.0], "x"), (100, [1.0], "x"), *bad], schema)
    for search in (nearest, best_scores):
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in search(table).collect())
        # ties go to the smaller id; vector 20 is the least near to the others; both rows of id 0 ask, each
        # finds the other, and both are found
        assert got == sorted([(0, k + 1, k) for k in range(20)] * 2 + [(20, 1, 0)] + [(20, k + 2, k) for k in range(19)]), search
    zero = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [0.0, 0.0], "x"), (2, [-1.0, 0.5], "x")], schema)
    assert [(r.query_id, r.vec_id) for r in nearest(zero).collect()] == [(0, 2)]
    assert [(r.query_id, r.vec_id, r.score) for r in best_scores(zero).orderBy("rank").collect()] == [(0, 1, 0), (0, 2, -4096)]


def test_chats(spark):
    schema = "conv_id long, turn long, role string, text string, part string"
    assert read_back(format_conversations(spark.createDataFrame([], schema))).collect() == []
    big = "<|im_end|>\\<|" * 40_000
    rows = [(1, 0, None, None, "x"), (1, None, "system", "first", "x"), (2, 1, "assistant", big, "x"), (2, 1, "assistant", big, "x"), (None, 0, "assistant", "é🙂", "x")]
    got = {r.conv_id: r for r in read_back(format_conversations(spark.createDataFrame(rows, schema))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars) == (2, sha("system\nfirst\n\n\n"), 0)
    assert (got[2].n_turns, got[2].loss_chars, got[2].loss_sha256) == (2, 2 * len(big), sha(big + big))
    assert (got[None].loss_chars, got[None].loss_sha256) == (2, sha("é🙂"))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1200)] + [(5, 5), (None, 3), (7, 1000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(1000, 1200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
