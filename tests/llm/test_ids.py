"""Stages of the pipeline on documents whose ids repeat or are missing."""

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string"


def text(seed, n=120):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(n))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, b, c, d = (text(k) for k in "abcd")
    kept = [(1, a, "en", "x"), (2, c, "en", "y"), (2, d, "en", "z"), (3, text("e"), "en", "x"), (5, "", "en", "x"), (5, None, "en", "x")]
    # a near copy of the smaller id 1, a repeated row, a copy of a text of the repeated id, a repeated blank row
    gone = [(2, a + " more", "en", "x"), (2, c, "en", "z"), (4, d, "en", "x"), (5, "", "en", "x")]
    either = {(2, c, "en", "y"), (2, c, "en", "z")}
    found = []
    for order in (1, -1):
        docs = spark.createDataFrame((kept + gone)[::order], DOCS).repartition(2 + order)
        found.append(rows(corpus_pipeline.ngram_join(spark, docs, "")))
    assert found[0] == found[1] and len(either & set(found[0])) == 1
    assert sorted(set(found[0]) - either, key=repr) == sorted(set(kept) - either, key=repr) and len(found[0]) == len(kept)


def test_many_repeated_ids(spark, monkeypatch):
    """More repeated ids than are broadcast: all rows are numbered."""
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", 1)
    kept = [(i, text(f"{s}{i}"), "en", s) for s in "xy" for i in range(4)] + [(9, text("n"), "en", "x")]
    gone = [(3, text("y1"), "en", "z"), (10, text("n"), "en", "x")]
    docs = spark.createDataFrame(kept + gone, DOCS)
    assert rows(corpus_pipeline.ngram_join(spark, docs, "")) == rows(spark.createDataFrame(kept, DOCS))


def test_copies_without_an_id_go(spark):
    a, b, c = (text(k) for k in "abc")
    kept = [(1, a, "en", "x"), (7, text("d"), "en", "x"), (None, c, "en", "x"), (None, None, "en", "x"), (None, None, "en", "y")]
    # copies of a text with an id, an exact copy and a near copy of one without; one of these two stays
    gone = [(None, a, "en", "x"), (None, a + " more", "en", "x"), (7, a, "en", "x")]
    either = {(None, b, "en", "x"), (None, b + " more", "en", "x")}
    found = []
    for order in (1, -1):
        docs = spark.createDataFrame((kept + gone + sorted(either) + [(None, b, "en", "x")])[::order], DOCS).repartition(2 + order)
        found.append(rows(corpus_pipeline.ngram_join(spark, docs, "")))
    assert found[0] == found[1] and len(either & set(found[0])) == 1
    assert rows(spark.createDataFrame([r for r in found[0] if r not in either], DOCS)) == rows(spark.createDataFrame(kept, DOCS))
    assert len(found[0]) == len(kept) + 1


def test_passages_of_documents_without_an_id_go(spark):
    a, b, c = (text(k) for k in "abc")
    docs = spark.createDataFrame([(5, a, "en", "x"), (None, a, "en", "x"), (None, b, "en", "x"), (None, b, "en", "x"), (None, c, "en", "y"), (None, None, "en", "y"), (None, "", "en", "y")], DOCS)
    got = rows(corpus_pipeline.substring_dedup(spark, docs, ""))
    assert got == rows(spark.createDataFrame([(5, a, "en", "x"), (None, b, "en", "x"), (None, c, "en", "y"), (None, None, "en", "y"), (None, "", "en", "y")], DOCS))


def test_stages_of_empty_and_odd_tables(spark):
    """Every stage takes an empty table, null ids and texts, ids shared by different rows, and columns that clash."""
    schema = DOCS + ", row string, size int, mark string, n_chars long"
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(1, text("a"), "en", "x", "r", 1, "m", 0), (1, text("b"), None, None, "r", 1, "m", 0), (None, text("c"), "en", None, "r", None, "m", 0), (None, None, None, None, None, None, None, None), (3, "", "en", "x", "r", 1, "m", 0)] * 2, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name
        out = stage(spark, odd, "")
        assert name == "best_fit" or out.columns == odd.columns
        assert out.count() > 0, name
    once = corpus_pipeline.ngram_join(spark, odd, "")
    assert once.where("doc_id = 1").count() == 2 and once.where("doc_id is null and text is not null").count() == 1
    mixed = corpus_pipeline.mixing(spark, once, "")
    assert all(r.n_chars == len(r.text) and r.mark == "m" for r in mixed.collect())
