"""From raw documents to packed training sequences, in stages.

Each stage takes the documents that its predecessor kept and returns documents with the same columns;
the last returns the pieces of the packed sequences. ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizmill.llm.best_fit import pack_documents
from quizmill.llm.language_id import fit, identify
from quizmill.llm.mixing import mixed_documents
from quizmill.llm.ngram_join import BROADCAST_IDS, near_copies
from quizmill.llm.numbering import numbered
from quizmill.llm.scratch import materialize
from quizmill.llm.substring_dedup import remove_repeats


def _documents(found: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` from a struct ``row`` and the new ``text``."""
    columns = {c: F.col(f"row.`{c}`") for c in like.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(like.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language's centroid is near, or without a letter (null texts too), go. Ids only
    choose rows for the fit: rows that share an id or have none are judged each on its own."""
    return _documents(identify(docs, fit(docs), keep_text=True).where("not rejected"), docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the document with the smallest id stays.

    Rows that share an id and hold different texts are documents of their own; of rows that share id and
    text one stays. Rows without an id are documents of their own too, and come last. Between rows of one
    id, or without any, the smallest hash of the text decides, then of the other columns."""
    repeated = materialize(docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").cast("long").alias("node")))
    if repeated.isEmpty():
        going = near_copies(docs, width=5, percent=80).where("component_id <> doc_id").select("doc_id").distinct()
        return docs.join(going, "doc_id", "left_anti").select(*docs.columns)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("node"))
    if repeated.count() <= BROADCAST_IDS:
        ids = F.broadcast(repeated.where("node is not null"))
        odd = rows.join(ids, "node", "left_semi").select("row").unionByName(rows.where("node is null").select("row"))
        own = numbered(odd, _after(docs), "node")
        rows = rows.where("node is not null").join(ids, "node", "left_anti").select("row", "node").unionByName(own)
    else:
        rows = own = numbered(rows.select("row"), 0, "node")
    going = _later_copies(near_copies(rows, width=5, percent=80, id_col="node", text_col="row.text"), own)
    return rows.join(going, "node", "left_anti").select("row.*")


def _after(docs: DataFrame) -> int:
    """The number after the largest id."""
    largest = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0]
    return 0 if largest is None else largest + 1


def _later_copies(found: DataFrame, own: DataFrame) -> DataFrame:
    """The ``node`` of each row of ``found`` that gives way to another of its group; ``own`` are the rows
    with a number in place of their id."""
    rest = [F.col(f"row.`{c}`") for c in own.schema["row"].dataType.names if c not in ("doc_id", "text")]
    own = own.select(
        F.col("node").alias("own"),
        F.col("row.doc_id").cast("long").alias("id"),
        F.sha2("row.text", 256).alias("digest"),
        F.sha2(F.to_json(F.struct(*rest)), 256).alias("rest") if rest else F.lit("").alias("rest"),
    )
    # texts without a word link with nothing: of rows that share id and text one stays all the same
    blank = (F.col("n_shingles") == 0) & F.col("id").isNotNull()
    found = found.join(own, F.col("doc_id") == F.col("own"), "left").select(
        F.col("doc_id").alias("node"),
        F.when(blank, F.concat_ws(" ", F.lit("id"), "id", "digest")).otherwise(F.col("component_id").cast("string")).alias("group"),
        F.struct((F.col("own").isNotNull() & F.col("id").isNull()).alias("last"), F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("id")).alias("id"), "digest", "rest", F.col("doc_id").alias("node")).alias("place"),
    )
    found = materialize(found)
    first = found.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    return materialize(found.join(first, "group").where("node <> first.node").select("node"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur earlier are cut out; a document of nothing else goes.

    Rows without an id are numbered after the largest id, so each is a document of its own."""
    kept = "n_words = 0 or n_removed < n_words"
    without = docs.where("doc_id is null")
    if without.isEmpty():
        return _documents(remove_repeats(docs, window=50, joined_words=False).where(kept), docs)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    own = numbered(without.select(rest, "text"), _after(docs), "node")
    rows = docs.where("doc_id is not null").select(rest, "text", F.col("doc_id").cast("long").alias("node")).unionByName(own)
    found = remove_repeats(rows, window=50, id_col="node", joined_words=False).where(kept)
    return _documents(found.select("row.row", "text"), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target shares, by whole blocks of words. Rows count each on their own, whether
    they share an id or have none; texts without words leave."""
    found = mixed_documents(docs)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048; rows that share an id or have none are packed
    each on their own, null texts as empty ones."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("language_id", language_id), ("ngram_join", ngram_join), ("substring_dedup", substring_dedup), ("mixing", mixing), ("best_fit", best_fit)]

#: The stages hash, tokenise and draw in ways that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else materialize(docs), sf_dir)
    return docs
