"""From the log of responses to bronze questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefolded
from .first import first_of_each
from .prefilter import may_match

SEPARATOR = "␟"


def explode_results(responses: DataFrame) -> DataFrame:
    """One row a question of the successful responses, with its place in the response."""
    ok = responses.where(F.col("payload.response_code") == 0)
    return ok.select("batch_id", "category_id", F.posexplode("payload.results").alias("pos", "r")).select("batch_id", "category_id", "pos", "r.*")


def decode_field(text: Column) -> Column:
    """Base64 of UTF-8 decoded; anything else as it is; null is empty."""
    strict = text.rlike(r"^[A-Za-z0-9+/]*={0,2}\z") & (F.length(text) % 4 == 0)
    plain = F.try_validate_utf8(F.try_to_binary(text, F.lit("base64")).cast("string"))
    return F.coalesce(F.when(strict, plain), text, F.lit(""))


def decode_results(exploded: DataFrame) -> DataFrame:
    texts = ["type", "difficulty", "category", "question", "correct_answer"]
    return exploded.withColumns({c: decode_field(F.col(c)) for c in texts} | {"incorrect_answers": F.transform("incorrect_answers", decode_field)})


def question_id(question: Column, answer: Column, exact: bool = True) -> Column:
    """16 hex digits that stand for question and answer, whatever their case and blanks. Case is folded
    (ß like ss); texts with other than ASCII characters go to a helper for that. ``exact=False`` only
    lower-cases, all in the JVM."""
    fold = casefolded if exact else F.lower
    plain = lambda c: F.regexp_replace(fold(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), r"(?U)\s+", " ")
    return F.substring(F.sha2(F.concat_ws(SEPARATOR, plain(question), plain(answer)), 256), 1, 16)


def bronze_rows(decoded: DataFrame, fetched_at: Column, exact: bool = True) -> DataFrame:
    return decoded.select(
        question_id(F.col("question"), F.col("correct_answer"), exact).alias("question_id"),
        "category", "type", "difficulty", "question", "correct_answer",
        F.to_json("incorrect_answers").alias("incorrect_answers"),
        fetched_at.alias("fetched_at"), "batch_id", "pos",
    )


def dedupe_questions(df: DataFrame, order_by: tuple[str, ...] = ("fetched_at", "batch_id", "pos")) -> DataFrame:
    """The first row of each id, by a pass over ids and order alone."""
    return first_of_each(df, ["question_id"], [(F.col(c), True) for c in order_by])


def new_questions(batch: DataFrame, existing: DataFrame, prefilter: bool = False) -> DataFrame:
    """``existing`` and the questions of ``batch`` whose ids it lacks. With ``prefilter``, for a batch that
    is small beside what exists, only ids that may be the batch's are shuffled."""
    had = existing.select("question_id")
    fresh = batch.join(may_match(had, batch, ["question_id"]) if prefilter else had, "question_id", "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def ingest_summary(bronze: DataFrame, expected: int) -> DataFrame:
    unique = F.count_distinct("question_id")
    return bronze.agg(
        unique.alias("unique_questions"),
        F.lit(expected).cast("long").alias("expected_questions"),
        F.max_by("category", F.struct("fetched_at", "batch_id")).alias("last_category"),
        F.when(unique >= expected, "complete").otherwise("partial").alias("status"),
    )


def response_audit(responses: DataFrame) -> DataFrame:
    return responses.groupBy("category_id", F.col("payload.response_code").alias("response_code")).agg(
        F.count("*").alias("n_batches"), F.sum(F.coalesce(F.size("payload.results"), F.lit(0))).alias("n_results")
    )
