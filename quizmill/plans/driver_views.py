"""Questions, answers, judgments and responses derived from the star-schema tables.

The tables have no trivia corpus, so parts become questions and line items answers: every row of
``part`` and ``lineitem`` is used, with all forms of answer that the operators tell apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.questions import clean_questions
from ..operators.work import latest_answers
from ..schemas import ANSWERS, conform
from .store import stored

RAW_QUESTIONS = """
    substring(sha2(concat('q', p_partkey), 256), 1, 16) as question_id,
    case when p_partkey % 2 = 0 then concat('Entertainment: ', p_type) else p_type end as category,
    case when p_partkey % 5 = 0 then 'boolean' else 'multiple' end as type,
    case when p_size <= 16 then 'Easy' when p_size <= 33 then 'medium' else 'hard' end as difficulty,
    concat('Which item is number ', p_partkey, '?') as question,
    case when p_partkey % 5 = 0 then if(p_partkey % 2 = 0, 'True', 'False')
         when p_partkey % 7 = 0 then cast(1700 + p_partkey % 300 as string)
         when p_partkey % 11 = 0 then concat('The ', p_name)
         else concat(p_name, ' ', p_brand) end as correct_answer,
    case when p_partkey % 5 = 0 then array(if(p_partkey % 2 = 0, 'False', 'True'))
         when p_partkey % 7 = 0 then array(cast(1703 + p_partkey % 300 as string), cast(1709 + p_partkey % 300 as string), cast(1712 + p_partkey % 300 as string))
         else array(concat('plain ', p_brand), concat('other ', p_name), concat('third ', p_type)) end as incorrect_answers
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey", *_expressions(RAW_QUESTIONS))


def _expressions(block: str) -> list[str]:
    out, depth, now = [], 0, ""
    for c in block.strip():
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_questions(spark, sf_dir)
    return raw.withColumns({"incorrect_answers": F.to_json("incorrect_answers"), "fetched_at": F.lit("2026-01-01"), "batch_id": F.lit("b0")})


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver questions (with ``choices_norm``); ids are unique by construction."""
    return clean_questions(bronze(spark, sf_dir), F.lit("2026-01-02"), unique=False)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that ``cleaned`` gives."""
    return stored(spark, sf_dir, "questions", lambda: cleaned(spark, sf_dir))


def all_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that ``given_answers`` gives."""
    return stored(spark, sf_dir, "answers", lambda: given_answers(spark, sf_dir))


def given_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer for each line item, repeats of a triple included, in the order given by ``seq``."""
    q = questions(spark, sf_dir).select("question_id", "choices", "correct_answer", "correct_answer_position", "incorrect_answers")
    item = table(spark, sf_dir, "lineitem").selectExpr(
        "substring(sha2(concat('q', l_partkey), 256), 1, 16) as question_id",
        "concat('org_model-', l_suppkey % 4) as model_slug",
        "concat('org/model-', l_suppkey % 4) as model_name",
        "element_at(array('p1_constrained_mcq', 'p2_open_minimal', 'p3_open_guided'), cast(l_linenumber % 3 as int) + 1) as prompt_variant",
        "cast((l_orderkey * 7 + l_linenumber) % 12 as int) as kind",
        "round(l_quantity / 10, 4) as response_time",
        "cast(floor(l_extendedprice / 1000) as bigint) as completion_tokens",
        "date_format(l_shipdate, 'yyyy-MM-dd') as answered_at",
        "concat('host-', l_suppkey % 2) as host",
        "concat('run-', l_suppkey % 8) as run_id",
        "l_orderkey * 8 + l_linenumber as seq",
        "l_linenumber = 1 as is_warmup",
    )
    kind = F.col("kind")
    forms = [
        F.char(F.lit(65) + F.col("correct_answer_position")),
        F.lit("A"),
        F.col("correct_answer"),
        F.concat(F.lower("correct_answer"), F.lit("!")),
        F.lit("The answer is B"),
        F.lit("option 2"),
        F.col("incorrect_answers")[0],
        F.element_at(F.split("correct_answer", " "), -1),
        F.lit("yes indeed"),
        F.lit("zzz"),
    ]
    said = F.lit("")
    for k, form in enumerate(forms):
        said = F.when(kind == k, form).otherwise(said)
    return item.join(q, "question_id").select(
        "question_id", "model_slug", "model_name", "prompt_variant", "kind", "response_time", "completion_tokens", "answered_at", "host", F.lit("cpu").alias("hardware"), "run_id", "seq", "is_warmup",
        F.when(kind == 11, "error").otherwise("ok").alias("status"),
        F.when(kind == 10, "maxPredictedTokensReached").otherwise("eosFound").alias("finish_reason"),
        said.alias("ai_answer"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of one answer a triple."""
    return stored(spark, sf_dir, "latest_answers", lambda: latest_answers(all_answers(spark, sf_dir), ("answered_at", "seq")))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions in responses of 50, texts in base64; every seventh response failed and is empty."""
    raw = raw_questions(spark, sf_dir).withColumn("batch", F.floor(F.col("p_partkey") / 50))
    b64 = lambda c: F.base64(F.encode(c, "utf-8"))
    row = F.struct(*[b64(F.col(c)).alias(c) for c in ("type", "difficulty", "category", "question", "correct_answer")], F.transform("incorrect_answers", b64).alias("incorrect_answers"))
    rows = raw.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))).alias("rows"))  # 50 each
    failed = F.col("batch") % 7 == 6
    results = F.when(failed, F.array().cast("array<struct<type:string,difficulty:string,category:string,question:string,correct_answer:string,incorrect_answers:array<string>>>")).otherwise(F.transform("rows", lambda x: x["r"]))
    return rows.select(
        F.format_string("b%06d", "batch").alias("batch_id"),
        (F.col("batch") % 24 + 9).cast("long").alias("category_id"),
        F.struct(F.when(failed, 4).otherwise(0).cast("long").alias("response_code"), results.alias("results")).alias("payload"),
    )


def as_answers(df: DataFrame) -> DataFrame:
    return conform(df, ANSWERS)
