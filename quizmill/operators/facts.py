"""Staging projections and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRIPLE

_QUESTION = ["question_id", "category", "category_group", "category_name", "question_type", "difficulty", "question", "correct_answer", "correct_answer_position", "n_choices", "answer_is_numeric"]


def stg_questions(questions: DataFrame) -> DataFrame:
    return questions.withColumnRenamed("type", "question_type")


def stg_answers(answers: DataFrame) -> DataFrame:
    return answers.drop("prompt_text")


def stg_judgments(judgments: DataFrame) -> DataFrame:
    return judgments.select(*TRIPLE, "match_method", "ai_answer_norm", "ai_correct_strict", "ai_correct", "fuzzy_score")


def int_results(answers: DataFrame, questions: DataFrame, judgments: DataFrame) -> DataFrame:
    """Answers with their questions and, where there are, their judgments, one row a triple (of
    ``latest_answers``), with flags for scorable, empty and truncated."""
    q = stg_questions(questions)
    df = stg_answers(answers).join(q.select(*[c for c in _QUESTION if c in q.columns]), "question_id").join(stg_judgments(judgments), TRIPLE, "left")
    ok = F.col("status") == "ok"
    return df.withColumns(
        {"is_scorable": ok, "is_empty_answer": ok & (F.trim(F.coalesce("ai_answer", F.lit(""))) == ""), "is_truncated": F.col("finish_reason") == "maxPredictedTokensReached"}
    )
