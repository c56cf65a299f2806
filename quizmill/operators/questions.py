"""From bronze to silver questions: cleaning, derived columns, order of the options."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.answers import is_numeric_answer
from ..functions.text import literal_list, normalize_all, normalize_answer, unescape_all, unescape_text
from ..schemas import QUESTIONS, conform
from .bronze import SEPARATOR, dedupe_questions


def drop_blank(df: DataFrame) -> DataFrame:
    return df.where((F.col("question") != "") & (F.col("correct_answer") != ""))


def split_category(category: Column) -> Column:
    """``group, name``: before and after the first colon; without one the group is General."""
    parts = F.split(category, ":", 2)
    both = F.size(parts) == 2
    return F.struct(F.when(both, F.trim(parts[0])).otherwise("General").alias("group"), F.when(both, F.trim(parts[1])).otherwise(F.trim(category)).alias("name"))


def parse_incorrect(text: Column) -> Column:
    """Wrong options from JSON text (a list, or strings with commas between) or a list as Python writes it; a
    bare value is one option, ``null`` an empty one. Entities are decoded option by option, after parsing: a ``&quot;`` must not end a JSON
    string. Only lists that aren't JSON go to a helper."""
    bare = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    listed = F.from_json(bare, "array<string>")
    quoted = F.from_json(F.concat(F.lit("["), bare, F.lit("]")), "array<string>")
    odd = bare.startswith("[") & (listed.isNull() | bare.contains("\\x"))
    options = (
        F.when(F.coalesce(bare, F.lit("")) == "", F.array().cast("array<string>"))
        .when(bare.startswith("["), F.coalesce(literal_list(F.when(odd, bare)), listed, F.array(text)))
        .when(bare.startswith('"'), F.coalesce(quoted, F.array(text)))
        .when(bare == "null", F.array(F.lit("")))
        .otherwise(F.array(text))
    )
    return unescape_all(options)


@F.pandas_udf(ArrayType(StringType()))
def _mersenne(ids: pd.Series, options: pd.Series) -> pd.Series:
    def one(qid: str, xs: list) -> list:
        xs = list(xs)
        random.Random(qid).shuffle(xs)
        return xs

    return pd.Series([one(q, x) for q, x in zip(ids, options, strict=True)])


def shuffled_choices(qid: Column, correct: Column, incorrect: Column, order: str = "sha2") -> Column:
    """All options once, in an order that the id fixes; ``order='mt'`` is a seeded Mersenne shuffle."""
    options = F.array_distinct(F.concat(F.array(correct), incorrect))
    if order == "mt":
        return _mersenne(qid, options)
    hashed = F.transform(options, lambda c: F.struct(F.sha2(F.concat(qid, F.lit(SEPARATOR), c), 256).alias("h"), c.alias("c")))
    return F.transform(F.array_sort(hashed), lambda x: x["c"])


def clean_questions(bronze: DataFrame, cleaned_at: Column, order: str = "sha2", unique: bool = True) -> DataFrame:
    """Silver questions, one row an id, with ``choices_norm`` besides, so that options are normalised
    once a question and not once an answer."""
    df = bronze.withColumns({c: unescape_text(F.col(c)) for c in ("category", "question", "correct_answer")})
    df = drop_blank(df.withColumn("incorrect_answers", parse_incorrect(F.col("incorrect_answers"))))
    if unique:
        by = [c for c in ("fetched_at", "batch_id", "pos", "question") if c in df.columns]
        df = dedupe_questions(df, tuple(by))
    df = df.withColumn("choices", shuffled_choices(F.col("question_id"), F.col("correct_answer"), F.col("incorrect_answers"), order))
    category = split_category(F.col("category"))
    df = df.withColumns(
        {
            "category_group": category["group"],
            "category_name": category["name"],
            "type": F.lower("type"),
            "difficulty": F.lower("difficulty"),
            "correct_answer_position": F.array_position("choices", F.col("correct_answer")) - 1,
            "n_choices": F.size("choices"),
            "correct_answer_norm": normalize_answer(F.col("correct_answer")),
            "choices_norm": normalize_all(F.col("choices")),
            "answer_is_numeric": is_numeric_answer(F.col("correct_answer")),
            "question_len": F.length("question"),
            "answer_len": F.length("correct_answer"),
            "cleaned_at": cleaned_at,
        }
    )
    return conform(df, StructType([*QUESTIONS.fields, StructField("choices_norm", ArrayType(StringType()))]))
