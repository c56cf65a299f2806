"""Schemas of the tables, and casting to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType())}


def _schema(columns: str) -> T.StructType:
    """A schema from ``name type, name type``; it needs no session, unlike DDL."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


_RESULT = _schema("type string, difficulty string, category string, question string, correct_answer string, incorrect_answers array<string>")
RESPONSES = T.StructType(
    [*_schema("batch_id string, category_id long"), T.StructField("payload", T.StructType([*_schema("response_code long"), T.StructField("results", T.ArrayType(_RESULT))]))]
)
BRONZE = _schema("question_id string, category string, type string, difficulty string, question string, correct_answer string, incorrect_answers string, fetched_at string, batch_id string")
QUESTIONS = _schema(
    "question_id string, category string, category_group string, category_name string, type string, difficulty string, question string, correct_answer string, "
    "incorrect_answers array<string>, choices array<string>, correct_answer_position long, n_choices long, correct_answer_norm string, answer_is_numeric boolean, "
    "question_len long, answer_len long, cleaned_at string"
)
ANSWERS = _schema(
    "question_id string, model_slug string, prompt_variant string, model_name string, prompt_hash string, prompt_text string, raw_answer string, ai_answer string, "
    "response_time double, prompt_tokens long, completion_tokens long, finish_reason string, status string, error string, attempt long, is_warmup boolean, answered_at string, "
    "run_id string, host string, hardware string, os_version string, python_version string, runtime_version string, temperature double, max_tokens long"
)
JUDGMENTS = _schema(
    "question_id string, model_slug string, prompt_variant string, ai_answer_norm string, match_method string, ai_correct_strict boolean, ai_correct boolean, "
    "fuzzy_score double, judge_model string, judgment_version string, judged_at string"
)
TRIPLE = ["question_id", "model_slug", "prompt_variant"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, cast to its types; columns that ``df`` lacks are null. A partition in
    which a column is null throughout keeps the column's type."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
