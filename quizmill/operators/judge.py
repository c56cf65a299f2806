"""The judging cascade."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import boolean_of, matches_single_choice, resolve_guarded
from ..functions.text import fuzzy_score, normalize
from ..schemas import JUDGMENTS, TRIPLE, conform
from ..sources.scratch import fresh_path
from .verdicts import PAIR, ask_new, one_verdict, pair_key

# Methods that the strict verdict counts, the threshold, and what the arbiter is told and says.
STRICT = ["boolean", "exact", "choice_letter", "choice_match"]
THRESHOLD = 90.0
ARBITER_METHODS = {"yes": "llm_judge", "no": "llm_judge_rejected", "failed": "llm_judge_failed"}
ARBITER_SYSTEM = "You decide whether a candidate answer means the same as the reference answer for a trivia question. Reply with exactly one word: YES or NO."
ARBITER_QUESTION = ("Question: ", "\nReference answer: ", "\nCandidate answer: ", "\nDoes the candidate answer mean the same as the reference answer? YES or NO.")
_QUESTION = ["question_id", "type", "correct_answer_norm", "choices", "choices_norm", "answer_is_numeric"]


def judge_input(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers with what the cascade needs of their questions; an answer without its question raises
    an error. Run ``latest_answers`` first, or a repeated triple is judged twice."""
    need = questions.select(*_QUESTION, F.lit(True).alias("_known"))
    lost = F.raise_error(F.concat(F.lit("no question "), F.col("question_id"))).cast("boolean")
    return answers.join(need, "question_id", "left").where(F.coalesce("_known", lost)).drop("_known")


def judge(df: DataFrame, strip_reference_articles: bool = False) -> DataFrame:
    """``df`` with ``ai_answer_norm, match_method, ai_correct, ai_correct_strict, fuzzy_score``; the
    first stage that concludes wins. ``match_method`` is ``undecided`` where none does.

    References keep their articles and answers lose them, as published results do;
    ``strip_reference_articles`` takes both alike. The similarity, a helper in Python, gets only the
    rows that the built-in stages leave: for the others its inputs are null."""
    expected = F.col("correct_answer_norm")
    if strip_reference_articles:
        expected = F.trim(F.regexp_replace(expected, "^(?:the|a|an) ", ""))
    given = F.coalesce("ai_answer", F.lit(""))
    df = df.withColumn("ai_answer_norm", F.when(F.col("status") != "ok", "").otherwise(normalize(given)))
    norm = F.col("ai_answer_norm")
    wanted = boolean_of(F.trim(F.regexp_replace("correct_answer_norm", "^(?:the|a|an) ", "")))
    df = df.withColumns(
        {
            "_truth": F.when(wanted.isNotNull(), boolean_of(norm)),
            "_named": resolve_guarded(given, F.col("choices"), F.col("answer_is_numeric")),
            "_same": matches_single_choice(norm, F.col("choices"), F.col("choices_norm")),
        }
    )
    norm_of = lambda c: F.get("choices_norm", (F.array_position("choices", F.col(c)) - 1).cast("int"))
    stage = (
        F.when(F.col("status") != "ok", "error")
        .when(norm == "", "no_match")
        .when((F.col("type") == "boolean") & F.col("_truth").isNotNull(), "boolean")
        .when(norm == expected, "exact")
        .when(F.col("_named").isNotNull(), "choice_letter")
        .when(F.col("_same").isNotNull(), "choice_match")
    )
    df = df.withColumn("_stage", stage)
    open_row = F.col("_stage").isNull()
    df = df.withColumn("_score", fuzzy_score(F.when(open_row, norm), F.when(open_row, expected)))
    fuzzy = open_row & (F.col("_score") >= THRESHOLD) & ~F.coalesce("answer_is_numeric", F.lit(False))
    df = df.withColumn("match_method", F.when(fuzzy, "fuzzy").otherwise(F.coalesce("_stage", F.lit("undecided"))))
    method = F.col("match_method")
    correct = (
        F.when(method == "boolean", F.col("_truth") == wanted)
        .when(method.isin("exact", "fuzzy"), True)
        .when(method == "choice_letter", norm_of("_named") == expected)
        .when(method == "choice_match", norm_of("_same") == expected)
        .when(method == "no_match", False)
    )
    df = df.withColumn("ai_correct", correct)
    df = df.withColumn("ai_correct_strict", strict(method, F.col("ai_correct")))
    df = df.withColumn("fuzzy_score", F.when(method == "exact", 100.0).when(open_row, F.col("_score")).otherwise(0.0))
    return df.drop("_truth", "_named", "_same", "_stage", "_score")


def strict(method: Column, correct: Column) -> Column:
    """The verdict where the method is strict; null where there is none to give."""
    return F.when(method == "error", None).when(method.isin(STRICT), correct).otherwise(False)


def judge_prompt(question: Column, expected: Column, given: Column) -> Column:
    first, second, third, last = map(F.lit, ARBITER_QUESTION)
    return F.concat(first, question, second, expected, third, given, last)


def parse_verdict(text: Column, status: Column, finish_reason: Column) -> Column:
    """``yes``, ``no`` or ``failed`` from an arbiter's reply."""
    word = F.split(normalize(text), " ")[0]
    readable = (status == "ok") & (F.coalesce(finish_reason, F.lit("")) != "maxPredictedTokensReached") & word.isin("yes", "no")
    return F.when(readable, word).otherwise("failed")


def arbitrate(judged: DataFrame, verdict_source: DataFrame | Callable | None = None, concurrency: int | None = None, kept: str | None = None, asked_of: str = "", retry_failed: bool = False) -> DataFrame:
    """Settle the ``undecided`` rows: by a table ``question_id, ai_answer, verdict`` (of a pair's verdicts
    ``one_verdict`` chooses), by a function from (question id, answer) that is called for each distinct
    pair, or, without either, as ``no_match``. With ``kept``, a path, the function's verdicts are looked up
    there, and only new pairs are asked; ``asked_of`` names the arbiter whose verdicts they are."""
    if verdict_source is None:
        verdict = F.lit(None).cast("string")
        rest = judged
    else:
        key = pair_key(*map(F.col, PAIR), asked_of)
        if isinstance(verdict_source, DataFrame):
            table = one_verdict(verdict_source.withColumn("pair_key", key))
        else:
            asked = judged.where("match_method = 'undecided'")
            path = kept or fresh_path(judged.sparkSession, "verdicts")
            table = ask_new(asked, verdict_source, path, asked_of, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS"), concurrency, retry_failed)
        rest = judged.withColumn("_pair", key)  # of decided rows too: nulls would all meet in one task
        rest = rest.join(table.withColumnRenamed("pair_key", "_pair"), "_pair", "left")
        verdict = F.coalesce("verdict", F.lit("failed"))
    undecided = F.col("match_method") == "undecided"
    method = F.lit("no_match")
    for word, name in ARBITER_METHODS.items():
        method = F.when(verdict == word, name).otherwise(method)
    rest = rest.withColumn("_method", F.when(undecided, method).otherwise(F.col("match_method")))
    rest = rest.withColumn("ai_correct", F.when(undecided, F.coalesce(F.col("_method") == "llm_judge", F.lit(False))).otherwise(F.col("ai_correct")))
    rest = rest.withColumn("match_method", F.col("_method")).withColumn("ai_correct_strict", strict(F.col("_method"), F.col("ai_correct")))
    return rest.select(*judged.columns)


def run_judge(answers: DataFrame, questions: DataFrame, judge_model: str, version: str, judged_at: Column, model_slug: str | None = None, verdict_source: DataFrame | Callable | None = None, kept: str | None = None, retry_failed: bool = False) -> DataFrame:
    """The judgment table of all answers, or of one model's. ``kept``: where verdicts of this judge and
    version are looked up and added."""
    if model_slug is not None:
        answers = answers.where(F.col("model_slug") == model_slug)
    judged = arbitrate(judge(judge_input(answers, questions)), verdict_source, kept=kept, asked_of=f"{judge_model}/{version}", retry_failed=retry_failed)
    return conform(judged.withColumns({"judge_model": F.lit(judge_model), "judgment_version": F.lit(version), "judged_at": judged_at}).select(*TRIPLE, *[c for c in JUDGMENTS.names if c not in TRIPLE]), JUDGMENTS)
