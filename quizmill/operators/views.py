"""Views of the marts for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prompts import VARIANTS

MEASURES = ["accuracy_strict", "accuracy_permissive", "accuracy_permissive_excl_empty"]


def accuracy_long(model_performance: DataFrame) -> DataFrame:
    return model_performance.unpivot(["model_slug", "model_name"], MEASURES, "measure", "accuracy")


def explore_questions(hardness: DataFrame, only_failed: bool = False, categories: list[str] | None = None, k: int | None = None) -> DataFrame:
    """Questions, hardest first; ``k`` gives the first ones only."""
    if only_failed:
        hardness = hardness.where("failed_by_everyone")
    if categories:
        hardness = hardness.where(F.col("category").isin(categories))
    hardness = hardness.orderBy(F.asc_nulls_last("success_rate"), "question_id")
    return hardness.limit(k) if k is not None else hardness


def category_gaps(by_category: DataFrame) -> DataFrame:
    return by_category.orderBy(F.asc_nulls_last("delta_to_model_average"), "model_slug", "category")


def _answers_with(impact: DataFrame, method: str) -> DataFrame:
    return impact.where(F.col("match_method") == method).groupBy("model_slug").agg(F.sum("n_answers").alias("n_answers"))


def leaked_letters(impact: DataFrame) -> DataFrame:
    """Letters given where no letter was asked for."""
    return _answers_with(impact.where("mode = 'open'"), "choice_letter")


def failed_arbitrations(impact: DataFrame) -> DataFrame:
    return _answers_with(impact, "llm_judge_failed")


def position_labels(bias: DataFrame) -> DataFrame:
    label = F.coalesce(F.col("chosen_position").cast("string"), F.lit("unresolved"))
    return bias.withColumn("position_label", label).orderBy("model_slug", "n_choices", F.asc_nulls_last("chosen_position"))


def unresolved_positions(bias: DataFrame) -> DataFrame:
    return bias.where("chosen_position is null").agg(F.coalesce(F.sum("n_chosen"), F.lit(0)).alias("n_unresolved"))


def reliability(model_performance: DataFrame, errors: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    kept = model_performance.agg(total("n_empty").alias("n_empty"), total("n_truncated").alias("n_truncated"))
    return kept.crossJoin(errors.agg(total("n_errors").alias("n_transport_errors")))  # one row each


def hosts(latency: DataFrame) -> DataFrame:
    return latency.select("host").distinct()


def latency_for_host(latency: DataFrame, host: str) -> DataFrame:
    return latency.where(F.col("host") == host)


def prompt_gaps(prompt_performance: DataFrame) -> DataFrame:
    """Per model: recognising against recalling (p1 - p3), effect of guidance (p2 - p3), and what
    leniency adds over all variants."""
    wide = prompt_performance.groupBy("model_slug").pivot("prompt_variant", list(VARIANTS)).agg(F.first("accuracy_permissive"))
    lenient = prompt_performance.groupBy("model_slug").agg((F.avg("accuracy_permissive") - F.avg("accuracy_strict")).alias("permissive_minus_strict"))
    p1, p2, p3 = (F.col(v) for v in VARIANTS)
    return wide.select("model_slug", (p1 - p3).alias("p1_minus_p3"), (p2 - p3).alias("p2_minus_p3")).join(lenient, "model_slug")


def difficulty_pivot(results: DataFrame, levels: tuple[str, ...] = ("easy", "medium", "hard")) -> DataFrame:
    return results.where("is_scorable").groupBy("model_slug").pivot("difficulty", list(levels)).agg(F.avg(F.col("ai_correct").cast("int")))


def category_overall(results: DataFrame) -> DataFrame:
    return results.where("is_scorable").groupBy("category").agg(F.count("*").alias("n_answers"), F.avg(F.col("ai_correct").cast("int")).alias("accuracy_permissive"))
