"""The nine marts. All aggregates combine before the shuffle, so few large groups are no hot spots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .facts import stg_questions
from .percentiles import ranged_percentiles, same
from .prompts import VARIANTS, mode


def _rate(c: str) -> Column:
    return F.avg(F.col(c).cast("int"))


def _accuracies() -> list[Column]:
    return [
        _rate("ai_correct_strict").alias("accuracy_strict"),
        _rate("ai_correct").alias("accuracy_permissive"),
        F.avg(F.when(~F.col("is_empty_answer"), F.col("ai_correct").cast("int"))).alias("accuracy_permissive_excl_empty"),
    ]


MEDIAN, P95 = {"response_time_median": 0.5}, {"response_time_p95": 0.95}


def _times(x: Column, shares: dict[str, float], how: str) -> list[Column]:
    """Percentiles of times, which have 4 decimals: an exact one keeps one count a distinct time, however many
    rows. ``how``: ``exact``, ``approx``, or ``ranged``, exact too, for more distinct times than a task
    should hold (see ``_in_place``)."""
    x = F.round(x, 4)
    of = {"exact": lambda p: F.percentile(x, F.lit(p)), "approx": lambda p: F.percentile_approx(x, p, 10_000).cast("double"), "ranged": lambda p: F.lit(None).cast("double")}[how]
    return [of(p).alias(name) for name, p in shares.items()]


def _in_place(mart: DataFrame, rows: DataFrame, keys: list[str], x: Column, shares: dict[str, float], how: str) -> DataFrame:
    if how != "ranged":
        return mart
    found = ranged_percentiles(rows, keys, F.round(x, 4), shares)
    return mart.join(found, same(mart, found, keys), "left").select(*[found[c] if c in shares else mart[c] for c in mart.columns])


def _scorable(results: DataFrame) -> DataFrame:
    return results.where("is_scorable")


def mart_model_performance(results: DataFrame, how: str = "exact") -> DataFrame:
    s = F.col("is_scorable")
    warm = F.when(s & ~F.col("is_warmup"), F.col("response_time"))
    only = lambda c: F.when(s, F.col(c).cast("int"))
    keys = ["model_slug", "model_name"]
    mart = results.groupBy(*keys).agg(
        F.count("*").alias("n_total"),
        F.count_if(s).alias("n_scorable"),
        F.count_if(~s).alias("n_errors"),
        F.count_if(s & F.col("ai_correct").isNotNull()).alias("n_judged"),
        F.count_if(s & F.col("is_empty_answer")).alias("n_empty"),
        F.count_if(s & F.col("is_truncated")).alias("n_truncated"),
        F.avg(only("ai_correct_strict")).alias("accuracy_strict"),
        F.avg(only("ai_correct")).alias("accuracy_permissive"),
        F.avg(F.when(s & ~F.col("is_empty_answer"), F.col("ai_correct").cast("int"))).alias("accuracy_permissive_excl_empty"),
        *_times(warm, MEDIAN | P95, how),
        F.avg(F.when(s, F.col("completion_tokens"))).alias("completion_tokens_avg"),
    )
    return _in_place(mart, results, keys, warm, MEDIAN | P95, how)


def mart_performance_by_category(results: DataFrame) -> DataFrame:
    rows = _scorable(results)
    own = rows.groupBy("model_slug", "category", "category_group", "category_name").agg(F.count("*").alias("n_questions"), F.count_if("is_empty_answer").alias("n_empty"), *_accuracies())
    model = rows.groupBy("model_slug").agg(_rate("ai_correct").alias("_mean"))
    return own.join(model, "model_slug").withColumn("delta_to_model_average", F.col("accuracy_permissive") - F.col("_mean")).drop("_mean")


def mart_performance_by_difficulty(results: DataFrame, how: str = "exact") -> DataFrame:
    warm = F.when(~F.col("is_warmup"), F.col("response_time"))
    keys, rows = ["model_slug", "prompt_variant", "difficulty", "question_type"], _scorable(results)
    mart = rows.groupBy(*keys).agg(F.count("*").alias("n_questions"), F.count_if("is_empty_answer").alias("n_empty"), *_accuracies(), *_times(warm, MEDIAN, how))
    return _in_place(mart, rows, keys, warm, MEDIAN, how)


def mart_prompt_performance(results: DataFrame, how: str = "exact") -> DataFrame:
    warm = F.when(~F.col("is_warmup"), F.col("response_time"))
    keys, rows = ["model_slug", "prompt_variant"], _scorable(results)
    mart = rows.groupBy(*keys).agg(
        mode(F.first("prompt_variant")).alias("mode"),
        F.count("*").alias("n_questions"),
        F.count_if("is_empty_answer").alias("n_empty"),
        F.count_if("is_truncated").alias("n_truncated"),
        *_accuracies(),
        F.avg(F.length("ai_answer")).alias("answer_len_avg"),
        F.avg("completion_tokens").alias("completion_tokens_avg"),
        *_times(warm, MEDIAN, how),
    )
    return _in_place(mart, rows, keys, warm, MEDIAN, how)


def mart_latency(results: DataFrame, how: str = "exact") -> DataFrame:
    t = F.col("response_time")
    keys, rows = ["model_slug", "host", "hardware", "prompt_variant"], _scorable(results).where("not is_warmup")
    mart = rows.groupBy(*keys).agg(
        F.count("*").alias("n_questions"),
        F.avg(t).alias("response_time_avg"),
        *_times(t, MEDIAN | P95, how),
        (F.sum("completion_tokens") / F.nullif(F.sum(t), F.lit(0.0))).alias("tokens_per_second"),
    )
    return _in_place(mart, rows, keys, t, MEDIAN | P95, how)


def mart_question_hardness(results: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """Grouped by the id alone, which determines the other attributes: they are joined back from
    ``questions`` where given, and are those of any row of the group else."""
    right = F.count_if("ai_correct")
    attributes = ["question", "category", "difficulty", "question_type", "correct_answer"]
    counts = _scorable(results).groupBy("question_id").agg(
        *([F.first(c).alias(c) for c in attributes] if questions is None else []),
        F.count("*").alias("n_attempts"),
        F.count("ai_correct").alias("n_judged"),
        right.alias("n_correct"),
        F.count_if("is_empty_answer").alias("n_empty"),
        _rate("ai_correct").alias("success_rate"),
        (right == 0).alias("failed_by_everyone"),
    )
    return counts if questions is None else counts.join(stg_questions(questions).select("question_id", *attributes), "question_id")


def mart_matching_impact(results: DataFrame) -> DataFrame:
    rows = _scorable(results).withColumn("match_method", F.coalesce("match_method", F.lit("unjudged")))
    counts = rows.groupBy("model_slug", "prompt_variant", "match_method").agg(
        F.count("*").alias("n_answers"), _rate("ai_correct").alias("accuracy_permissive"), _rate("ai_correct_strict").alias("accuracy_strict"), F.avg("fuzzy_score").alias("fuzzy_score_avg")
    )
    total = F.sum("n_answers").over(Window.partitionBy("model_slug", "prompt_variant"))
    return counts.withColumn("mode", mode(F.col("prompt_variant"))).withColumn("share", F.col("n_answers").cast("double") / total)


def mart_position_bias(results: DataFrame, questions: DataFrame) -> DataFrame:
    """Which position models choose on the constrained variant; unresolved choices stay as null."""
    p1 = _scorable(results).where(F.col("prompt_variant") == VARIANTS[0]).join(questions.select("question_id", "choices"), "question_id")
    norm = F.coalesce("ai_answer_norm", F.lit(""))
    raw = F.when(norm.rlike(r"^[a-z]\z"), F.ascii(norm) - 97).otherwise(F.array_position("choices", F.col("ai_answer")) - 1)
    p1 = p1.withColumn("_raw", raw).withColumn("chosen_position", F.when(F.col("_raw").between(0, F.col("n_choices") - 1), F.col("_raw")).cast("long"))
    counts = p1.groupBy("model_slug", "n_choices", "chosen_position").agg(F.count("*").alias("n_chosen"), F.count_if(F.col("chosen_position") == F.col("correct_answer_position")).alias("n_correct_at_position"))
    return counts.withColumn("chosen_share", F.col("n_chosen").cast("double") / F.sum("n_chosen").over(Window.partitionBy("model_slug", "n_choices")))


def mart_errors(results: DataFrame) -> DataFrame:
    return results.where("not is_scorable").groupBy("model_slug", "prompt_variant", "host", "run_id").agg(F.count("*").alias("n_errors"), F.min("answered_at").alias("first_error_at"), F.max("answered_at").alias("last_error_at"))
