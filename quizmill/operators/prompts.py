"""Prompts of the three variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bronze import SEPARATOR

# The variants' system prompts.
SYSTEM_PROMPTS = {
    "p1_constrained_mcq": (
        "You are a trivia answering engine. Every question comes with lettered options. "
        "Reply with the letter of the correct option and nothing else. "
        "No explanation, no option text, no extra punctuation, no markdown, no quotes."
    ),
    "p2_open_minimal": "You are a trivia answering engine. Answer with the answer only.",
    "p3_open_guided": (
        "You are a trivia answering engine. Reply with the shortest exact answer and nothing else. "
        "No explanation, no reasoning, no full sentence, no leading article, no trailing period, no markdown, no quotes. "
        "For a person, give the full name. For a date, give the year only unless the question asks otherwise. "
        "For a true/false statement, reply True or False."
    ),
}
# The lines of the user prompts; the fingerprints depend on them.
QUESTION_LINE, CATEGORY_LINE, DIFFICULTY_LINE, OPTIONS_LINE, ANSWER_LINE = "Question: ", "Category: ", "\nDifficulty: ", "Options:\n", "\nAnswer:"
LETTER_WANTED, EITHER_WANTED = "\nReply with the letter of the correct option.", "\nAnswer True or False."
WORD_WANTED, EXACT_WANTED = "Reply with exactly one word: True or False.", "Reply with the exact answer only, no sentence, no explanation."
VARIANTS = tuple(SYSTEM_PROMPTS)


def mode(variant: Column) -> Column:
    return F.when(variant == VARIANTS[0], "constrained").otherwise("open")


def lettered_options(choices: Column) -> Column:
    """``A. first`` and so on, a line each; none or more than 26 options raise an error."""
    lines = F.transform(choices, lambda x, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), x))
    return F.when(F.size(choices).between(1, 26), F.array_join(lines, "\n")).otherwise(F.raise_error(F.lit("a question has 1 to 26 options")).cast("string"))


def render_prompt(variant: Column, question: Column, category: Column, difficulty: Column, kind: Column, choices: Column) -> Column:
    """The user prompt of a variant; another name raises an error."""
    lit, boolean = F.lit, kind == "boolean"
    asked = F.concat(lit(QUESTION_LINE), question)
    about = F.concat(lit(CATEGORY_LINE), category, lit(DIFFICULTY_LINE), difficulty, lit("\n"), asked, lit("\n"))
    constrained = F.concat(about, lit(OPTIONS_LINE), lettered_options(choices), lit(LETTER_WANTED + ANSWER_LINE))
    minimal = F.concat(asked, F.when(boolean, EITHER_WANTED).otherwise(""), lit(ANSWER_LINE))
    guided = F.concat(about, F.when(boolean, WORD_WANTED).otherwise(EXACT_WANTED), lit(ANSWER_LINE))
    return F.when(variant == VARIANTS[0], constrained).when(variant == VARIANTS[1], minimal).when(variant == VARIANTS[2], guided).otherwise(F.raise_error(F.concat(lit("no variant "), variant)).cast("string"))


def render(questions: DataFrame, variant: str = "prompt_variant") -> Column:
    return render_prompt(F.col(variant), F.col("question"), F.col("category"), F.col("difficulty"), F.col("type"), F.col("choices"))


def prompt_hashes(spark: SparkSession, variants: tuple[str, ...] = VARIANTS) -> DataFrame:
    """``prompt_variant, prompt_hash``: 12 hex digits over the system prompt and two probe renderings."""
    table = spark.createDataFrame([(v, SYSTEM_PROMPTS[v]) for v in variants], "prompt_variant string, system string")

    def probe(kind: str, options: list[str]) -> Column:
        return render_prompt(F.col("prompt_variant"), F.lit("<probe>"), F.lit("<category>"), F.lit("<difficulty>"), F.lit(kind), F.array(*map(F.lit, options)))

    whole = F.concat_ws(SEPARATOR, "system", probe("multiple", ["<a>", "<b>"]), probe("boolean", ["True", "False"]))
    return table.select("prompt_variant", F.substring(F.sha2(whole, 256), 1, 12).alias("prompt_hash"))


def expand_variants(questions: DataFrame, variants: tuple[str, ...] = VARIANTS) -> DataFrame:
    """Each question once for each variant: an array of a few names exploded, without a join."""
    unknown = set(variants) - set(VARIANTS)
    if unknown:
        raise ValueError(f"no variants {sorted(unknown)}")
    return questions.withColumn("prompt_variant", F.explode(F.array(*map(F.lit, variants))))


def model_slug(name: Column) -> Column:
    """A name as a safe part of a path; one that leaves nothing usable raises an error."""
    slug = F.btrim(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.when(slug.isin("", ".", ".."), F.raise_error(F.concat(F.lit("no usable name: "), name)).cast("string")).otherwise(slug)
