"""Columns that read a model's reply and compare it with the options."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normalize

# Fixed values, down to FINISH_REASONS: words that are read as a verdict, forms of a reference to an
# option and of a reply, the mark at the end of reasoning, and names of finish reasons.
TRUE_WORDS = ["true", "yes", "y", "t", "1", "vrai", "oui"]
FALSE_WORDS = ["false", "no", "n", "f", "0", "faux", "non"]
REFERENCE_PREFIX = r"(?:(?:the\s+)?(?:answer|option|choice|number|réponse)\s*(?:is\s*)?[:.\-]?\s*)?"
LONGEST_REFERENCE = 32
ANSWER_PREFIX = r"^(answer|réponse)\s*[:\-]\s*"
QUOTES = r"[\"'`«»\s]+"
REASONING_END = r"__LM_STUDIO_INTERNAL_LSEP_[A-Z_]*REASONING_END_[0-9a-f]+__"
FINISH_REASONS = {"stop": "eosFound", "length": "maxPredictedTokensReached"}

_COMPLETION = (
    "struct<choices: array<struct<message: struct<content: string>, finish_reason: string>>, "
    "usage: struct<prompt_tokens: double, completion_tokens: double>>"
)


#: All decimal digits of Unicode and the ASCII digits they stand for.
_DIGITS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
_AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_completion(payload: Column) -> Column:
    """``text, prompt_tokens, completion_tokens, finish_reason`` of a completion as JSON text; null for
    one without choices, see ``completion_error``."""
    p = F.from_json(payload, _COMPLETION)
    first = F.try_element_at(p["choices"], F.lit(1))
    finish = F.coalesce(first["finish_reason"], F.lit(""))
    named = finish
    for given, ours in FINISH_REASONS.items():
        named = F.when(finish == given, ours).otherwise(named)
    found = F.struct(
        F.coalesce(first["message"]["content"], F.lit("")).alias("text"),
        p["usage"]["prompt_tokens"].cast("long").alias("prompt_tokens"),
        p["usage"]["completion_tokens"].cast("long").alias("completion_tokens"),
        named.alias("finish_reason"),
    )
    return F.when(F.coalesce(F.size(p["choices"]), F.lit(0)) > 0, found)


def completion_error(payload: Column) -> Column:
    """Why ``parse_completion`` gives nothing, with the begin of the payload; null where it does."""
    choices = F.from_json(payload, _COMPLETION)["choices"]
    return F.when(F.coalesce(F.size(choices), F.lit(0)) <= 0, F.concat(F.lit("a completion without choices: "), F.substring(F.coalesce(payload, F.lit("")), 1, 200)))


def strip_reasoning(text: Column) -> Column:
    """What follows the thinking, in either form."""
    return F.element_at(F.split(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""), REASONING_END), -1)


def clean_answer(text: Column) -> Column:
    """The bare answer: first line after the thinking, without prefix, wrapping quotes and one last dot."""
    line = _strip(F.split(_strip(strip_reasoning(text)), "\n")[0])
    line = F.regexp_replace(line, f"(?iuU){ANSWER_PREFIX}", "")
    line = F.regexp_replace(line, f"(?U)^{QUOTES}|{QUOTES}$", "")
    line = F.when(line.endswith(".") & ~line.endswith(".."), F.regexp_replace(line, r"\.\z", "")).otherwise(line)
    return F.coalesce(_strip(line), F.lit(""))


def boolean_of(norm: Column) -> Column:
    """Truth value that a normalised answer, or its first word, names; else null."""
    first = F.split(norm, " ")[0]
    return F.when(norm.isin(TRUE_WORDS), True).when(norm.isin(FALSE_WORDS), False).when(first.isin(TRUE_WORDS), True).when(first.isin(FALSE_WORDS), False)


def boolean_label(text: Column) -> Column:
    return boolean_of(normalize(text))


def resolve_choice_reference(answer: Column, choices: Column, ranks: Column | None = None) -> Column:
    """The option that the answer names by letter or rank; else null. Where ``ranks`` is false, only letters count."""
    given = _strip(answer)
    letter = F.regexp_extract(given, rf"(?iuU)^{REFERENCE_PREFIX}\(?([a-z])\)?[.):]?\z", 1)
    rank = F.regexp_extract(given, rf"(?iuU)^{REFERENCE_PREFIX}\(?(\d{{1,2}})\)?[.):]?\z", 1)
    by_letter = F.get(choices, F.ascii(F.lower(letter)) - 97)
    by_rank = F.get(choices, F.try_to_number(F.translate(rank, _DIGITS, _AS_ASCII), F.lit("99")).cast("int") - 1)
    if ranks is not None:
        by_rank = F.when(ranks, by_rank)
    return F.when(F.length(given) > LONGEST_REFERENCE, None).when(letter != "", by_letter).when(rank != "", by_rank)


def resolve_guarded(answer: Column, choices: Column, answer_is_numeric: Column) -> Column:
    """Like ``resolve_choice_reference``, but a digit given to a numeric question is no rank."""
    numeric_reply = F.coalesce(answer_is_numeric, F.lit(False)) & answer.rlike(r"(?U)\d")
    return F.when(~numeric_reply, resolve_choice_reference(answer, choices))


def matches_single_choice(answer_norm: Column, choices: Column, choices_norm: Column) -> Column:
    """The one option whose normal form is ``answer_norm``; null for none or several."""
    hits = F.filter(F.arrays_zip(choices.alias("c"), choices_norm.alias("n")), lambda x: x["n"] == answer_norm)
    return F.when(F.size(hits) == 1, hits[0]["c"])


def is_numeric_answer(text: Column) -> Column:
    """Whether there is a digit, of any script, and nothing but digits, blanks and ``. , % / + -``."""
    return F.trim(text).rlike(r"(?U)^(?=.*\d)[\d\s.,%/+-]+$")
