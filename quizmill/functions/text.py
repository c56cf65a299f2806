"""Text functions: folding, normalising, unescaping, similarity.

Small Arrow helpers do what Spark has no function for: full case folding with decomposition,
HTML entities, and the token-set ratio (``similarity.py``). All else is built from Spark's functions.
"""

from __future__ import annotations

import ast
import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from .similarity import common_length, token_set_ratios

_ARTICLE = r"^(?:the|a|an) "


def _fold(text: str | None) -> str | None:
    if text is None or text.isascii():
        return text if text is None else text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


@F.pandas_udf(StringType())
def fold_text(texts: pd.Series) -> pd.Series:
    """Decompose (NFKD), drop combining marks, fold case."""
    return texts.map(_fold)


@F.pandas_udf(ArrayType(StringType()))
def fold_texts(lists: pd.Series) -> pd.Series:
    return lists.map(lambda xs: None if xs is None else [_fold(x) for x in xs])


@F.pandas_udf(StringType())
def casefold_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def _bare(folded: Column) -> Column:
    words = F.regexp_replace(folded, r"(?U)[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(words, r"(?U)\s+", " "))


def _without_article(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _ARTICLE, ""))


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def folded(text: Column) -> Column:
    """``fold_text``; only texts with other than ASCII characters go to the helper."""
    plain = _ascii(text)
    return F.when(plain, F.lower(text)).otherwise(fold_text(F.when(~plain, text)))


def casefolded(text: Column) -> Column:
    """Case folded; only texts with other than ASCII characters go to the helper."""
    plain = _ascii(text)
    return F.when(plain, F.lower(text)).otherwise(casefold_text(F.when(~plain, text)))


def normalize_answer(text: Column) -> Column:
    """A reference answer made comparable. Articles stay: see ``normalize``."""
    return F.coalesce(_bare(folded(text)), F.lit(""))


def normalize(text: Column) -> Column:
    """A given answer made comparable: like ``normalize_answer``, without one leading article."""
    return _without_article(normalize_answer(text))


def normalize_all(texts: Column) -> Column:
    """``normalize`` for each string of an array."""
    plain = F.forall(texts, lambda x: F.coalesce(_ascii(x), F.lit(True)))
    low = F.when(plain, F.transform(texts, F.lower)).otherwise(fold_texts(F.when(~plain, texts)))
    return F.transform(low, lambda x: F.coalesce(_without_article(_bare(x)), F.lit("")))


def _unescaped(text: str | None) -> str | None:
    if text is not None:
        for _ in range(3):
            if "&" not in text:
                break
            text = html.unescape(text)
    return text


@F.pandas_udf(StringType())
def html_unescape(texts: pd.Series) -> pd.Series:
    """Entities decoded, up to three times."""
    return texts.map(_unescaped)


@F.pandas_udf(ArrayType(StringType()))
def html_unescape_all(lists: pd.Series) -> pd.Series:
    """``html_unescape`` for each string of an array."""
    return lists.map(lambda xs: None if xs is None else [_unescaped(x) for x in xs])


def _collapsed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def unescape_text(text: Column) -> Column:
    """Entities decoded, blanks collapsed and trimmed; null is empty. Only texts with ``&`` go to the helper."""
    coded = text.contains("&")
    return F.coalesce(_collapsed(F.when(coded, html_unescape(F.when(coded, text))).otherwise(text)), F.lit(""))


#: The entities of markup, in the order in which they are decoded: ampersands may have been coded twice.
_MARKUP = (("&amp;", "&"), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&apos;", "'"))
_SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def unescape_markup(text: Column) -> Column:
    """Only whole entities of markup decoded, ASCII blanks collapsed, spaces trimmed; null stays null. For texts
    cut at a length: what a cut left of an entity (``&amp``) is text, which ``unescape_text`` would decode."""
    for entity, meant in _MARKUP:
        text = F.replace(text, F.lit(entity), F.lit(meant))
    return F.btrim(F.regexp_replace(text, r"[\t\n\f\r ]+", " "), F.lit(_SPACES))


def unescape_all(texts: Column) -> Column:
    """``unescape_text`` for each string of an array."""
    coded = F.exists(texts, lambda x: F.coalesce(x.contains("&"), F.lit(False)))
    decoded = F.when(coded, html_unescape_all(F.when(coded, texts))).otherwise(texts)
    return F.transform(decoded, lambda x: F.coalesce(_collapsed(x), F.lit("")))


def _literal(text: str | None) -> list[str | None] | None:
    if text is None:
        return None
    try:
        found = ast.literal_eval(text.strip())
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None
    return [None if x is None else str(x) for x in found] if isinstance(found, list) else None


@F.pandas_udf(ArrayType(StringType()))
def literal_list(texts: pd.Series) -> pd.Series:
    """Lists as Python writes them; null for what is none."""
    return texts.map(_literal)


def _ratio(a: int, b: int, shared: int) -> float:
    return 100.0 * 2 * shared / (a + b) if a + b else 100.0


def token_set_ratio(a: str | None, b: str | None) -> float:
    """Similarity from 0 to 100 of two texts as sets of words; 100 if one set holds the other."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (x <= y or y <= x):
        return 100.0
    common, left, right = (" ".join(sorted(s)) for s in (both, x - y, y - x))
    gap = 1 if common else 0
    n, p, q = len(common), len(common) + gap + len(left), len(common) + gap + len(right)
    best = _ratio(p, q, n + gap + common_length(left, right))
    if common:
        best = max(best, _ratio(n, p, n), _ratio(n, q, n))
    return best


@F.pandas_udf(DoubleType())
def fuzzy_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """``token_set_ratio``, a whole batch at once; 0 where a text is null."""
    score = pd.Series(0.0, index=a.index)
    given = a.notna() & b.notna()
    score[given] = token_set_ratios(a[given].tolist(), b[given].tolist())
    return score
