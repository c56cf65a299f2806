import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from quizmill.functions import answers as A
from quizmill.functions.text import fuzzy_score, normalize, normalize_all, normalize_answer, token_set_ratio, unescape_all, unescape_text
from quizmill.operators.bronze import decode_field, question_id


def values(spark, texts, column):
    """The column for each text, in the texts' order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[1] for r in sorted(df.select("i", column).collect(), key=lambda r: r[0])]


def test_normalize(spark):
    given = ["  Zoë  van  Dijk ", "The Kinks", "Salt & Vinegar!", None, "AN Ant", "straße, Öl", "x_y-z", "日本　語", "the", "\t"]
    assert values(spark, given, normalize(F.col("x"))) == ["zoe van dijk", "kinks", "salt vinegar", "", "ant", "strasse ol", "x_y z", "日本 語", "the", ""]
    assert values(spark, ["The Kinks"], normalize_answer(F.col("x"))) == ["the kinks"]
    assert values(spark, ["q"], normalize_all(F.array(F.lit("The Öl"), F.lit(None), F.lit("PLAIN")))) == [["ol", "", "plain"]]
    assert values(spark, ["q"], normalize_all(F.array(F.lit("An Ant"), F.lit("PLAIN")))) == [["ant", "plain"]]


def test_boolean_label(spark):
    given = ["True.", "FALSE", "oui", "n", "Faux!", "perhaps", "no, never", "1", "y t", None, ""]
    assert values(spark, given, A.boolean_label(F.col("x"))) == [True, False, True, False, False, None, False, True, True, None, None]


def test_references(spark):
    options = F.array(F.lit("ash"), F.lit("birch"), F.lit("cedar"))
    second = ["b", " B ", "B)", "(b).", "choice: b", "réponse b", "RÉPONSE: 2", "the option is B", "2", "(2):", "number 2", "٢", "02"]
    other = ["Z", "0", "٩٩", "birch", "y" * 33, "b c", "", None]
    assert values(spark, second + other, A.resolve_choice_reference(F.col("x"), options)) == ["birch"] * len(second) + [None] * len(other)


def test_numeric_answers(spark):
    given = ["1815", "3.5 %", "١٩٨٩", "12\u00a0000", "-4", "%", "", "12 apples", "१२", "1/2"]
    assert values(spark, given, A.is_numeric_answer(F.col("x"))) == [True, True, True, True, True, False, False, False, True, True]


def plain_ratio(a, b):
    """The token-set ratio from its definition, with a table for common subsequences."""

    def ratio(x, y):
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, j in product(range(len(x)), range(len(y))):
            best[i + 1][j + 1] = best[i][j] + 1 if x[i] == y[j] else max(best[i][j + 1], best[i + 1][j])
        return 200.0 * best[-1][-1] / (len(x) + len(y)) if x or y else 100.0

    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    if x & y and not (x - y and y - x):
        return 100.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    one, two = (" ".join(p for p in (both, rest) if p) for rest in (left, right))
    return max([ratio(one, two)] + ([ratio(both, one), ratio(both, two)] if both else []))


def test_similarity(spark):
    assert token_set_ratio("maria sklodowska curie", "curie maria") == token_set_ratio("red blue", "blue red") == 100
    assert token_set_ratio("1812", "1821") == 75 and token_set_ratio("", "x") == token_set_ratio(None, None) == 0
    draw = random.Random(4)
    text = lambda: " ".join("".join(draw.choices("abcé日", k=draw.randint(1, 5))) for _ in range(draw.randint(0, 5)))
    pairs = [(text(), text()) for _ in range(400)] + [(None, "a"), ("a", None), ("a a b", "b a")]
    assert all(token_set_ratio(a, b) == pytest.approx(plain_ratio(a, b)) == pytest.approx(token_set_ratio(b, a)) for a, b in pairs)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    assert [r[1] for r in sorted(df.select("i", fuzzy_score(F.col("a"), F.col("b"))).collect())] == pytest.approx([plain_ratio(*p) for p in pairs])


def test_cleaning(spark):
    given = ["<think>hm</think>\nOslo", "réponse - Oslo", "'«Ada Lovelace.»'", "one\ntwo", "wait..", None, "<THINK>a\nb</THINK> Answer: x.", "Answer Oslo"]
    assert values(spark, given, A.clean_answer(F.col("x"))) == ["Oslo", "Oslo", "Ada Lovelace", "one", "wait..", "", "x", "Answer Oslo"]
    coded = ["Who wrote &quot;Emma&quot;?", "Salt &amp;amp; Vinegar", None, "no entity", " a&nbsp; b\n"]
    assert values(spark, coded, unescape_text(F.col("x"))) == ['Who wrote "Emma"?', "Salt & Vinegar", "", "no entity", "a b"]
    assert values(spark, ["q"], unescape_all(F.array(F.lit("a &lt; b"), F.lit(None), F.lit(" c ")))) == [["a < b", "", "c"]]


def test_completions(spark):
    given = [
        '{"choices": [{"message": {"content": "Oslo"}, "finish_reason": "stop"}], "usage": {"prompt_tokens": 7, "completion_tokens": 2.0}}',
        '{"choices": [{"message": {}, "finish_reason": "length"}]}',
        '{"choices": [{"message": {"content": null}, "finish_reason": "tool"}, {"message": {"content": "second"}}], "usage": {}}',
        '{"choices": []}',
        "not json",
        None,
    ]
    parsed = values(spark, given, A.parse_completion(F.col("x")))
    assert [None if r is None else tuple(r) for r in parsed] == [("Oslo", 7, 2, "eosFound"), ("", None, None, "maxPredictedTokensReached"), ("", None, None, "tool"), None, None, None]
    errors = values(spark, given, A.completion_error(F.col("x")))
    assert errors == [None] * 3 + [f"a completion without choices: {x}" for x in ('{"choices": []}', "not json", "")]


def test_bronze(spark):
    assert values(spark, ["TGVzIMOpbMOodmVz", "TGVz=", "Pluto", None, "True"], decode_field(F.col("x"))) == ["Les élèves", "TGVz=", "Pluto", "", "True"]
    ids = values(spark, ["Who  built  it?", " who built\nit? ", "other"], question_id(F.col("x"), F.lit("Ada")))
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 16
    assert values(spark, ["Straße"], question_id(F.col("x"), F.lit("a"), exact=True)) == values(spark, ["STRASSE"], question_id(F.col("x"), F.lit("a"), exact=True))
