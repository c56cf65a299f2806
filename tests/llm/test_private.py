"""Personal data: rules against Python's own matching, spans that trees add, and edge cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quizmill.llm.private_data import KINDS, boost, calibrate, find_private, fit_trees, spans_and_candidates, written
from quizmill.llm.queries import QUERIES
from quizmill.llm.scratch import materialize

# The rules as they are asked for.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or max(map(int, m[0].split("."))) <= 255, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}
            if ok[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def as_text(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def card(draw):
    body = "".join(draw.choice("0123456789") for _ in range(15))
    return next(body + c for c in "0123456789" if luhn(body + c))


def word(draw):
    return draw.choice(["thé", "日本", "answer", "version", "call", "🙂", "token", "of", "the", "+", "1", "a@b", "3.1.4", "12.50", "2024-01-02"])


def corpus(seed, n):
    draw = random.Random(seed)
    number = lambda k: "".join(draw.choice("0123456789") for _ in range(k))
    ip = lambda: ".".join(str(draw.randrange(1, 255)) for _ in range(4))
    some = [lambda: f"user.{number(2)}@mail{number(1)}.example.com", ip, lambda: card(draw), lambda: f"+1 ({number(3)}) {number(3)}-{number(4)}", lambda: number(16), lambda: f"{number(3)}.{number(3)}.900.{number(2)}", lambda: f"+{number(4)}"]
    return [" ".join(draw.choice(some)() if draw.random() < 0.1 else word(draw) for _ in range(draw.randrange(60))) for _ in range(n)]


ODD = [
    None, "", " ", "a@b.c_d@e.f.g", "x@y", "@@a@b.c", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "001.002.003.255", "256.1.1.1", "0.0.0.0", "00.10.000.0255", "0000000000000000000300.1.1.1", "1.2.3.", "é1.2.3.4é",
    "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111 1111 1111", "4111111111111111 2", "+4111111111111111", "0" * 14, "0" * 19, "0" * 20, "0" * 13, "- 4111111111111111 -", "1 (4111111111111111)",
    "+1 (423) 555-7379", "+1 (423) 555-7379 9", "++1 423 555 7379", "+1", "+1 2", "+12345678901.", "+1 (826) 555-4081 190.137.223.204", "🙂 +1 (826) 555-4081 🙂 a@b.co",
]


def test_rules(spark):
    texts = ODD + corpus(1, 200) + ["".join(random.Random(k).choice("0123456789 -.+()@ab_é") for _ in range(400)) for k in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in spans_and_candidates(docs).collect():
        assert [(b.start, b.kind, b.end) for b in r.base] == plain_spans(texts[r.doc_id] or ""), texts[r.doc_id]


def test_spans_lost_to_the_rules_are_added(spark):
    draw = random.Random(2)
    a, b = card(draw), card(draw)
    bad = str(10**15 + next(i for i in range(20) if not luhn(str(10**15 + i))))
    planted = [f"pay {a} {b} now", "call +1 (826) 555-4081 190.137.223.204 or", f"call +1 (826) 555-4081 {a} or", f"see {bad} {bad} there", f"token {bad} done", "no data at all in 3.1.4 of 2024"]
    texts = planted + corpus(3, 400)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = find_private(docs).withColumn("s", written(F.col("added"))).collect()
    added = {r.doc_id: r.s for r in found}
    assert len(added) == len(texts)
    assert added[0] == "card:4:20,card:21:37"
    assert added[1] == "phone:5:22"
    assert added[2] == "phone:5:22,card:23:39"
    assert added[3] == added[4] == added[5] == ""
    # what is added overlaps no span of the rules, nor each other
    for r in found:
        spans = sorted((s.start, s.end) for s in r.added)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert not any(s[0] < b.end and b.start < s[1] for s in spans for b in r.base)


def test_held_out_accuracy(spark):
    """Trees and thresholds from one corpus tell candidates of another."""
    frame = lambda seed: spans_and_candidates(spark.createDataFrame(list(enumerate(corpus(seed, 400))), "doc_id long, text string"))
    model = fit_trees(frame(4))
    held_out = materialize(frame(5))
    other = held_out.select("base", F.explode("candidates").alias("c")).where("not c.joined").select("base", "c.*").collect()
    assert all(r.private == ((r.start, r.kind, r.end) in [tuple(b) for b in r.base]) for r in other)
    right = sum((model.value(r.x.asDict()) >= model.thresholds[r.kind]) == r.private for r in other)
    assert len(other) > 500 and right >= 0.99 * len(other)
    # the SQL form of the trees gives the same scores
    scored = held_out.select(F.explode("candidates").alias("c")).select("c.x", F.expr(model.score("c.x")).alias("s")).collect()
    assert all(abs(r.s - model.value(r.x.asDict())) < 1e-9 for r in scored)


def test_more_combinations_than_the_driver_takes(spark):
    """What is fitted doesn't depend on how many combinations of feature values the driver takes."""
    table = materialize(spans_and_candidates(spark.createDataFrame(list(enumerate(corpus(6, 300))), "doc_id long, text string")))
    whole, by_sums = fit_trees(table), fit_trees(table, vectors=3)
    assert whole.trees and len(by_sums.trees) == len(whole.trees) and by_sums.thresholds.keys() == whole.thresholds.keys()
    picked = [r.x for r in table.select(F.explode("candidates").alias("c")).select("c.x").distinct().collect()]
    assert len(picked) > 50
    for x in picked:
        values = x.asDict()
        assert abs(whole.value(values) - by_sums.value(values)) < 1e-3
        assert (whole.value(values) >= whole.thresholds[x.kind]) == (by_sums.value(values) >= by_sums.thresholds[x.kind])


def test_thresholds_are_calibrated():
    x = lambda kind, check: dict.fromkeys(("digits", "others", "plus", "parens", "parts", "varied", "letters", "left", "right", "cue"), 0) | {"kind": kind, "check": check}
    counts = [(x(2, 1), 98, 2), (x(2, 0), 1, 99), (x(3, 0), 50, 50)]
    model = boost(counts)
    calibrate(model, counts, 0.97)
    assert model.value(x(2, 0)) < model.thresholds[2] <= model.value(x(2, 1)) and model.thresholds[3] == float("inf")
    assert boost([]).trees == [] and boost([(x(2, 0), 0, 5)]).trees == []


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "nothing here"), (1, "nothing here"), (None, None)]])
def test_without_candidates(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("t", "base", "c", "m0", "candidates", "a b")})
    found = find_private(docs).collect()
    assert len(found) == len(rows) and all(r.base == [] and r.added == [] for r in found)


def test_long_text(spark):
    """Very many spans in one text, and runs of one character that patterns could stumble over."""
    many = " ".join(f"u{i}@example.com 10.0.{i % 256}.7" for i in range(3000))
    texts = [many, "9" * 200_000, "a" * 200_000, "1.1." * 50_000, "1 " * 100_000, "+1-" * 50_000, "a@b" + ".c" * 50_000, "(((" * 50_000]
    got = {r.doc_id: [(b.start, b.kind, b.end) for b in r.base] for r in spans_and_candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == plain_spans(many) and len(got[0]) == 6000
    assert got[1] == got[2] == [] and got[6] == [(0, 0, 100_003)] and len(got[3]) == 25_000


def test_query(spark):
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op13_private_data"](spark, path).collect()}
    texts = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc, text in texts:
        want, r = plain_spans(text or ""), got[doc]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in want) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(as_text(want).encode()).hexdigest()
        assert set(as_text(want).split(",")) <= set(r.spans.split(","))
