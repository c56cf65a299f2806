"""Cleaning, judging, the fact table, checks, sources and the stream on small tables made here."""

import json

import pytest
from pyspark.sql import functions as F

from quizmill.operators import facts, judge, marts, prompts, quality, work
from quizmill.operators.questions import clean_questions, parse_incorrect, shuffled_choices, split_category
from quizmill.schemas import ANSWERS, JUDGMENTS, TRIPLE, conform
from quizmill.sources import tables
from quizmill.streaming.bronze import stream_bronze

BRONZE = "question_id string, category string, type string, difficulty string, question string, correct_answer string, incorrect_answers string, fetched_at string, batch_id string"
SILVER = [
    ("q1", "History", "Multiple", "Easy", "Who painted it?", "Leonardo da Vinci", '["Raphael", "Titian", "Donatello"]', "t", "b"),
    ("q2", "History", "multiple", "hard", "When?", "1789", '["1798", "1689", "1889"]', "t", "b"),
    ("q3", "Science: Maths", "boolean", "easy", "Is it?", "True", '["False"]', "t", "b"),
    ("q4", "Music", "multiple", "easy", "Which band?", "The Beatles", '["Queen", "Abba"]', "t", "b"),
]


@pytest.fixture(scope="module")
def questions(spark):
    return clean_questions(spark.createDataFrame(SILVER, BRONZE), F.lit("now"))


def answers_of(spark, rows):
    """Answers (question, model, variant, text, status, time, run)."""
    df = spark.createDataFrame(rows, "question_id string, model_slug string, prompt_variant string, ai_answer string, status string, answered_at string, run_id string")
    return conform(df.withColumn("model_name", F.col("model_slug")), ANSWERS)


def judged(spark, questions, given, source=None, **options):
    rows = [(q, f"m{i}", "p2_open_minimal", text, status, "t", "r") for i, (q, text, status) in enumerate(given)]
    found = judge.arbitrate(judge.judge(judge.judge_input(answers_of(spark, rows), questions), **options), source)
    by = {r.model_slug: (r.match_method, r.ai_correct, r.ai_correct_strict) for r in found.collect()}
    return [by[f"m{i}"] for i in range(len(given))]


def test_options_are_parsed_before_entities(spark):
    given = ['["He said &quot;hi&quot;", "Rock &amp;amp; Roll", null]', "['a', 'b  c']", "", None, "[]", "bare &lt;one&gt;"]
    want = [['He said "hi"', "Rock & Roll", ""], ["a", "b c"], [], [], [], ["bare <one>"]]
    given += ['"one &amp; only"', "['a', None]", "['tab\\x41', \"it's\"]", "  ['x']\n", "[broken", '"open']
    want += [["one & only"], ["a", ""], ["tabA", "it's"], ["x"], ["[broken"], ['"open']]
    df = spark.createDataFrame(list(enumerate(given)), "i int, x string")
    assert [r[1] for r in sorted(df.select("i", parse_incorrect(F.col("x"))).collect())] == want


def test_cleaning_job(spark, questions):
    rows = {r.question_id: r for r in questions.collect()}
    assert set(rows) == {"q1", "q2", "q3", "q4"}
    assert (rows["q3"].category_group, rows["q3"].category_name, rows["q1"].category_group) == ("Science", "Maths", "General")
    assert rows["q1"].type == "multiple" and rows["q1"].difficulty == "easy"
    assert all(r.choices[r.correct_answer_position] == r.correct_answer and r.n_choices == len(set(r.choices)) for r in rows.values())
    assert rows["q2"].answer_is_numeric and not rows["q1"].answer_is_numeric
    assert rows["q4"].correct_answer_norm == "the beatles"
    again = spark.createDataFrame([SILVER[0], (*SILVER[0][:4], "  ", *SILVER[0][5:]), (*SILVER[0][:7], "s", "b"), ("q9", None, None, None, None, "x", None, None, None)], BRONZE)
    assert clean_questions(again, F.lit("now")).count() == 1


def test_option_order(spark):
    df = spark.createDataFrame([("q1", "a", ["b", "a", "c", "b"])], "q string, c string, x array<string>")
    for order in ("sha2", "mt"):
        found = [df.select(shuffled_choices(F.col("q"), F.col("c"), F.col("x"), order)).first()[0] for _ in range(2)]
        assert found[0] == found[1] and sorted(found[0]) == ["a", "b", "c"]
    assert tuple(df.select(split_category(F.lit("A: B: C"))).first()[0]) == ("A", "B: C")


def test_cascade(spark, questions):
    letter = chr(65 + questions.where("question_id = 'q2'").first().correct_answer_position)
    given = [
        ("q1", None, "error"), ("q1", "", "ok"), ("q1", "-", "ok"), ("q3", "yes", "ok"), ("q3", "False, I think", "ok"), ("q1", "LEONARDO da vinci!", "ok"),
        ("q2", letter, "ok"), ("q2", "1798", "ok"), ("q1", "Raphael", "ok"), ("q1", "da Vinci", "ok"), ("q2", "17899", "ok"), ("q1", "nobody", "ok"),
    ]
    assert judged(spark, questions, given) == [
        ("error", None, None), ("no_match", False, False), ("no_match", False, False), ("boolean", True, True), ("boolean", False, False), ("exact", True, True),
        ("choice_letter", True, True), ("choice_match", False, False), ("choice_match", False, False), ("fuzzy", True, False), ("no_match", False, False), ("no_match", False, False),
    ]


def test_articles(spark, questions):
    assert judged(spark, questions, [("q4", "The Beatles", "ok")])[0][0] != "exact"
    assert judged(spark, questions, [("q4", "The Beatles", "ok")], strip_reference_articles=True) == [("exact", True, True)]


def test_arbiter(spark, questions):
    given = [("q1", "nobody", "ok"), ("q1", "somebody", "ok"), ("q1", "anybody", "ok"), ("q1", "Leonardo da Vinci", "ok"), ("q1", "x", "error")]
    want = [("llm_judge", True, False), ("llm_judge_rejected", False, False), ("llm_judge_failed", False, False), ("exact", True, True), ("error", None, None)]
    verdicts = {"nobody": "yes", "somebody": "no"}
    table = spark.createDataFrame([("q1", a, v) for a, v in verdicts.items()], "question_id string, ai_answer string, verdict string")
    assert judged(spark, questions, given, table) == want
    assert judged(spark, questions, given, lambda q, a: verdicts.get(a, "failed")) == want
    replies = [("YES", "ok", None), ("No.", "ok", "eosFound"), ("Yes", "ok", "maxPredictedTokensReached"), ("perhaps", "ok", None), ("yes", "error", None), (None, "ok", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(replies)], "i int, t string, s string, f string")
    assert [r[1] for r in sorted(df.select("i", judge.parse_verdict(F.col("t"), F.col("s"), F.col("f"))).collect())] == ["yes", "no", "failed", "failed", "failed", "failed"]


def test_an_answer_needs_its_question(spark, questions):
    with pytest.raises(Exception, match="no question qx"):
        judge.judge_input(answers_of(spark, [("qx", "m", "p2_open_minimal", "a", "ok", "t", "r")]), questions).collect()


def test_work(spark, questions):
    todo = prompts.expand_variants(questions).withColumn("model_slug", F.lit("m"))
    done = answers_of(spark, [("q1", "m", "p2_open_minimal", "a", "ok", "1", "r1"), ("q2", "m", "p2_open_minimal", "a", "error", "1", "r1"), ("q2", "m", "p2_open_minimal", "b", "ok", "2", None), ("q3", "m", "p2_open_minimal", None, "error", "2", None)])
    left = {(r.question_id, r.prompt_variant) for r in work.select_pending(todo, done).collect()}
    assert len(left) == 12 - 2 and ("q3", "p2_open_minimal") in left and ("q1", "p2_open_minimal") not in left
    kept = {r.question_id: (r.status, r.ai_answer) for r in work.latest_answers(done).collect()}
    assert kept == {"q1": ("ok", "a"), "q2": ("ok", "b"), "q3": ("error", None)}
    warm = sorted((r.run_id or "", r.question_id, r.is_warmup) for r in work.flag_warmup(done).collect())
    assert warm == [("", "q2", True), ("", "q3", False), ("r1", "q1", True), ("r1", "q2", False)]
    shards = [{r.question_id for r in work.select_shard(questions, i, 3).collect()} for i in range(3)]
    assert set().union(*shards) == {"q1", "q2", "q3", "q4"} and sum(map(len, shards)) == 4
    assert work.stratified_sample(questions, 2).count() == 2 and work.stratified_sample(questions, 0).count() == 4

    def backend_factory():
        def ask(prompt):
            if "Is it?" in prompt:
                raise OSError("down")
            return {"text": "ok", "completion_tokens": 3, "finish_reason": "eosFound"} if "Who" in prompt else "ok"

        return ask

    asked = work.complete(questions.select("question_id", F.col("question").alias("prompt_text")), backend_factory, 2, wait=lambda attempt: 0.05 * attempt).collect()
    assert {(r.question_id, r.prompt_tokens, r.completion_tokens, r.finish_reason) for r in asked} == {("q1", None, 3, "eosFound"), ("q2", None, None, ""), ("q3", None, None, None), ("q4", None, None, "")}
    assert all(0 <= r.response_time < 60 for r in asked) and [work.backoff(k) for k in (1, 2, 3, 9)] == [2, 4, 8, 10]
    assert {(r.question_id, r.status, r.attempt, r.error) for r in asked} == {(q, "ok", 1, None) for q in ("q1", "q2", "q4")} | {("q3", "error", 2, "down")}


def test_fact_table_and_marts(spark, questions):
    given = answers_of(spark, [("q1", "m", "p1_constrained_mcq", "Raphael", "ok", "1", "r"), ("q2", "m", "p1_constrained_mcq", " ", "ok", "2", "r"), ("q3", "m", "p1_constrained_mcq", None, "error", "3", "r"), ("q4", "m", "p2_open_minimal", "Queen", "ok", "4", "r")])
    given = work.flag_warmup(given.withColumns({"finish_reason": F.when(F.col("question_id") == "q1", "maxPredictedTokensReached"), "response_time": F.lit(1.5), "host": F.lit("h"), "hardware": F.lit("c")}))
    verdicts = judge.run_judge(given, questions, "j", "v1", F.lit("now")).where("question_id <> 'q4'")
    results = facts.int_results(given, questions, verdicts).cache()
    flags = {r.question_id: (r.is_scorable, r.is_empty_answer, r.is_truncated) for r in results.collect()}
    assert flags == {"q1": (True, False, True), "q2": (True, True, None), "q3": (False, False, None), "q4": (True, False, None)}
    (row,) = marts.mart_model_performance(results).collect()
    assert (row.n_total, row.n_scorable, row.n_errors, row.n_judged, row.n_empty, row.n_truncated, row.accuracy_permissive) == (4, 3, 1, 2, 1, 1, 0.0)
    shares = {(r.prompt_variant, r.match_method): r.share for r in marts.mart_matching_impact(results).collect()}
    assert shares == {("p1_constrained_mcq", "choice_match"): 0.5, ("p1_constrained_mcq", "no_match"): 0.5, ("p2_open_minimal", "unjudged"): 1.0}
    bias = {(r.n_choices, r.chosen_position is None): r.chosen_share for r in marts.mart_position_bias(results, questions).collect()}
    assert bias == {(4, False): 0.5, (4, True): 0.5}
    assert [(r.n_errors, r.first_error_at) for r in marts.mart_errors(results).collect()] == [(1, "3")]
    hard = {r.question_id: (r.n_judged, r.failed_by_everyone) for r in marts.mart_question_hardness(results).collect()}
    assert hard == {"q1": (1, True), "q2": (1, True), "q4": (0, True)}
    joined = marts.mart_question_hardness(results, questions)
    assert sorted(map(str, joined.select(*marts.mart_question_hardness(results).columns).collect())) == sorted(map(str, marts.mart_question_hardness(results).collect()))


def test_checks(spark):
    df = spark.createDataFrame([("a", 0.5, "x"), ("a", 1.5, None), (None, None, "z")], "k string, r double, s string")
    found = quality.suite([quality.not_null(df, "t", ["k", "r"]), quality.unique(df, "t", ["k"]), quality.accepted(df, "t", "s", ["x"]), quality.in_range(df, "t", ["r"]), quality.relationship(df, "t", "k", df.where("k is null"))])
    assert {(r.check, r.column): r.n_bad for r in found.collect()} == {("not_null", "k"): 1, ("not_null", "r"): 1, ("unique", "k"): 1, ("accepted_values", "s"): 1, ("accepted_range", "r"): 1, ("relationship", "k"): 2}


def test_checks_in_one_pass(spark):
    df = spark.createDataFrame([("a", 0.5, "x"), ("a", 1.5, None), (None, None, "z")], "k string, r double, s string")
    found = quality.in_one_pass(df, "t", not_null=["k", "r"], accepted={"s": ["x"]}, ranges={"r": (0.0, 1.0)})
    assert {(r.check, r.table, r.column): r.n_bad for r in found.collect()} == {("not_null", "t", "k"): 1, ("not_null", "t", "r"): 1, ("accepted_values", "t", "s"): 1, ("accepted_range", "t", "r"): 1}


def test_answers_and_judgments_on_disk(spark, questions, tmp_path):
    at = str(tmp_path / "answers")
    first = answers_of(spark, [("q1", "m", "p2_open_minimal", "a", "ok", "1", "r"), ("q1", "n", "p2_open_minimal", "a", "error", "1", "r")])
    tables.append_answers(first, at)
    tables.append_answers(answers_of(spark, [("q2", "m", "p2_open_minimal", "b", "ok", "1", "r")]), at)
    back = tables.read_answers(spark, at)
    assert back.schema == ANSWERS and back.count() == 3
    at = str(tmp_path / "judgments")
    for version, rows in (("v1", back), ("v2", back.where("model_slug = 'm'"))):
        tables.write_judgments(judge.run_judge(rows, questions, "j", version, F.lit("now")), at)
    versions = sorted((r.model_slug, r.judgment_version) for r in tables.read_judgments(spark, at).collect())
    assert versions == [("m", "v2"), ("m", "v2"), ("n", "v1")]
    with pytest.raises(KeyError):
        tables.load_mart(spark, str(tmp_path), "nothing")
    tables.write_mart(back.select(*TRIPLE), str(tmp_path), "errors")
    assert tables.available_marts(spark, str(tmp_path)) == ["errors"] and tables.load_mart(spark, str(tmp_path), "errors").count() == 3
    # a foreign tree: columns of the files count, not those of the path; a partition wholly in error keeps its types
    tree = tmp_path / "tree"
    verdicts = conform(spark.createDataFrame([("q1", "m", "v", "error")], "question_id string, model_slug string, prompt_variant string, match_method string"), JUDGMENTS)
    verdicts.write.parquet(str(tree / "model=other" / "prompt_variant=w"))
    assert [(r.model_slug, r.prompt_variant, r.ai_correct) for r in tables.read_judgments(spark, str(tree), "files").collect()] == [("m", "v", None)]


def test_bronze_csv_keeps_quotes_and_lines(spark, tmp_path):
    row = ("q", "c", "multiple", "easy", 'a "quoted"\nline, with comma', "None", '["x", "y"]', "t", "b")
    tables.write_bronze(spark.createDataFrame([row], BRONZE), str(tmp_path / "b"))
    assert [tuple(r) for r in tables.read_bronze(spark, str(tmp_path / "b")).collect()] == [row]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    log, out, state = (str(tmp_path / d) for d in ("log", "out", "state"))
    (tmp_path / "log").mkdir()

    def land(name, code, *questions):
        results = [{"type": "boolean", "difficulty": "easy", "category": "c", "question": q, "correct_answer": "True", "incorrect_answers": ["False"]} for q in questions]
        (tmp_path / "log" / name).write_text(json.dumps({"batch_id": name, "category_id": 9, "payload": {"response_code": code, "results": results}}) + "\n")

    land("1.json", 0, "one?", "two?", " ONE?")
    stream_bronze(spark, log, out, state)
    assert spark.read.parquet(out).count() == 2
    land("2.json", 0, "two?", "three?")
    land("3.json", 5, "four?")
    stream_bronze(spark, log, out, state)
    assert sorted(r.question.strip().lower() for r in spark.read.parquet(out).collect()) == ["one?", "three?", "two?"]
