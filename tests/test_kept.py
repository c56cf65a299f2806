"""What is kept between runs: verdicts, stream state, compacted files, tables dealt out for joins."""

import os
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quizmill.operators import facts, judge
from quizmill.operators.verdicts import VERDICTS, kept_verdicts, one_verdict, pair_key
from quizmill.schemas import ANSWERS, JUDGMENTS, QUESTIONS, RESPONSES, conform
from quizmill.sources import compaction
from quizmill.sources import tables as T
from quizmill.sources.scratch import settings
from quizmill.streaming.bronze import STATE, id_number, stream_bronze

JUDGED = "question_id string, model_slug string, ai_answer string, match_method string, ai_correct boolean, ai_correct_strict boolean"


def undecided(spark, pairs):
    return spark.createDataFrame([(q, m, a, "undecided", None, False) for q, m, a in pairs], JUDGED)


def asked_log(path, words):
    """An arbiter that notes whom it was asked about."""

    def ask(qid, answer):
        with open(path, "a") as f:
            f.write(f"{qid}|{answer}\n")
        return words.get(answer, "failed")

    return ask


def asked(path):
    return sorted(open(path).read().split()) if os.path.exists(path) else []


def test_a_pair_is_asked_once(spark, tmp_path):
    log, kept = f"{tmp_path}/log", f"{tmp_path}/kept"
    ask = asked_log(log, {"x": "yes", "y": "no"})
    first = undecided(spark, [("q1", "a", "x"), ("q1", "b", "x"), ("q2", "a", "y")])
    settle = lambda df, **how: sorted((r.question_id, r.model_slug, r.ai_answer, r.match_method) for r in judge.arbitrate(df, ask, kept=kept, **how).collect())
    assert settle(first) == [("q1", "a", "x", "llm_judge"), ("q1", "b", "x", "llm_judge"), ("q2", "a", "y", "llm_judge_rejected")]
    assert asked(log) == ["q1|x", "q2|y"]
    more = first.unionByName(undecided(spark, [("q1", "c", "z"), ("q2", "b", "x")]))
    assert settle(more)[2:] == [("q1", "c", "z", "llm_judge_failed"), ("q2", "a", "y", "llm_judge_rejected"), ("q2", "b", "x", "llm_judge")]
    assert asked(log) == ["q1|x", "q1|z", "q2|x", "q2|y"]
    settle(more)
    assert len(asked(log)) == 4
    settle(more, retry_failed=True)  # the unreadable one only
    assert asked(log).count("q1|z") == 2 and len(asked(log)) == 5
    settle(first, asked_of="another")  # its own verdicts
    assert len(asked(log)) == 7


def test_a_run_that_breaks_off_keeps_nothing(spark, tmp_path):
    kept = f"{tmp_path}/kept"

    def broken(qid, answer):
        if answer == "boom":
            raise RuntimeError("gone")
        return "yes"

    df = undecided(spark, [("q", "m", f"a{i}") for i in range(20)] + [("q", "m", "boom")]).repartition(4)
    with pytest.raises(Exception, match="gone"):
        judge.arbitrate(df, broken, kept=kept).collect()
    assert kept_verdicts(df, kept).count() == 0
    log = f"{tmp_path}/log"
    judge.arbitrate(df, asked_log(log, {}), kept=kept).collect()
    assert len(asked(log)) == 21 == kept_verdicts(df, kept).count()


def test_doubled_verdicts(spark):
    """One row an answer, by a stated rule; decided rows aren't touched."""
    said = [("yes", "1"), ("no", "2"), ("?", "3")], [("no", "1"), ("yes", "1")], [("?", "1"), (None, "2")], [("no", "1"), ("yes", "2")], [("yes", None)]
    table = spark.createDataFrame([("q", f"a{i}", v, at) for i, rows in enumerate(said) for v, at in rows], "question_id string, ai_answer string, verdict string, decided_at string")
    df = undecided(spark, [("q", "m", f"a{i}") for i in range(6)]).unionByName(spark.createDataFrame([("q", "m", "a0", "exact", True, True)], JUDGED))
    want = ["llm_judge_rejected", "exact", "llm_judge_rejected", "llm_judge_failed", "llm_judge", "llm_judge", "llm_judge_failed"]
    got = judge.arbitrate(df, table).collect()
    assert Counter(r.match_method for r in got) == Counter(want) and len(got) == 7
    assert {r.ai_answer: r.match_method for r in got if r.match_method != "exact"} == dict(zip([f"a{i}" for i in range(6)], want[:1] + want[2:], strict=True))
    without_times = judge.arbitrate(df, table.drop("decided_at")).where("match_method <> 'exact'").collect()
    assert {r.ai_answer: r.match_method for r in without_times}["a3"] == "llm_judge_rejected"


def test_keys_of_pairs(spark):
    """Nulls and borders of texts give keys of their own."""
    pairs = [("a", "b"), ("ab", ""), ("", "ab"), ("ab", None), (None, "ab"), ("a:b", "c"), ("a", "b:c")]
    keys = spark.createDataFrame(pairs, "q string, a string").select(pair_key(F.col("q"), F.col("a")).alias("k"), pair_key(F.col("q"), F.col("a"), "j").alias("j")).collect()
    assert len({r.k for r in keys} | {r.j for r in keys}) == 2 * len(pairs)
    assert one_verdict(spark.createDataFrame([], VERDICTS)).collect() == []


def response(spark, path, batch, questions):
    rows = [(batch, 9, (0, [("multiple", "easy", "c", q, "right", ["wrong"]) for q in questions]))]
    spark.createDataFrame(rows, RESPONSES).coalesce(1).write.mode("append").json(path)


def test_stream_survives_a_batch_that_breaks(spark, tmp_path):
    """A batch dies in the middle, after some tasks have written; the next run loses and doubles nothing."""
    at = {k: f"{tmp_path}/{k}" for k in ("in", "out", "checkpoint")}
    flag = f"{tmp_path}/broken"
    before = {k: spark.conf.get(k, None) for k in STATE}

    @F.udf("string")
    def when(question):
        if question == "q77?" and os.path.exists(flag):
            raise RuntimeError("died")
        return "2026-01-01"

    response(spark, at["in"], "b0", [f"q{i}?" for i in range(40)])
    query = stream_bronze(spark, at["in"], at["out"], at["checkpoint"], when(F.col("question")))
    metrics = query.lastProgress["stateOperators"][0]["customMetrics"]
    assert any("rocksdb" in k.lower() for k in metrics)
    assert {k: spark.conf.get(k, None) for k in STATE} == before
    open(flag, "w").close()
    response(spark, at["in"], "b1", [f"q{i}?" for i in range(20, 80)])
    response(spark, at["in"], "b2", [f"q{i}?" for i in range(60, 100)])
    with pytest.raises(StreamingQueryException):
        stream_bronze(spark, at["in"], at["out"], at["checkpoint"], when(F.col("question")))
    os.remove(flag)
    for _ in range(2):
        stream_bronze(spark, at["in"], at["out"], at["checkpoint"], when(F.col("question")))
        found = Counter(r.question for r in spark.read.parquet(at["out"]).collect())
        assert found == {f"q{i}?": 1 for i in range(100)}


def test_ids_as_numbers(spark):
    ids = ["0000000000000000", "ffffffffffffffff", "8000000000000000", "7fffffffffffffff", "0123456789abcdef"]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(id_number(F.col("i"))).collect()]
    assert [x % 2**64 for x in got] == [int(i, 16) for i in ids]


def answers(spark, lo, hi):
    rows = spark.range(lo, hi).select(F.concat(F.lit("q"), "id").alias("question_id"), F.concat(F.lit("m "), F.col("id") % 2).alias("model_slug"), F.lit("p/1").alias("prompt_variant"), F.col("id").alias("attempt"), F.lit("ok").alias("status"))
    return conform(rows.coalesce(1), ANSWERS)


def attempts(spark, path):
    return sorted(r.attempt for r in T.read_answers(spark, path).collect())


def test_compaction(spark, tmp_path):
    """Readers see all rows once before, between and after; appends go on; later compactions take earlier ones' files."""
    at = f"{tmp_path}/answers"
    for k in range(6):
        T.append_answers(answers(spark, 10 * k, 10 * k + 10), at)
    old = T.read_answers(spark, at)  # a reader that began before
    assert T.compact_answers(spark, at) == 12
    assert compaction.live_files(spark, at).count() == 2 and old.count() == 60
    assert attempts(spark, at) == list(range(60))
    assert {(r.model_slug, r.prompt_variant, r.attempt % 2) for r in T.read_answers(spark, at).collect()} == {("m 0", "p/1", 0), ("m 1", "p/1", 1)}
    T.append_answers(answers(spark, 60, 70), at)
    assert attempts(spark, at) == list(range(70))
    assert T.compact_answers(spark, at, keep_replaced=False) == 4
    assert attempts(spark, at) == list(range(70)) and compaction.live_files(spark, at).count() == 2
    assert T.compact_answers(spark, at) == 0  # nothing left to join
    T.append_answers(answers(spark, 70, 72), at)
    assert T.compact_answers(spark, at, target=1000) == 0  # no file is small
    assert attempts(spark, at) == list(range(72))


def test_compaction_into_one_file(spark, tmp_path):
    """About ``target`` bytes a file; without one a partition's files become one, whatever they hold."""
    at = f"{tmp_path}/answers"
    for k in range(8):
        T.append_answers(answers(spark, 20 * k, 20 * k + 20), at)
    odd = spark.createDataFrame([("50% é", None), (None, "a=b/prompt_variant=c")], "model_slug string, prompt_variant string")
    for k in range(2):
        T.append_answers(odd.withColumns({"attempt": F.lit(160 + k).cast("long"), "status": F.lit("ok")}), at)
    files = lambda: sorted(Counter(r.path.rsplit("/", 1)[0] for r in compaction.live_files(spark, at).collect()).values())
    seen = lambda: Counter((r.model_slug, r.prompt_variant) for r in T.read_answers(spark, at).collect())
    largest, before = compaction.live_files(spark, at).agg(F.max("length")).first()[0], seen()
    assert len(before) == 4 and T.compact_answers(spark, at, target=2 * largest + 2) == 20
    assert files() == [1, 1, 4, 4] and seen() == before
    assert T.compact_answers(spark, at, target=None) == 8
    assert files() == [1, 1, 1, 1] and seen() == before and attempts(spark, at) == sorted([*range(160), 160, 160, 161, 161])
    assert T.compact_answers(spark, at, target=None) == 0


def test_a_compaction_that_breaks_off(spark, tmp_path, monkeypatch):
    """New files without their commit don't count; two compactions of the same files don't both commit."""
    at = f"{tmp_path}/answers"
    for k in range(3):
        T.append_answers(answers(spark, 4 * k, 4 * k + 4), at)
    with monkeypatch.context() as m:
        m.setattr(compaction, "_replaced", lambda *a: (_ for _ in ()).throw(RuntimeError("died")) if a[1] == [] and os.path.isdir(f"{at}/_compacted") else _replaced(*a))
        with pytest.raises(RuntimeError, match="died"):
            T.compact_answers(spark, at)
    assert attempts(spark, at) == list(range(12)) and compaction.live_files(spark, at).count() == 6
    live = compaction.live_files(spark, at).collect()
    assert T.compact_answers(spark, at) == 6
    monkeypatch.setattr(compaction, "live_files", lambda s, p: s.createDataFrame(live))
    with pytest.raises(RuntimeError, match="another compaction"):
        T.compact_answers(spark, at)
    monkeypatch.undo()
    assert attempts(spark, at) == list(range(12))


_replaced = compaction._replaced


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    """No exchange in the plan of the fact table over written tables, also where nothing may be broadcast."""
    keys = spark.range(300).select(F.format_string("%016x", F.col("id") % 100).alias("question_id"), F.concat(F.lit("m"), F.floor(F.col("id") / 100).cast("string")).alias("model_slug"), F.lit("p1").alias("prompt_variant"), F.lit("ok").alias("status"), F.lit("x").alias("ai_answer"))
    q = keys.select("question_id").distinct().withColumns({"category": F.lit("c"), "type": F.lit("multiple"), "difficulty": F.lit("easy")})
    put = lambda df, schema, name: T.write_bucketed(conform(df, schema), f"kept_{name}", f"{tmp_path}/{name}", 5)
    a, q, j = put(keys, ANSWERS, "answers"), put(q, QUESTIONS, "questions"), put(keys.where("model_slug <> 'm1'").withColumn("match_method", F.lit("exact")), JUDGMENTS, "judgments")
    try:
        with settings(spark, T.MEET_ON_QUESTION | {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            r = facts.int_results(a, q, j)
            plan = r._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
            r = T.write_bucketed(r, "kept_results", f"{tmp_path}/results", 5, dealt=True)
        assert (r.count(), r.where("match_method is null").count()) == (300, 100)
        assert len(list((tmp_path / "results").glob("part-*"))) == 5
        by_question = r.groupBy("question_id").count()
        assert "Exchange" not in by_question._jdf.queryExecution().executedPlan().toString() and by_question.count() == 100
    finally:
        for name in ("answers", "questions", "judgments", "results"):
            spark.sql(f"drop table if exists kept_{name}")
