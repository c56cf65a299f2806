"""Queries over whole texts and all models, held against plain Python."""

import re

import pytest

from quizmill.plans import driver_views as V
from quizmill.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def content(turn, text):
    return None if text is None else ("<think>so\nso</think>\n" if turn % 4 == 1 else "") + f'Answer: "{text}."\nmore'


def cleaned(text):
    line = re.sub(r"(?is)<think>.*?</think>", "", text or "").strip().split("\n")[0].strip()
    line = re.sub(r"(?i)^(answer|réponse)\s*[:\-]\s*", "", line).strip(" \t\n\"'`«»")
    return (line[:-1] if line.endswith(".") and not line.endswith("..") else line).strip()


@pytest.mark.parametrize("made", [True, False])
def test_whole_texts(spark, tmp_path, made):
    path = SF
    if made:
        texts = ["Élan vital", 'two words, "quoted" and more', "first line\nsecond", "12 pieces.", None, "日本 🙂"]
        rows = [(1, k, "assistant", t) for k, t in enumerate(texts, 1)] + [(1, 0, "user", "not this")]
        path = str(tmp_path)
        spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{path}/conversations.parquet")
    said = {(r.conv_id, r.turn): content(r.turn, r.text) for r in spark.read.parquet(f"{path}/conversations.parquet").where("role = 'assistant'").collect()}
    for name in ("an_parse", "an_parse_texts"):
        assert {(r.conv_id, r.turn): r.text for r in QUERIES[name](spark, path).collect()} == {k: t or "" for k, t in said.items()}
    for name in ("an_clean", "an_clean_texts"):
        got = {(r.conv_id, r.turn): r.ai_answer for r in QUERIES[name](spark, path).collect()}
        assert got == {k: cleaned(t) for k, t in said.items()}
    if made:
        assert [got[1, k] for k in range(1, 7)] == ["Élan vital", 'two words, "quoted" and more', "first line", "12 pieces..", "", "日本 🙂"]


def test_arbitration_of_all_models(spark):
    key = ["question_id", "model_slug", "prompt_variant"]
    every = QUERIES["jd_arbitrate_all"](spark, SF).collect()
    assert sorted(tuple(r[k] for k in key) for r in every) == sorted(map(tuple, V.answers(spark, SF).select(*key).collect()))
    models = {r.model_slug for r in every}
    assert models == {f"org_model-{k}" for k in range(4)}
    one = QUERIES["jd_arbitrate"](spark, SF).collect()
    assert sorted(map(repr, one)) == sorted(repr(r) for r in every if r.model_slug == "org_model-2")
    asked = [(r.question_id, r.match_method, r.ai_correct) for r in every if r.match_method.startswith("llm_judge")]
    assert asked and all((m, ok) == (("llm_judge", True) if q < "4" else ("llm_judge_rejected", False) if q < "c" else ("llm_judge_failed", False)) for q, m, ok in asked)
    assert not any(r.match_method == "undecided" for r in every)


def test_pending_of_all_models(spark):
    given = V.all_answers(spark, SF).select("question_id", "prompt_variant", "model_slug", "status").collect()
    done = {tuple(r)[:3] for r in given if r.status == "ok"}
    variants = {r.prompt_variant for r in given}
    asked = [r.question_id for r in V.questions(spark, SF).select("question_id").collect()]
    want = sorted((q, v, m) for q in asked for v in variants for m in {r.model_slug for r in given} if (q, v, m) not in done)
    assert sorted(map(tuple, QUERIES["pr_pending_all"](spark, SF).collect())) == want and len({m for _, _, m in want}) == 4


def test_stored_tables_are_built_once_and_again_when_cleared(spark, tmp_path):
    import shutil

    from quizmill.plans import store

    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert store.stored(spark, str(tmp_path), "numbers", build).count() == 3
    assert len(built) == 1
    shutil.rmtree(store._PATHS[spark.sparkContext.applicationId, str(tmp_path), "numbers"])
    assert store.stored(spark, str(tmp_path), "numbers", build).count() == 3 and len(built) == 2
