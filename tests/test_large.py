"""Percentiles by ranges, filters before a shuffle, and samples of large strata."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_first import shuffled_bytes

from quizmill.operators import quality
from quizmill.operators.bronze import new_questions
from quizmill.operators.percentiles import ranged_percentiles
from quizmill.operators.prefilter import may_match
from quizmill.operators.work import select_pending, stratified_sample
from quizmill.sources.scratch import settings

SHARES = {"low": 0.0, "median": 0.5, "p95": 0.95, "third": 1 / 3, "high": 1.0}


@pytest.mark.parametrize("in_range", [3, 50, 10**6])
def test_percentiles(spark, in_range):
    """Ranges so small that each group crosses many; ties, nulls in keys and values, groups of one."""
    draw = random.Random(1)
    rows = [(draw.choice(["a", "b", None]), draw.choice([1, 2]), draw.choice([None, 1.5, draw.randrange(40) / 4, draw.gauss(0, 1e6)])) for _ in range(900)]
    rows += [("one", 1, 7.25), ("two", 1, 1.0), ("two", 1, 2.0), ("none", 1, None), ("same", 1, 3.0)] + [("same", 1, 3.0)] * 50
    df = spark.createDataFrame(rows, "k string, n int, x double")
    got = {(r.k, r.n): r for r in ranged_percentiles(df, ["k", "n"], F.col("x"), SHARES, in_range).collect()}
    want = {}
    for k, n, x in rows:
        if x is not None:
            want.setdefault((k, n), []).append(x)
    assert set(got) == set(want)
    for key, values in want.items():
        for name, p in SHARES.items():
            assert got[key][name] == pytest.approx(np.percentile(values, 100 * p)), (key, name)
    assert ranged_percentiles(df.where("false"), ["k", "n"], F.col("x"), SHARES).collect() == []


def test_a_task_holds_a_range(spark):
    """One group with many distinct values: no task reads more than about a range of them."""
    df = spark.range(60_000).select(F.lit("g").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7.0).alias("x"))
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    seen = {s.stageId() for s in _stages(store, gateway)}
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = ranged_percentiles(df, ["k"], F.col("x"), {"p": 0.5}, 5000).collect()
    assert found[0].p == pytest.approx(df.agg(F.percentile("x", F.lit(0.5))).first()[0])
    largest = 0
    for s in _stages(store, gateway):
        if s.stageId() not in seen:
            tasks = store.taskList(s.stageId(), s.attemptId(), 10_000)
            for t in (tasks.apply(i) for i in range(tasks.size())):
                if t.taskMetrics().isDefined():
                    largest = max(largest, t.taskMetrics().get().shuffleReadMetrics().recordsRead())
    # the shuffle of counts itself is dealt over four tasks here
    assert 0 < largest <= 20_000


def _stages(store, gateway):
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return [stages.apply(i) for i in range(stages.size())]


def test_prefilter_is_exact_and_narrow(spark):
    """No row that matches is lost, few others pass, and what is too large is left alone."""
    large = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("question_id"), F.col("id").alias("n"), F.lit(None).cast("string").alias("_x"))
    large = large.unionByName(spark.createDataFrame([(None, 1, None)], "question_id string, n long, _x string"))
    small = spark.createDataFrame([(f"k{i}",) for i in range(0, 2000, 2)] + [(None,), ("other",), ("k4",)], "question_id string")
    kept = may_match(large, small, ["question_id"])
    ids = {r.question_id for r in kept.collect()}
    assert ids >= {f"k{i}" for i in range(0, 2000, 2)} and None not in ids
    assert len(ids) < 1000 + 0.1 * 50_000 and kept.columns == large.columns
    assert may_match(large, small, ["question_id"], most_bytes=100) is large
    assert may_match(large, small.where("false"), ["question_id"]).count() < 100
    batch = small.where("question_id is not null").distinct()
    for prefilter in (False, True):
        fresh = new_questions(batch, large.select("question_id"), prefilter).where("question_id = 'other'")
        assert fresh.count() == 1 and new_questions(batch, large.select("question_id"), prefilter).count() == 50_002


def test_prefilter_of_pending_work(spark):
    keys = lambda n: spark.range(n).select(F.concat(F.lit("q"), F.floor(F.col("id") / 2)).alias("question_id"), F.concat(F.lit("m"), F.col("id") % 2).alias("model_slug"), F.lit("p").alias("prompt_variant"), F.when(F.col("id") % 7 == 0, "error").otherwise("ok").alias("status"))
    todo, given = keys(300).drop("status"), keys(20_000)
    plain = sorted(map(tuple, select_pending(todo, given).collect()))
    before = shuffled_bytes(spark)
    assert sorted(map(tuple, select_pending(todo, given, prefilter=True).collect())) == plain and len(plain) == 43
    assert shuffled_bytes(spark) - before < 100_000


@pytest.mark.parametrize(("n", "k"), [(40_000, 20), (60, 20), (10, 500)])
def test_samples_of_large_strata(spark, n, k):
    """The same rows as a full ranking, with about ``k`` rows a stratum ranked; small and null strata are whole."""
    df = spark.range(n).select(F.concat(F.lit("q"), "id").alias("question_id"), F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 50 == 1, "rare").otherwise("common").alias("category"), F.lit("d").alias("difficulty"), F.lit("t").alias("type"))
    before = shuffled_bytes(spark)
    got = sorted(r.question_id for r in stratified_sample(df, k, 3).collect())
    moved = shuffled_bytes(spark) - before
    rows = sorted(((r.category or "", r.noise, r.question_id) for r in df.withColumn("noise", F.sha2(F.concat("question_id", F.lit("␟3")), 256)).collect()))
    turns = {}
    order = []
    for category, _, q in rows:
        turns[category] = turns.get(category, 0) + 1
        order.append((turns[category], category, q))
    assert got == sorted(q for *_, q in sorted(order)[:k])
    assert n < 1000 or moved < 200 * 3 * 3 * k


def test_checks_by_key(spark):
    """As the single checks: null keys are neither repeated nor lost; empty tables have nothing to find."""
    rows = [("a", 1, "ok", 0.5), ("a", 1, "bad", 1.5), ("a", 2, None, None), (None, 1, "ok", 0.1), (None, 1, "ok", -1.0), ("z", 1, "ok", 0.2), ("z", 1, "ok", 0.2), ("z", 1, "ok", 0.2)]
    df = spark.createDataFrame(rows, "k string, n int, s string, x double")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    how = {"not_null": ["s"], "accepted": {"s": ["ok"]}, "ranges": {"x": (0.0, 1.0)}, "relationship": ("k", parent)}
    found = lambda d: {(r.check, r.column): r.n_bad for r in quality.by_key(d, "t", ["k", "n"], **how).collect()}
    assert found(df) == {("unique", "k+n"): 2, ("not_null", "s"): 1, ("accepted_values", "s"): 1, ("accepted_range", "x"): 2, ("relationship", "k"): 3}
    single = [quality.unique(df, "t", ["k", "n"]), quality.not_null(df, "t", ["s"]), quality.accepted(df, "t", "s", ["ok"]), quality.in_range(df, "t", ["x"]), quality.relationship(df, "t", "k", parent)]
    assert {(r.check, r.column): r.n_bad for r in quality.suite(single).collect()} == found(df)
    assert set(found(df.where("false")).values()) == {0}
    assert [tuple(r) for r in quality.offending_keys(df, ["k", "n"]).collect()] == [("z", 1, 3), ("a", 1, 2)]
    plan = quality.by_key(df, "t", ["k", "n"], accepted={"s": ["ok"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rates = spark.createDataFrame([(0.2, 0.1), (0.2, 1.3), (-0.1, 0.5)], "low double, high double")
    assert {(r.check, r.column): r.n_bad for r in quality.rates(rates, "m", ["low", "high"], "low", "high").collect()} == {("accepted_range", "low"): 1, ("accepted_range", "high"): 1, ("permissive_at_least_strict", "high"): 1}
