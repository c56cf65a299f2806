"""One row of each key by a pass over keys and order, and stored tables over changing inputs."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from quizmill.operators.bronze import dedupe_questions
from quizmill.operators.first import first_of_each
from quizmill.operators.work import latest_answers
from quizmill.plans import store
from quizmill.plans.queries import QUERIES
from quizmill.sources.scratch import fingerprint


def by_at_and_n():
    return [(F.col("at"), False), (F.col("n"), True)]


def shuffled_bytes(spark):
    """Of all stages of the session so far."""
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain(rows):
    best = {}
    for r in rows:
        # of "at" the greatest, nulls last; of "n" the smallest, nulls first
        rank = (r[1] is None, [-ord(c) for c in r[1] or ""] + [1], r[2] is not None, r[2] or 0)
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    return sorted((r for _, r in best.values()), key=str)


def made(seed, n, keys):
    draw = random.Random(seed)
    return [(draw.choice([None, *range(keys)]), draw.choice([None, "a", "b", "c"]), draw.choice([None, *range(10**6)]), "x" * draw.randrange(5) + str(i)) for i in range(n)]


@pytest.mark.parametrize(("n", "keys"), [(0, 1), (300, 3), (300, 250), (5, 10**6)])
def test_first_rows(spark, tmp_path, n, keys):
    """Scans and other plans; winners or losers fewer; nulls in keys and order."""
    rows = made(n, n, keys)
    df = spark.createDataFrame(rows, "k long, at string, n long, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    for source in (df, scan, scan.where("true").select("*")):
        assert sorted(map(tuple, first_of_each(source, ["k"], by_at_and_n()).collect()), key=str) == plain(rows)


def test_rows_of_one_place(spark, tmp_path):
    """A join or an explode gives several rows the place of one; each counts on its own."""
    spark.range(4).selectExpr("id as k", "array(3, 1, 2) as xs").write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    exploded = scan.select("k", F.explode("xs").alias("n"))
    joined = scan.join(spark.createDataFrame([(0, 5), (0, 4), (1, 7)], "k long, n int"), "k").select("k", "n")
    first = lambda df: sorted(map(tuple, first_of_each(df, ["k"], [(F.col("n"), True)]).collect()))
    assert first(exploded) == [(k, 1) for k in range(4)]
    assert first(joined) == [(0, 4), (1, 7)]


def test_texts_are_not_shuffled(spark, tmp_path):
    """Rows of 2 KB: no aggregate sorts them, and far fewer bytes move than the rows have."""
    text = F.concat_ws("", *[F.sha2(F.concat("id", F.lit(f"-{i}")), 256) for i in range(32)])
    rows = spark.range(6000).select((F.col("id") % 5500).cast("string").alias("question_id"), F.lit("m").alias("model_slug"), F.lit("p").alias("prompt_variant"), F.lit("ok").alias("status"), F.col("id").cast("string").alias("answered_at"), F.lit("r").alias("run_id"), text.alias("ai_answer"))
    rows.write.parquet(f"{tmp_path}/answers")
    answers = spark.read.parquet(f"{tmp_path}/answers")
    before = shuffled_bytes(spark)
    latest = latest_answers(answers)
    assert "SortAggregate" not in plan_of(latest) and "SortMergeJoin" not in plan_of(latest)
    assert latest.agg(F.count("*"), F.sum(F.length("ai_answer"))).first() == (5500, 5500 * 2048)
    assert 0 < shuffled_bytes(spark) - before < 0.1 * 6000 * 2048
    first = dedupe_questions(answers, ("answered_at",))
    assert "SortAggregate" not in plan_of(first) and first.count() == 5500


def test_one_key_for_a_third(spark, tmp_path):
    """What isn't first in its task is dropped there: the hot key's rows don't meet in one task."""
    spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as k", "cast(id as string) as at", "id as n").repartition(8).write.parquet(f"{tmp_path}/t")
    before = shuffled_bytes(spark)
    found = first_of_each(spark.read.parquet(f"{tmp_path}/t"), ["k"], [(F.col("at"), False)])
    assert found.count() == 20_001 and found.where("k = -1").first().at == "9999"
    assert shuffled_bytes(spark) - before < 3_000_000


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_stored_tables_follow_their_inputs(spark, tmp_path):
    """A table that is replaced is seen by the next query; what hasn't changed isn't built again."""
    for t in store.INPUTS:
        shutil.copytree(f"/root/testdata/sf0.001/{t}.parquet", f"{tmp_path}/{t}.parquet") if os.path.isdir(f"/root/testdata/sf0.001/{t}.parquet") else shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", f"{tmp_path}/{t}.parquet")
    errors = lambda: sum(r.n_errors for r in QUERIES["mt_errors"](spark, str(tmp_path)).collect())
    all_rows = errors()
    paths = dict(store._PATHS)
    assert errors() == all_rows and store._PATHS == paths
    few = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(600).toPandas()
    shutil.rmtree(f"{tmp_path}/lineitem.parquet", ignore_errors=True) if os.path.isdir(f"{tmp_path}/lineitem.parquet") else os.remove(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(few).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert 0 < errors() < all_rows


def test_fingerprint(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    one = fingerprint(spark, [f"{tmp_path}/a"])
    assert fingerprint(spark, [f"{tmp_path}/a"]) == one
    spark.range(3).write.mode("append").parquet(f"{tmp_path}/a")
    assert fingerprint(spark, [f"{tmp_path}/a"]) != one
