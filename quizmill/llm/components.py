"""Connected components of a graph given by its edges, without a driver-side union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialize

#: Tasks, at most, that the edges of one node are dealt to.
SALTS = 16


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``edges(a, b)``: component is its smallest reachable node.

    Alternating large-star and small-star contractions; each step is an aggregation (combined before
    the shuffle) and an equi-join, in which the edges of a node with very many are dealt to ``SALTS``
    tasks, and is written to the shared folder. Null ends, loops and repeated edges have no effect; no edges give no rows.
    """
    now = materialize(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = _mark(now)
    while True:
        now = materialize(_small_star(_large_star(now)))
        before, mark = mark, _mark(now)
        if before == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    greater = both.where("b > a").withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    return greater.join(least, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
