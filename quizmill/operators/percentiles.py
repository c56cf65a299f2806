"""Exact percentiles of very many values without one task that holds all values of a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: Distinct values of a range, about.
RANGE = 1_000_000


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """That both sides agree in ``keys``; nulls are a value like any other."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys], F.lit(True))


def ranged_percentiles(rows: DataFrame, keys: list[str], value: Column, shares: dict[str, float], in_range: int = RANGE) -> DataFrame:
    """``keys`` and a column for each of ``shares``: the percentile of ``value`` with linear interpolation
    between neighbours; nulls don't count, groups of nulls alone have no row.

    Equal values of a group are counted before the shuffle. The counts are dealt out by ranges of keys and
    value; sums of the ranges tell in which range each wanted place lies, and only those ranges, one or two
    a group and percentile, are gone through in order. So a task holds a range, not a group."""
    counts = materialize(rows.select(*keys, value.cast("double").alias("_v")).where("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_n")), "counts")
    ranges = max(1, -(-counts.count() // in_range))
    counts = materialize(counts.repartitionByRange(ranges, *keys, "_v").withColumn("_range", F.spark_partition_id()), "ranges")
    group = Window.partitionBy(*keys)
    sums = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in"))
    sums = sums.withColumns({"_before": F.coalesce(F.sum("_in").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_all": F.sum("_in").over(group)})
    places = F.array(*[F.struct(F.lit(name).alias("name"), ((F.col("_all") - 1) * F.lit(float(p))).alias("at")) for name, p in shares.items()])
    sums = sums.withColumn("_p", F.explode(places)).withColumns({"_low": F.floor("_p.at"), "_high": F.ceil("_p.at"), "_end": F.col("_before") + F.col("_in")})
    wanted = sums.where("(_low >= _before and _low < _end) or (_high >= _before and _high < _end)")
    names = {k: f"_w{i}" for i, k in enumerate([*keys, "_range"])}
    meets = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(w)) for k, w in names.items()])
    found = counts.join(wanted.withColumnsRenamed(names), meets).drop(*names.values())
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_range", "_p.name").orderBy("_v")) + F.col("_before")
    found = found.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))
    at = lambda place: F.max(F.when((F.col(place) >= F.col("_from")) & (F.col(place) < F.col("_upto")), F.col("_v")))
    ends = found.groupBy(*keys, F.col("_p.name").alias("_name"), F.col("_p.at").alias("_at"), "_low", "_high").agg(at("_low").alias("_a"), at("_high").alias("_b"))
    between = F.when(F.col("_low") == F.col("_high"), F.col("_a")).otherwise((F.col("_high") - F.col("_at")) * F.col("_a") + (F.col("_at") - F.col("_low")) * F.col("_b"))
    return ends.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, between)).alias(name) for name in shares])
