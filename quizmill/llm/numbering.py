"""Running sums over very many rows, without a window over all of them or over a large group; row numbers;
dealing rows out to tasks by a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

#: Rows of a bucket and buckets of a range, on average; copies of one row that a task makes at once.
BUCKET, RANGE, COPIES = 512, 4096, 4096
#: Tasks that rows are dealt to by number at most; beyond, a task gets the rows of several numbers.
MOST_TASKS = 50_000


def dealt(rows: DataFrame, number: Column, n: int, most: int = MOST_TASKS) -> DataFrame:
    """``rows`` with those of each ``number`` (from 0 to ``n - 1``) in one task, neighbours together."""
    each = -(-n // most)
    return rows.repartitionById(-(-n // each), F.floor(number / each).cast("int"))


def running_sum(rows: DataFrame, value: str, group: list[str], order: list[str], n_rows: int, out: str, bucket: int = BUCKET, in_range: int = RANGE) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before it in its group, in an order fixed by a
    hash of ``order`` and, within a bucket of the hash, by ``order`` itself.

    No two rows may agree in ``group`` and ``order`` (count equal rows first, see ``copies``): then hash
    buckets are even. Sums are taken over buckets of about ``bucket`` rows, over ranges of buckets, and
    over the ranges, so no task sees more than a bucket, a range's buckets or a group's ranges.
    """
    buckets = max(1, -(-n_rows // bucket))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets))).withColumn("_range", F.floor(F.col("_bucket") / in_range))
    before = lambda keys, by: Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group, "_range", "_bucket").agg(F.sum(value).alias("_sum"))
    ranges = sums.groupBy(*group, "_range").agg(F.sum("_sum").alias("_sum"))
    ranges = ranges.withColumn("_start", F.coalesce(F.sum("_sum").over(before(group or [F.lit(0)], ["_range"])), F.lit(0))).drop("_sum")
    sums = sums.withColumn("_first", F.coalesce(F.sum("_sum").over(before([*group, "_range"], ["_bucket"])), F.lit(0))).drop("_sum")
    keys = [*group, "_range"]
    starts = sums.alias("s").join(ranges.alias("r"), [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]).select("s.*", "r._start")
    keys.append("_bucket")
    own = F.coalesce(F.sum(value).over(before(keys, order)), F.lit(0))
    return (
        rows.withColumn("_own", own)
        .alias("a")
        .join(starts.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
        .select(*[f"a.{c}" for c in rows.columns if c not in ("_bucket", "_range")], (F.col("a._own") + F.col("b._first") + F.col("b._start")).cast("long").alias(out))
    )


def copies(rows: DataFrame, n: str, out: str, most: int, part: int = COPIES) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``out``; ``most`` is the greatest ``n``. A row that stands
    for very many is dealt out over tasks in parts of ``part`` copies."""
    if most <= part:
        return rows.withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    rows = materialize(rows)
    few = rows.where(F.col(n) <= part).withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.where(F.col(n) > part).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {part}")))).repartitionById(tasks, F.pmod("_part", F.lit(tasks)).cast("int"))
    last = F.least(F.col(n), (F.col("_part") + 1) * part) - 1
    return few.unionByName(parts.withColumn(out, F.explode(F.sequence(F.col("_part") * part, last))).drop("_part"))


def numbered(rows: DataFrame, first: int, out: str) -> DataFrame:
    """``rows`` with the numbers from ``first`` on, without gaps, in ``out``. The rows are written with
    their numbers, so later jobs and retries see the same ones."""
    kept = materialize(rows.withColumn(out, F.monotonically_increasing_id()))
    task = F.shiftright(out, 33)
    counts = kept.groupBy(task.alias("_task")).count().collect()  # one row a task of the write
    starts, at = [], first
    for t, n in sorted(counts):
        starts.append((t, at))
        at += n
    if at > 2**63 - 1:
        raise ValueError(f"{at - first} numbers from {first} on don't fit 64 bits")
    starts = F.broadcast(kept.sparkSession.createDataFrame(starts, "_task long, _start long"))
    number = F.col("_start") + F.col(out).bitwiseAND(F.lit(2**33 - 1))
    return kept.join(starts, task == F.col("_task")).select(*[number.alias(out) if c == out else f"`{c}`" for c in kept.columns])
