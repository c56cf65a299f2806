"""Data checks. Each gives the number of offending rows; the suite is the union of all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counted(df: DataFrame, check: str, table: str, column: str, bad: Column) -> DataFrame:
    return df.agg(F.count_if(bad).alias("n_bad")).select(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"), "n_bad")


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_bad").select(F.lit("not_null").alias("check"), F.lit(table).alias("table"), "column", "n_bad")


def unique(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """How many keys occur more than once; a key that holds a null is none."""
    groups = df.where(" and ".join(f"`{c}` is not null" for c in columns)).groupBy(*columns).count()
    return _counted(groups, "unique", table, "+".join(columns), F.col("count") > 1)


def accepted(df: DataFrame, table: str, column: str, values: list) -> DataFrame:
    return _counted(df, "accepted_values", table, column, ~F.col(column).isin(values))


def relationship(df: DataFrame, table: str, column: str, parent: DataFrame) -> DataFrame:
    lost = df.where(F.col(column).isNotNull()).join(parent.select(column), column, "left_anti")
    return _counted(lost, "relationship", table, column, F.lit(True))


def in_range(df: DataFrame, table: str, columns: list[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    counts = df.agg(*[F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_bad").select(F.lit("accepted_range").alias("check"), F.lit(table).alias("table"), "column", "n_bad")


def in_one_pass(df: DataFrame, table: str, not_null: list[str] | None = None, accepted: dict[str, list] | None = None, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The checks of rows by themselves, all by one aggregate over the table."""
    bad = {("not_null", c): F.col(c).isNull() for c in not_null or []}
    bad |= {("accepted_values", c): ~F.col(c).isin(values) for c, values in (accepted or {}).items()}
    bad |= {("accepted_range", c): (F.col(c) < low) | (F.col(c) > high) for c, (low, high) in (ranges or {}).items()}
    counts = df.agg(*[F.count_if(b).alias(f"n{i}") for i, b in enumerate(bad.values())])
    rows = [F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n_bad")) for i, (check, c) in enumerate(bad)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def by_key(
    df: DataFrame,
    table: str,
    key: list[str],
    not_null: list[str] | None = None,
    accepted: dict[str, list] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
    relationship: tuple[str, DataFrame] | None = None,
) -> DataFrame:
    """Uniqueness of ``key``, checks of rows by themselves, and a relationship of a column of the key (column,
    parent), all by one scan of the table and one shuffle: rows become counts a key before it."""
    bad = {("not_null", c): F.col(c).isNull() for c in not_null or []}
    bad |= {("accepted_values", c): ~F.col(c).isin(values) for c, values in (accepted or {}).items()}
    bad |= {("accepted_range", c): (F.col(c) < low) | (F.col(c) > high) for c, (low, high) in (ranges or {}).items()}
    keys = df.groupBy(*key).agg(F.count("*").alias("_n"), *[F.count_if(b).alias(f"_n{i}") for i, b in enumerate(bad.values())])
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    sums = [((("unique", "+".join(key))), F.count_if(whole & (F.col("_n") > 1)))]
    sums += [(check, F.coalesce(F.sum(f"_n{i}"), F.lit(0))) for i, check in enumerate(bad)]
    if relationship is not None:
        column, parent = relationship
        there = parent.select(F.col(column).alias("_parent"), F.lit(True).alias("_there")).distinct()
        keys = keys.join(there, keys[column] == there["_parent"], "left")
        sums.append((("relationship", column), F.coalesce(F.sum(F.when(F.col(column).isNotNull() & F.col("_there").isNull(), F.col("_n"))), F.lit(0))))
    counts = keys.agg(*[n.alias(f"n{i}") for i, (_, n) in enumerate(sums)])
    rows = [F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n_bad")) for i, ((check, c), _) in enumerate(sums)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def offending_keys(df: DataFrame, key: list[str], k: int = 20) -> DataFrame:
    """``k`` of the keys that occur more than once, the most frequent first, with their counts."""
    counts = df.dropna(subset=key).groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    return counts.orderBy(F.desc("n_rows"), *key).limit(k)


def rates(df: DataFrame, table: str, columns: list[str], low: str, high: str) -> DataFrame:
    """Rates from 0 to 1 in ``columns``, and ``high`` at least ``low``, in one pass."""
    bad = {("accepted_range", c): (F.col(c) < 0) | (F.col(c) > 1) for c in columns} | {("permissive_at_least_strict", high): F.col(high) < F.col(low)}
    counts = df.agg(*[F.count_if(b).alias(f"n{i}") for i, b in enumerate(bad.values())])
    rows = [F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n_bad")) for i, (check, c) in enumerate(bad)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def permissive_at_least_strict(df: DataFrame, table: str) -> DataFrame:
    return _counted(df, "permissive_at_least_strict", table, "accuracy_permissive", F.col("accuracy_permissive") < F.col("accuracy_strict"))


def suite(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
