"""One row of each key, chosen before whole rows are touched."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def first_of_each(df: DataFrame, keys: list[str], order: list[tuple[Column, bool]]) -> DataFrame:
    """The rows of ``df`` that come first of their key by ``order`` (columns, and whether they rise; nulls are
    smallest); ties go to the first in the files.

    A first pass reads keys and order only, with each row's place in its file, and drops within each task
    what isn't first there, so neither texts nor the many rows of one key are shuffled. Rows that lose are
    then taken out of the whole rows by their places: an anti-join with the places of the losers, or a
    semi-join with those of the winners, whichever are fewer. Spark broadcasts them where their table is
    small, and the whole rows stay where they lie; without repeats there is nothing to join. What isn't
    a plain scan of files is written to the shared folder first. Files are told apart by a 64-bit hash
    of their paths."""
    rows, places = _placed(df)
    narrow = rows.select(*keys, *[o.alias(f"_o{i}") for i, (o, _) in enumerate(order)], *places)
    best = [F.col(f"_o{i}").asc() if rises else F.col(f"_o{i}").desc() for i, (_, rises) in enumerate(order)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best, "_file", "_row"))
    winners = materialize(narrow.withColumn("_rank", rank).where("_rank = 1").select("_file", "_row"), "winners")
    n, n_winners = rows.count(), winners.count()
    if n == n_winners:
        return df
    whole = rows.select(*[F.col(f"`{c}`") for c in df.columns], *places)
    if n_winners <= n - n_winners:
        kept = whole.join(winners, ["_file", "_row"], "left_semi")
    else:
        losers = materialize(narrow.select("_file", "_row").join(winners, ["_file", "_row"], "left_anti"), "losers")
        kept = whole.join(losers, ["_file", "_row"], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


def _placed(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``df``, or a copy in the shared folder where it isn't a scan of Parquet files whose rows it takes as
    they are (a join or an explode gives several rows one place), and columns of each row's place."""
    places = [F.xxhash64(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.row_index").alias("_row")]
    plan = df._jdf.queryExecution().analyzed()
    as_it_is = plan.deterministic()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if as_it_is and plan.nodeName() == "LogicalRelation":
        try:
            df.select(*places)
            return df, places
        except AnalysisException:  # files without places of rows
            pass
    return materialize(df), places
