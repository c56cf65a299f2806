"""Tables that several queries start from, built once for given inputs and kept as Parquet.

The pipeline keeps its questions, answers and fact table the same way: marts, views and checks read
them and don't build them again. A table is built anew where an input's files changed (names, lengths or
times, as a listing has them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import fingerprint, fresh_path

#: Of the tables in the driver's folders those that stored tables are built from.
INPUTS = ("part", "lineitem")

_PATHS: dict[tuple[str, str, str], str] = {}
_BUILT_FROM: dict[tuple[str, str, str], tuple[int, ...]] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` over the tables of ``sf_dir``: built by the first query of the session that asks
    for it, and again where the inputs changed or its folder was cleared since."""
    key, now = (spark.sparkContext.applicationId, sf_dir, name), fingerprint(spark, [f"{sf_dir}/{t}.parquet" for t in INPUTS])
    if _BUILT_FROM.get(key) == now:
        try:
            return spark.read.parquet(_PATHS[key])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    path = fresh_path(spark, name)
    build().write.parquet(path)
    _PATHS[key], _BUILT_FROM[key] = path, now
    return spark.read.parquet(path)
