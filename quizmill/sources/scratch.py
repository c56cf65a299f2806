"""The folder that driver and executors share, and what a listing tells about stored tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, one of this machine, for sessions that run on it alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """In the application's own folder, which can go when it has ended."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written as a table in the shared folder and read again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, length, modificationTime`` of all files under ``paths``; nothing of them is read. Names with
    a leading ``_`` or ``.`` don't count, as for Spark's readers."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length", "modificationTime")


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple[int, ...]:
    """Tells whether files were added, replaced or taken away since: their number, bytes, and a hash of
    names, lengths and times. Paths that don't exist have no files."""
    try:
        files = listed(spark, paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if len(paths) > 1:
            return sum((fingerprint(spark, [p]) for p in paths), ())
        return (0, 0, 0)
    return tuple(files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for what starts inside; what was set before comes back."""
    was = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
