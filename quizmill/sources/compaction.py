"""Many small files of an appended table become few, while the table is read and appended to.

New files go to a folder of their own, ``_compacted/<id>/data``, which plain readers pass over. What they replace
is written to ``_compacted/<id>/replaced``; its ``_SUCCESS``, made last and at once, is the commit. Readers
take the files that aren't replaced by a commit, so they see the old files or the new ones, never both.
Replaced files stay until ``drop_replaced``, for readers that began before."""

from __future__ import annotations

import uuid
from itertools import accumulate
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import conform
from .scratch import listed, settings

_HOME = "_compacted"


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _commits(spark: SparkSession, path: str) -> list[str]:
    """The folders of the compactions that were committed."""
    fs, at = _folder(spark, f"{path}/{_HOME}")
    made = [f"{path}/{_HOME}/{s.getPath().getName()}" for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(c for c in made if fs.exists(_folder(spark, f"{c}/replaced/_SUCCESS")[1]))


def _replaced(spark: SparkSession, commits: list[str]) -> DataFrame:
    return spark.read.schema("path string").json([f"{c}/replaced" for c in commits]) if commits else spark.createDataFrame([], "path string")


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """``base, path, length`` of the files that make up the table now."""
    commits = _commits(spark, path)
    found = listed(spark, [path]).withColumn("base", F.lit(path))
    for c in commits:
        found = found.unionByName(listed(spark, [f"{c}/data"]).withColumn("base", F.lit(f"{c}/data")))
    return found.join(_replaced(spark, commits), "path", "left_anti").select("base", "path", "length")


def read_live(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a partitioned table that may have been compacted."""
    if not _commits(spark, path):
        return conform(spark.read.schema(schema).parquet(path), schema)
    return _rows_of(spark, [(r.base, r.path) for r in live_files(spark, path).collect()], schema)


def _rows_of(spark: SparkSession, files: list[tuple[str, str]], schema: StructType) -> DataFrame:
    found = spark.createDataFrame([], schema)
    for base in sorted({b for b, _ in files}):
        part = spark.read.schema(schema).option("basePath", base).parquet(*[p for b, p in files if b == base])
        found = found.unionByName(conform(part, schema))
    return found


def _values(folders: str) -> list[str | None]:
    """The values that the names of a partition's folders stand for."""
    written = [f.split("=", 1)[1] for f in folders.split("/")[1:]]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for v in written]


def compact(spark: SparkSession, path: str, schema: StructType, partitions: list[str], target: int | None = 256 << 20, most_files: int = 100_000) -> int:
    """Join the files under half of ``target`` bytes of each partition that has two of them or more, into
    files of about ``target`` bytes (no ``target``: all of a partition into one, however large); returns how many
    files were replaced. At most ``most_files``, the smallest partitions' names first, are taken at once (their
    names pass through the driver); call again for the rest. Appends may go on meanwhile; a second compaction
    of the same files is refused."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    values = F.regexp_extract(folder, f"((?:/[^/=]+=[^/]*){{{len(partitions)}}})$", 1)
    small = live_files(spark, path).where(F.lit(True) if target is None else F.col("length") < target // 2).withColumn("part", values)
    files = F.lit(1) if target is None else F.ceil(F.sum("length") / target)
    groups = small.groupBy("part").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), files.alias("files")).where("n > 1")
    chosen = small.join(groups, "part").orderBy("part", "path").limit(most_files).select("base", "path", "part", "bytes", "files").collect()
    if not chosen:
        return 0
    at = f"{path}/{_HOME}/{uuid.uuid4().hex}"
    rows = _rows_of(spark, [(r.base, r.path) for r in chosen], schema)
    # a task for each file, those of the largest partitions first
    counts = sorted({(r.part, r.bytes, int(r.files)) for r in chosen}, key=lambda c: -c[1] / c[2])
    tasks, before = sum(n for *_, n in counts), accumulate((n for *_, n in counts), initial=0)
    keys = [f"_{p}" for p in partitions]
    places = spark.createDataFrame([(*_values(part), n, k) for (part, _, n), k in zip(counts, before)], ", ".join(f"`{k}` string" for k in keys) + ", _files int, _first int")
    placed = rows.join(F.broadcast(places), [F.col(p).cast("string").eqNullSafe(F.col(k)) for p, k in zip(partitions, keys)], "left")
    own = F.col("_first") + F.when(F.col("_files") == 1, 0).otherwise(F.pmod(F.xxhash64(*schema.names), "_files"))
    dealt = placed.repartitionById(tasks, F.coalesce(own, F.pmod(F.xxhash64(*partitions), F.lit(tasks))).cast("int"))
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):  # of one partition: rows aren't sorted
        dealt.select(*schema.names).write.partitionBy(*partitions).parquet(f"{at}/data")
    names = spark.createDataFrame([(r.path,) for r in chosen], "path string")
    if not _replaced(spark, _commits(spark, path)).join(names, "path", "left_semi").isEmpty():
        raise RuntimeError(f"another compaction has replaced some of these files of {path}")
    names.coalesce(1).write.json(f"{at}/replaced")
    return len(chosen)


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files that commits have replaced; returns how many. No reader that began before the
    last commit may still run."""
    n = 0
    for r in _replaced(spark, _commits(spark, path)).toLocalIterator():
        fs, at = _folder(spark, r.path)
        n += fs.delete(at, False)
    return n
