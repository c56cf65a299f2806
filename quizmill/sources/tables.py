"""Reading and writing the tables of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ANSWERS, BRONZE, JUDGMENTS, QUESTIONS, RESPONSES, TRIPLE, conform
from .compaction import compact, drop_replaced, read_live

#: The marts, in catalogue order.
MARTS = ("model_performance", "performance_by_category", "performance_by_difficulty", "prompt_performance", "latency", "question_hardness", "matching_impact", "position_bias", "errors")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The log of responses, one JSON object a line."""
    return spark.read.schema(RESPONSES).json(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def write_bronze(df: DataFrame, path: str) -> None:
    conform(df, BRONZE).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUESTIONS).parquet(path)


def write_questions(df: DataFrame, path: str) -> None:
    conform(df, QUESTIONS).write.mode("overwrite").parquet(path)


def append_answers(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Add answers to their model's and variant's partitions; what is there isn't read."""
    conform(df, ANSWERS).write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("model_slug", "prompt_variant").parquet(path)


def compact_answers(spark: SparkSession, path: str, target: int | None = 256 << 20, keep_replaced: bool = True) -> int:
    """Join small files of appended answers, see ``compaction``; readers and appends may go on."""
    n = compact(spark, path, ANSWERS, ["model_slug", "prompt_variant"], target)
    if not keep_replaced:
        drop_replaced(spark, path)
    return n


#: Tables dealt out by question also meet on the triple only if Spark may use a part of a join's keys.
MEET_ON_QUESTION = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, dealt: bool = False) -> DataFrame:
    """``df`` as a catalogue table dealt out by question and sorted by triple (what it has of it), one file
    a bucket. Such tables of as many buckets meet on the question without a shuffle, and under the
    settings ``MEET_ON_QUESTION`` on the triple too; what they give is ``dealt`` out already."""
    by = [c for c in TRIPLE if c in df.columns]
    rows = df if dealt else df.repartition(buckets, "question_id")
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, "question_id").sortBy(*by).saveAsTable(table)
    return df.sparkSession.table(table)


def _partitioned(spark: SparkSession, path: str, layout: str, schema) -> DataFrame:
    if layout == "files":  # the files hold all columns; names in the path are ignored, files united by name
        return conform(spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path), schema)
    if layout == "spark":
        return read_live(spark, path, schema)
    raise ValueError(f"layout is 'files' or 'spark', not {layout!r}")


def read_answers(spark: SparkSession, path: str, layout: str = "spark") -> DataFrame:
    return _partitioned(spark, path, layout, ANSWERS)


def read_judgments(spark: SparkSession, path: str, layout: str = "spark") -> DataFrame:
    return _partitioned(spark, path, layout, JUDGMENTS)


def write_judgments(df: DataFrame, path: str) -> None:
    """Replace the judgments of the partitions that ``df`` has; other partitions stay."""
    conform(df, JUDGMENTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_slug", "prompt_variant").parquet(path)


def run_summary(answers: DataFrame) -> DataFrame:
    """Per run and model: variants, answers that are ok and that failed, provenance."""
    provenance = [F.max(c).alias(c) for c in ("host", "hardware", "os_version", "python_version", "runtime_version") if c in answers.columns]
    return answers.groupBy("run_id", "model_name", "model_slug").agg(
        F.array_sort(F.collect_set("prompt_variant")).alias("variants"),
        F.struct(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("error")).alias("counters"),
        F.max("answered_at").alias("finished_at"),
        *provenance,
    )


def write_run_summary(answers: DataFrame, path: str) -> None:
    run_summary(answers).write.mode("append").json(path)


def _known(name: str) -> str:
    if name not in MARTS:
        raise KeyError(f"no mart {name!r}; there are {', '.join(MARTS)}")
    return f"mart_{name}"


def write_mart(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{_known(name)}")


def load_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{_known(name)}")


def available_marts(spark: SparkSession, root: str) -> list[str]:
    """The marts that are there, in catalogue order."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    there = []
    for name in MARTS:
        path = hadoop.Path(f"{root}/{_known(name)}")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            there.append(name)
    return there
