"""Tables that cut lineage, kept in the folder that the cluster names for checkpoints, one folder an application."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where it is unset, a folder of this machine is made
    for a session whose executors run on it (tests); on a cluster the setting is required."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: later jobs, and retries after
    a lost executor, start from that table."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
