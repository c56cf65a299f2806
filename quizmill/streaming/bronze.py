"""Bronze questions as response files arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import bronze_rows, decode_results, explode_results
from ..schemas import RESPONSES
from ..sources.scratch import settings


#: State on the executors' disks, of which a batch sends only the changes to the checkpoint.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def id_number(question_id: Column) -> Column:
    """The 64 bits that the 16 hex digits of an id stand for, without loss."""
    half = lambda at: F.conv(F.substring(question_id, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def new_bronze(responses: DataFrame, fetched_at: Column, watermark: str | None = None) -> DataFrame:
    """Bronze rows whose id hasn't been seen. The state holds ids for ever, 8 bytes each, as a resumed
    collection does; with ``watermark`` (a delay) it forgets ids of older rows, so repeats after that come again."""
    rows = bronze_rows(decode_results(explode_results(responses)), fetched_at).withColumn("_key", id_number(F.col("question_id")))
    if watermark is None:
        return rows.dropDuplicates(["_key"]).drop("_key")
    return rows.withColumn("_at", F.to_timestamp("fetched_at")).withWatermark("_at", watermark).dropDuplicatesWithinWatermark(["_key"]).drop("_at", "_key")


def stream_bronze(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, fetched_at: Column | None = None, watermark: str | None = None):
    """Process the files that have arrived and stop; a later call, even after a crash, goes on from
    ``checkpoint``. Returns the finished query."""
    responses = spark.readStream.schema(RESPONSES).json(in_path)
    rows = new_bronze(responses, fetched_at if fetched_at is not None else F.current_timestamp().cast("string"), watermark)
    with settings(spark, STATE):
        query = rows.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
