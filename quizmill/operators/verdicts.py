"""An arbiter's verdicts, kept from run to run."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR = ["question_id", "ai_answer"]
READABLE = ["yes", "no"]
#: The table of kept verdicts: the pair's key, the pair, what was said, by whom and when.
VERDICTS = T.StructType([T.StructField(c, T.StringType()) for c in ("pair_key", *PAIR, "verdict", "asked_of", "decided_at")])


def pair_key(question_id: Column, ai_answer: Column, asked_of: str = "") -> Column:
    """Stands for question, answer and who was asked; a null answer isn't an empty one."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(F.lit(f"{len(asked_of)}:{asked_of}"), part(question_id), part(ai_answer)), 256)


def one_verdict(table: DataFrame) -> DataFrame:
    """``pair_key, verdict``, one row a key of a table with ``pair_key``, ``verdict`` and, if it has it,
    ``decided_at``. A verdict that can be read (yes, no) counts before one that can't; of those the latest;
    of equally late ones no counts before yes, and unreadable ones are ``failed``."""
    verdict = F.when(F.col("verdict").isin(READABLE), F.col("verdict")).otherwise("failed")
    at = F.coalesce("decided_at", F.lit("")) if "decided_at" in table.columns else F.lit("")
    rank = F.struct((verdict != "failed").alias("readable"), at.alias("at"), (verdict == "no").alias("no"))
    return table.groupBy("pair_key").agg(F.max(rank).alias("r")).select("pair_key", F.when(~F.col("r.readable"), "failed").when(F.col("r.no"), "no").otherwise("yes").alias("verdict"))


def kept_verdicts(pairs: DataFrame, path: str) -> DataFrame:
    """The verdicts under ``path``; none where nothing was kept yet."""
    spark = pairs.sparkSession
    try:
        return spark.read.schema(VERDICTS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERDICTS)


def ask_new(pairs: DataFrame, ask: Callable[[str, str], str], path: str, asked_of: str, decided_at: Column, concurrency: int | None = None, retry_failed: bool = False) -> DataFrame:
    """``pair_key, verdict`` for ``pairs``: those under ``path`` are looked up, the others asked, each
    distinct pair once, and appended; a run that breaks off appends nothing, and asks again.

    Only keys of kept verdicts are read for the lookup. ``retry_failed`` asks again where no verdict could
    be read. Runs that append at the same time may ask a pair twice; ``one_verdict`` then decides."""
    pairs = pairs.select(*PAIR).distinct().withColumn("pair_key", pair_key(*map(F.col, PAIR), asked_of))
    known = one_verdict(kept_verdicts(pairs, path))
    if retry_failed:
        known = known.where("verdict <> 'failed'")
    new = pairs.join(known.select("pair_key"), "pair_key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(verdict=[ask(q, a) for q, a in zip(b["question_id"], b["ai_answer"], strict=True)])

    asked = (new.repartition(concurrency) if concurrency else new).select("pair_key", *PAIR).mapInPandas(run, "pair_key string, question_id string, ai_answer string, verdict string")
    asked.withColumns({"asked_of": F.lit(asked_of), "decided_at": decided_at.cast("string")}).select(*VERDICTS.names).write.mode("append").parquet(path)
    return one_verdict(kept_verdicts(pairs, path))
