"""What is still to be asked, asking it, and which answer of several counts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import TRIPLE
from ..sources.scratch import materialize
from .first import first_of_each
from .percentiles import same
from .prefilter import may_match


def done_keys(answers: DataFrame) -> DataFrame:
    return answers.where("status = 'ok'").select(*TRIPLE).distinct()


def select_pending(work: DataFrame, answers: DataFrame, prefilter: bool = False) -> DataFrame:
    """The work without an answer that is ok; failed answers are asked again. With ``prefilter``, for work
    that is small beside the answers, only answers that may be to it are shuffled."""
    done = answers.where("status = 'ok'").select(*TRIPLE)
    return work.join(may_match(done, work, TRIPLE) if prefilter else done, TRIPLE, "left_anti")


def shard_of(qid: Column, n: int) -> Column:
    """sha256 of the id, as a number, modulo ``n``: folded over its 16 groups of four digits."""
    digits = F.sha2(qid, 256)
    group = lambda i: F.conv(F.substring(digits, i * 4 + 1, F.lit(4)), 16, 10).cast("long")
    return F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(0).cast("long"), lambda s, i: (s * 65536 + group(i)) % n).cast("int")


def select_shard(df: DataFrame, i: int, n: int) -> DataFrame:
    if not 0 <= i < n:
        raise ValueError(f"shard {i} of {n}")
    return df.where(shard_of(F.col("question_id"), n) == i)


def stratified_sample(df: DataFrame, k: int, seed: int = 0, strata: tuple[str, ...] = ("category", "difficulty", "type")) -> DataFrame:
    """``k`` rows, one of each stratum in turn, in an order by a hash of id and seed. ``k`` under 1, or
    all rows and more, gives all rows.

    Strata are counted first. Of a stratum of n rows the k smallest hashes lie under about k / n of their
    range, so only rows under that share and some deviations are ranked, about k a stratum; a stratum left
    short of its rows is ranked whole. Ranks are of ids only, and the chosen ids, at most ``k``, are joined back."""
    if k <= 0:
        return df
    keys = list(strata)
    noise = F.sha2(F.concat("question_id", F.lit(f"␟{seed}")), 256)
    ids = df.select("question_id", *strata, noise.alias("_noise"))
    counts = materialize(ids.groupBy(*strata).agg(F.count("*").alias("_n")), "strata")
    share = (k + 6 * k**0.5 + 12) / F.col("_n")
    low = F.conv(F.substring("_noise", 1, 8), 16, 10).cast("long") / 2.0**32
    near = materialize(ids.join(counts, same(ids, counts, keys)).where(low < share).select(*[ids[c] for c in ids.columns]), "near")
    have = near.groupBy(*strata).agg(F.count("*").alias("_have"))
    short = counts.join(have, same(counts, have, keys), "left").where(F.coalesce("_have", F.lit(0)) < F.least("_n", F.lit(k))).select(*[counts[c] for c in keys])
    if not short.isEmpty():
        short = materialize(short, "short")
        near = near.join(short, same(near, short, keys), "left_anti").unionByName(ids.join(short, same(ids, short, keys), "left_semi"))
    turn = F.row_number().over(Window.partitionBy(*strata).orderBy("_noise", "question_id"))
    chosen = near.withColumn("_turn", turn).where(F.col("_turn") <= k).orderBy("_turn", *strata).limit(k)
    return df.join(chosen.select("question_id"), "question_id", "left_semi")


def backoff(attempt: int) -> float:
    """Seconds between an attempt that failed and the next."""
    return min(2.0**attempt, 10.0)


def complete(prompts: DataFrame, backend_factory: Callable, max_attempts: int = 3, wait: Callable[[int], float] = backoff) -> DataFrame:
    """``prompts`` with ``raw_answer, response_time, prompt_tokens, completion_tokens, finish_reason, status,
    error, attempt``: each ``prompt_text`` is given to a backend, one made per partition, up to
    ``max_attempts`` times; what fails stays as an error.

    A backend gives a text, or a mapping with ``text`` and, if it knows them, ``prompt_tokens``,
    ``completion_tokens`` and ``finish_reason``. ``response_time`` is that of the last attempt, in seconds."""
    names = ("raw_answer", "response_time", "prompt_tokens", "completion_tokens", "finish_reason", "status", "error", "attempt")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = backend_factory()
        for batch in batches:
            rows = []
            for text in batch["prompt_text"]:
                row = (None, None, None, None, None, "error", "not asked", 0)
                for attempt in range(1, max_attempts + 1):
                    began = time.perf_counter()
                    try:
                        said = backend(text)
                        took = round(time.perf_counter() - began, 4)
                        if not isinstance(said, Mapping):
                            said = {"text": said}
                        row = (str(said.get("text") or ""), took, said.get("prompt_tokens"), said.get("completion_tokens"), str(said.get("finish_reason") or ""), "ok", None, attempt)
                        break
                    except Exception as e:  # noqa: BLE001  any failure of a user's backend is data here
                        row = (None, round(time.perf_counter() - began, 4), None, None, None, "error", str(e) or type(e).__name__, attempt)
                        if attempt < max_attempts:
                            time.sleep(wait(attempt))
                rows.append(row)
            more = {c: [r[i] for r in rows] for i, c in enumerate(names)}
            yield batch.assign(**(more | {c: pd.array(more[c], "Int64") for c in ("prompt_tokens", "completion_tokens")}))

    kept = "".join(f"`{n}` {t}, " for n, t in prompts.dtypes)
    return prompts.mapInPandas(run, f"{kept}raw_answer string, response_time double, prompt_tokens long, completion_tokens long, finish_reason string, status string, error string, attempt long")


def flag_warmup(df: DataFrame, order_by: tuple[str, ...] = ("answered_at", *TRIPLE)) -> DataFrame:
    """``is_warmup`` on the first call of each run: an aggregate of one row a run, joined back. Rows
    without a run are one run; ``order_by`` should tell the rows of a run apart."""
    first = df.groupBy(F.col("run_id").alias("_run")).agg(F.min(F.struct(*order_by)).alias("_first"))
    flagged = df.join(first, F.col("run_id").eqNullSafe(F.col("_run"))).withColumn("is_warmup", F.struct(*order_by) == F.col("_first"))
    return flagged.select(*[c for c in df.columns if c != "is_warmup"], "is_warmup")


def latest_answers(answers: DataFrame, order_by: tuple[str, ...] = ("answered_at", "run_id")) -> DataFrame:
    """One row a triple: an answer that is ok before one that failed, then the latest, by a pass over
    triples, status and order alone."""
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    return first_of_each(answers, TRIPLE, [(ok, False), *((F.col(c), False) for c in order_by)])
