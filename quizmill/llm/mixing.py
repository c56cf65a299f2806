"""Mixing sources to target weights, by blocks of words.

A source's documents, in an order fixed by a hash, form one stream of words that is packed into blocks
of a fixed length. The mix is a sequence of slots, dealt over output shards. A source has as many slots
as its target calls for; how many of them each shard gets is a multinomial draw over the shards, made
for each source on its own (so any number of sources is drawn in parallel and totals are met exactly):
halves of the shards share a source's slots by a binomial draw seeded by source and half, again and
again, and few shards by one multinomial draw. Slot ``k`` of a source takes block ``k mod blocks``
through a pseudorandom permutation of the source's blocks, a new one each round, and blocks are joined
to documents by index.

Targets: sources in code point order, null last, have the weights in turn, repeating, and share all
words; a target stops at ``cap`` times its source's words, the excess being shared again by weight.
Rows that agree in everything are counted first and one row stands for them, so no task meets them all.
Nulls: a null text has no words; a null source is one source, its ids may be null too. Equal rows are
taken each on its own. Documents without words are taken 0 times. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .numbering import BUCKET, MOST_TASKS, RANGE, copies, numbered, running_sum
from .scratch import materialize
from .tasks import tidy
from .wordhash import scramble

#: Words of a block, slots of an output shard on average, and the greatest multiple of a source's words.
BLOCK, SHARD_SLOTS, CAP = 64, 8192, 3
WEIGHTS = (5, 2, 1)
#: Shards that share slots by one draw, and slots that a task of the draw should make.
FAN, TASK_SLOTS = 64, 1 << 17
#: Slots that are put out at once.
AT_ONCE = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size`` with ``number`` (rank by code point, null last) and ``target``. The level
    that capped shares leave for the others is found by sums over the table, a few times."""
    ranked = numbered(sources.orderBy(F.col("source").asc_nulls_last()), 0, "number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_weight", weight).withColumn("_most", F.col("source_size") * cap)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, spread, full = total, None, -1
    while True:
        # the share of a source whose target isn't capped
        share = F.lit(float(left)) * F.col("_weight") / F.lit(float(spread)) if spread else F.lit(0.0)
        over = share > F.col("_most") if spread else F.lit(False)
        now = ranked.agg(F.count_if(over), F.sum(F.when(over, F.col("_most")).otherwise(0)), F.sum(F.when(~over, F.col("_weight")))).first()
        if now[0] == full:
            return ranked.withColumn("target", F.when(over, F.col("_most").cast("double")).otherwise(share)).drop("_weight", "_most")
        full = now[0] if spread else -1
        left, spread = total - (now[1] or 0), now[2]
        if not spread:
            return ranked.withColumn("target", F.col("_most").cast("double")).drop("_weight", "_most")


def _shard_draws(shards: int, seed: int, fan: int):
    """For each source: ranges of at most ``fan`` shards, with the first of the slots they get and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blocks, slots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out, todo = [], [(0, shards, 0, slots)]
                while todo:
                    lo, hi, first, n = todo.pop()
                    if not n:
                        continue
                    if hi - lo <= fan:
                        out.append((number, blocks, lo, hi, first, n))
                    else:
                        mid = (lo + hi) // 2
                        left = int(np.random.default_rng([seed, number, lo, hi]).binomial(n, (mid - lo) / (hi - lo)))
                        todo += [(mid, hi, first + left, n - left), (lo, mid, first, left)]
                    if len(out) >= 4096 or out and not todo:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["number", "blocks", "lo", "hi", "first", "n"])
                        out = []

    return run


def _slots(seed: int, at_once: int):
    """The slots of a range of shards: ``shard, number, turn, block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blocks, lo, hi, first, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = np.cumsum(np.random.default_rng([seed, number, lo, hi, 1]).multinomial(n, np.full(hi - lo, 1 / (hi - lo))))
                for at in range(0, n, at_once):
                    own = np.arange(at, min(at + at_once, n))
                    turn, block = permuted_blocks(first + own, number, blocks, seed)
                    yield pa.RecordBatch.from_arrays([pa.array(lo + np.searchsorted(ends, own, "right")), pa.array(np.full(len(own), number)), pa.array(turn.astype(np.int32)), pa.array(block)], names=["shard", "number", "turn", "block"])

    return run


def permuted_blocks(k: np.ndarray, number: int, blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Round and block of the slots ``k`` of a source: each round is a permutation of its own."""
    turn, x = k // blocks, k % blocks
    a = int(np.sqrt(max(blocks - 1, 0))) + 1
    b = -(-blocks // a)
    salt = scramble(np.full(1, number, np.uint64) * np.uint64(1_000_003) + turn.astype(np.uint64), seed)
    todo = np.ones(len(x), bool)
    while todo.any():  # cycle walking
        x[todo] = _feistel(x[todo], a, b, salt[todo])
        todo = x >= blocks
    return turn, x


def _feistel(x: np.ndarray, a: int, b: int, salt: np.ndarray) -> np.ndarray:
    left, right = x // b, x % b
    for k in range(4):
        noise = (scramble((right if k % 2 == 0 else left).astype(np.uint64) ^ salt, k) >> np.uint64(1)).astype(np.int64)
        if k % 2 == 0:
            left = (left + noise % a) % a
        else:
            right = (right + noise % b) % b
    return left * b + right


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = 1, shard_slots: int = SHARD_SLOTS, fan: int = FAN, at_once: int = AT_ONCE, bucket: int = BUCKET, in_range: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """From ``row, doc_id, source, size, mark`` (a number of the row, its words, a hash of what tells it
    from others) two tables: these columns with ``copy, source_size, target, number, start`` (equal rows
    have the ``row`` of one of them and different copies; ``start`` is the first word in the source's
    stream), and the slots: ``shard, number, turn, block``."""
    spark = sized.sparkSession
    kinds = materialize(sized.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("n"), F.min("row").alias("row")))
    n_kinds, most = kinds.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    sources = source_targets(kinds.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap)
    blocks = F.ceil(F.col("source_size") / block)
    slots = F.when(blocks > 0, F.least(blocks * cap, F.round(F.col("target") * blocks / F.col("source_size")).cast("long"))).otherwise(0)
    sources = materialize(sources.withColumn("blocks", blocks).withColumn("slots", slots))
    named = sources.select(F.col("source").alias("source_name"), "number", "source_size", "target")
    rows = kinds.join(named, F.col("source").eqNullSafe(F.col("source_name"))).drop("source_name").withColumn("_all", F.col("size") * F.col("n"))
    rows = running_sum(rows, "_all", ["number"], ["doc_id", "size", "mark"], n_kinds, "_first", bucket, in_range)
    rows = copies(rows, "n", "copy", most).withColumn("start", F.col("_first") + F.col("copy") * F.col("size")).drop("_first", "_all", "n")
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards, tasks = max(1, -(-total // shard_slots)), min(MOST_TASKS, max(1, -(-total // TASK_SLOTS)))
    drawn = sources.select("number", "blocks", "slots").mapInArrow(tidy(_shard_draws(shards, seed, fan)), "number long, blocks long, lo long, hi long, first long, n long")
    slots = drawn.repartition(tasks, "number", "lo").mapInArrow(tidy(_slots(seed, at_once)), "shard long, number long, turn int, block long")
    return materialize(rows), slots


def _parts(rows: DataFrame, block: int) -> DataFrame:
    """For each block of the documents with words: the words of it that are theirs."""
    last = F.col("start") + F.col("size") - 1
    cut = rows.where("size > 0").select("number", "row", "copy", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(last / block))).alias("block"))
    begin, end = F.greatest("start", F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select("number", "row", "copy", "block", (begin - F.col("start")).alias("at"), (end - begin).alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **sizes: int) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: the words of each document that the mix
    takes. ``sizes`` are those of ``plan_mix``."""
    sized = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), _words(text_col).alias("size"), F.xxhash64(text_col).alias("mark"))
    rows, slots = plan_mix(materialize(sized), weights, cap, block, seed, **sizes)
    times = slots.groupBy("number", "block").agg(F.count("*").alias("times")).hint("merge")  # Spark can't tell its size
    taken = _parts(rows, block).join(times, ["number", "block"]).groupBy("row", "copy").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return rows.join(taken, ["row", "copy"], "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **sizes: int) -> DataFrame:
    """The mix as documents: each has a row for every round in which blocks of it are taken, with the
    text of these blocks (the whole text, unchanged, where all are). Columns are those of ``docs``; rows
    that differ in any column are documents of their own."""
    plain = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in docs.schema.fields]
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    texts = materialize(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), _words(text_col).alias("size"), F.xxhash64(*plain).alias("mark"), rest.alias("rest"), F.col(text_col).alias("text"))
    )
    rows, slots = plan_mix(texts.select("row", "doc_id", "source", "size", "mark"), weights, cap, block, seed, **sizes)
    taken = (
        _parts(rows, block)
        .join(slots.select("number", "block", "turn").hint("merge"), ["number", "block"])  # Spark can't tell their size
        .groupBy("row", "copy", "turn")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"), F.sum("words").alias("taken"))  # at most the document's blocks
    )
    both = taken.drop("copy", "turn").hint("merge").join(texts.select("row", "size", "rest", "text"), "row")
    some = F.when(F.col("taken") < F.col("size"), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    # the generator keeps Spark from finding the words again for each part
    both = both.select("rest", "text", "parts", F.explode(F.array(some)).alias("words"))
    cut = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice("words", (p["at"] + 1).cast("int"), p["words"].cast("int")))), " ")
    both = both.select("rest", F.when(F.col("words").isNull(), F.col("text")).otherwise(cut).alias("text"))
    return both.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
