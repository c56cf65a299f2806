"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised where they lie; only ids, lengths and checksums of pieces travel on. Pieces
are dealt evenly, by a hash of a number of their own, to groups of many million tokens and within these to
runs of about ``RUN`` pieces; Spark hands over a group run by run, a run's pieces longest first. They are
packed online, as they come, with a fixed number of open bins: a bitset holds, per amount of free space,
whether a bin with it is open, so the fullest bin that a piece fits into is the lowest set bit from the
piece's length on. When a piece fits nowhere and all bins are open, the fullest closes. Memory is the
open bins, however many pieces come; short pieces of one run fill what long ones of earlier runs left.

Null texts count as empty: their document is the end id alone. Rows that share an id are packed each
on its own. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .numbering import dealt
from .scratch import materialize
from .tasks import tidy

#: Tokens that are packed together, about, pieces that come longest first, and bins that are open meanwhile.
TASK_TOKENS, RUN, OPEN_BINS = 32 << 20, 1024, 512
#: Group numbers are the high part of sequence numbers.
_TASK_BITS = 40


@cache
def _encoder(vocabulary: str, ranks: str | None):
    """Token ids of texts. With a rank file of the same vocabulary the texts without special strings
    take the faster library; ids are the same."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    if ranks is None:
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, limit: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's tokens and end id. Documents over
    ``limit`` are cut into pieces of that length; what is over is the first piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary, ranks)
        for batch in batches:
            rows: list[tuple] = []
            for at, text in enumerate(batch.column(1)):
                ids = np.array([*(encode(t) if (t := text.as_py()) else ()), end_id], "<u4")
                cut = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
                rows += [(at, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
            if rows:
                at, *rest = zip(*rows, strict=True)
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    out = StructType([StructField("doc_id", docs.schema[id_col].dataType), *(StructField(c, t) for c, t in (("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids_crc32", LongType())))])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), out)


def pack(found: DataFrame, limit: int = 2048, task_tokens: int = TASK_TOKENS, open_bins: int = OPEN_BINS, run: int = RUN) -> DataFrame:
    """``found`` with ``sequence_id, offset``: where each piece lies, gapless from offset 0."""
    kept = materialize(found.withColumn("_row", F.monotonically_increasing_id()))
    n, tokens = kept.where(F.col("length") < limit).agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, -(-tokens // task_tokens))
    runs = max(1, -(-n // (tasks * run)))
    part = lambda k, salt: F.pmod(F.xxhash64("_row", F.lit(salt)), F.lit(k)).cast("int")
    return (
        dealt(kept.withColumns({"task": part(tasks, 1), "_run": part(runs, 2)}), F.col("task"), tasks)
        .sortWithinPartitions("task", "_run", F.desc("length"), "_row")
        .drop("_row", "_run")
        .mapInArrow(tidy(_place(limit, open_bins)), StructType([*found.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]))
    )


def _place(limit: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins = None, None
        for batch in batches:
            sequence, offset = [], []
            for task, n in zip(batch.column("task").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if task != now:
                    now, bins = task, OpenBins(limit, open_bins, task << _TASK_BITS)
                s, o = bins.add(n)
                sequence.append(s)
                offset.append(o)
            out = batch.drop_columns(["task"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*out.schema.names, "sequence_id", "offset"])

    return run


class OpenBins:
    """Online best fit with a fixed number of open bins."""

    def __init__(self, limit: int, most: int, first_id: int = 0) -> None:
        self.limit, self.most, self.next, self.open, self.closed = limit, most, first_id, 0, 0
        self.bits = 0  # bit f: a bin with f free places is open
        self.bins: list[list[int]] = [[] for _ in range(limit + 1)]

    def _take(self, free: int) -> int:
        name = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return name

    def add(self, n: int) -> tuple[int, int]:
        """Sequence and offset of a piece of ``n`` tokens."""
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            name = self._take(free)
        else:
            name, free = self.next, self.limit
            self.next += 1
            if n < self.limit and self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
                self.closed += 1
        rest = free - n
        if rest:
            self.bins[rest].append(name)
            self.bits |= 1 << rest
            self.open += 1
        return name, self.limit - free


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, limit: int = 2048, **names: str) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(pieces(docs, vocabulary, ranks, limit, **names), limit)
