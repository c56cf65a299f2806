"""Substring deduplication: passages of a fixed number of words that occur earlier are removed.

Every window of ``window`` consecutive words gets two independent rolling (Rabin-Karp) hashes over the
words' hashes. Spark deals the windows out by the range of the first, so all occurrences of a window meet
in one bucket; each but the first (smallest id, then smallest start) is sent back to its document, where
overlapping windows merge into maximal intervals, which are cut out. A task that holds a window several
times sends only the first occurrence and settles the others itself, so a passage of a third of all
documents reaches its bucket once a task, not once a document.

Two windows count as equal if they agree in bucket, in 56 bits of the first hash and in 24 bits of the
second. A bucket fixes up to 8 bits more, so from 256 buckets on different windows do with a probability of
``2**-88``: of ``n`` windows about ``n * n / 2**89`` are expected to be removed wrongly, 0.2 of 10**13.

Nulls: a null text has no words. A null id counts as the largest. Rows that share id and text are
copies of one document and fare alike; rows that share an id only are ordered by a hash of their
texts. Documents are dealt out by id and text, so rows without an id spread over tasks too; copies of one
document that are more than a group's share of all rows are dealt out over as many groups as they fill. An empty
table gives no rows. All columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .numbering import dealt, numbered
from .packing_rows import bucket_of, by_bucket, groups_in_order, joined, row_writer, run_lengths, same_as_neighbour, squeezed, steps, unsqueezed, unsteps
from .tasks import tidy
from .wordhash import Words, words_of

#: Windows that a task keeps before it sends them, and that a bucket holds on average.
HELD, BUCKET = 1 << 19, 3 << 19
#: Bytes of text, about, that a group of documents holds when removals reach them.
GROUP_BYTES = 16 << 20
_LAST = 2**63 - 1
#: Documents whose copies are spread over several groups, at most.
HOT = 1 << 16
#: Spread ids over the groups of documents, the same way in SQL and in tasks.
_PRIME, _SPREAD = 2**31 - 1, 1_103_515
_SENT = "bucket int, hashes binary, docs binary, marks binary, counts binary, starts binary, lengths binary"
_TOLD = "bucket int, docs binary, marks binary, counts binary, starts binary, lengths binary"


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", joined_words: bool = True, held: int = HELD, bucket: int = BUCKET, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``row`` (a struct of the other columns), ``text`` (what is left), ``n_words`` and ``n_removed``.

    Words are runs of other characters than blanks 0x20 and 0x09-0x0D. What is left is the kept words
    joined by one space; with ``joined_words=False`` a text that loses nothing stays as it is.
    """
    spark = docs.sparkSession
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    # only rows that share an id need a mark of their own
    unique = docs.groupBy(own.alias("id")).count().where("count > 1").isEmpty()
    mark = F.lit(0).cast("long") if unique else F.xxhash64(text_col).bitwiseAND(F.lit(2**32 - 1))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    tasks = spark.sparkContext.defaultParallelism
    buckets, groups = max(tasks, -(-size // (6 * bucket))), max(tasks, -(-size // group_bytes))
    keys = docs.select(own.alias("doc"), mark.alias("mark"))
    parts = {} if unique else _parts(keys, groups)
    told = (
        dealt(docs.select(own.alias("doc"), mark.alias("mark"), F.col(text_col).alias("text")).mapInArrow(tidy(_send_windows(window, buckets, held)), _SENT), F.col("bucket"), buckets)
        .sortWithinPartitions("bucket")
        .mapInArrow(tidy(_settle(groups, parts)), _TOLD)
    )
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    spread = F.pmod(F.pmod(F.pmod(own, F.lit(_PRIME)) * _SPREAD, F.lit(_PRIME)) + mark, F.lit(groups))
    texts = docs.select(spread.cast("int").alias("bucket"), own.alias("doc"), mark.alias("mark"), F.struct(*rest).alias("row"), F.col(text_col).alias("text"))
    if parts:
        hot = F.broadcast(spark.createDataFrame([(d, m, n) for (d, m), n in parts.items()], "doc long, mark long, parts long"))
        own_part = numbered(texts.join(hot, ["doc", "mark"]), 0, "number").withColumn("bucket", F.pmod(F.col("bucket") + F.col("number") % F.col("parts"), F.lit(groups)).cast("int"))
        texts = texts.join(hot, ["doc", "mark"], "left_anti").select(*texts.columns).unionByName(own_part.select(*texts.columns))
    both = texts.unionByName(told, allowMissingColumns=True)
    out = StructType([texts.schema["row"]]).add("text", "string").add("n_words", "long").add("n_removed", "long")
    return dealt(both.withColumn("second", F.col("docs").isNull()), F.col("bucket"), groups).sortWithinPartitions("bucket", "second").mapInArrow(tidy(_cut(window, joined_words)), out)


def _parts(keys: DataFrame, groups: int) -> dict[tuple[int, int], int]:
    """Into how many groups the copies of one document go, where they are more than a group's share of all
    rows; at most ``HOT`` documents are."""
    n = keys.count()
    many = keys.groupBy("doc", "mark").count().where(F.col("count") * min(groups, HOT) > n)
    return {(r[0], r[1]): -(-r[2] * groups // n) for r in many.collect()}


def _windows(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text and start, in words, of each window, its hash, and some bits of the second one."""
    number = np.maximum(np.diff(w.first) - window + 1, 0)
    text = np.repeat(np.arange(w.n), number)
    start = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = w.first[:-1][text] + start
    return text, start, w.runs(at, window), (w.runs(at, window, 1) >> np.uint64(40)).astype(np.uint32)


def ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``, ``n[i]`` numbers, for each ``i``."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def _intervals(at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and length of the runs of consecutive starts of one owner; both sorted."""
    if not len(at):
        return owner, at, at
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    return owner[first], at[first], np.diff(np.append(first, len(at)))


def _send_windows(window: int, buckets: int, most: int):
    schema = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in ("hashes", "docs", "marks", "counts", "starts", "lengths"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put, take = row_writer(schema)
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def send() -> None:
            doc, mark, n, h, more, start = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # documents in their order, copies of one document with one number
            order = np.lexsort((mark, doc))
            new = np.concatenate(([True], (doc[order][1:] != doc[order][:-1]) | (mark[order][1:] != mark[order][:-1])))
            number = np.empty(len(doc), np.int64)
            number[order] = np.cumsum(new) - 1
            doc, mark = doc[order][new], mark[order][new]
            owner = np.repeat(number, n)
            place = np.lexsort((start, owner, h)) if len(doc) < len(n) else None
            if place is None:
                by_doc = np.argsort(owner, kind="stable")
                place = by_doc[np.argsort(h[by_doc], kind="stable")]
            h, more, owner, start = h[place], more[place], owner[place], start[place]
            first = np.concatenate(([True], (h[1:] != h[:-1]) | (more[1:] != more[:-1])))
            lead = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
            gone = (owner != owner[lead]) | (start != start[lead])
            o, s = owner[gone], start[gone]
            order = np.lexsort((s, o))
            o, s, lengths = _intervals(s[order], o[order])
            if len(o):
                x, c = run_lengths(o)
                put(int(x[0] % buckets), None, *_pack(doc[x], mark[x], c, s, lengths))
            order = np.flatnonzero(first)[np.lexsort((start[first], owner[first]))]
            h, more, owner, start = h[order], more[order], owner[order], start[order]
            for b, at in by_bucket(bucket_of(h, buckets)):
                x, c = run_lengths(owner[at])
                put(b, _key(h[at], more[at]), *_pack(doc[x], mark[x], c, start[at], None))

        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint32)
            for w in words_of(batch.column(2)):
                text, start, h, more = _windows(w, window)
                if len(h):
                    has, n = run_lengths(text)
                    held.append((ids[w.lo + has], marks[w.lo + has], n, h, more, start))
                    size += len(h)
                if size >= most:
                    send()
                    size = 0
                    yield from take(True)
        if held:
            send()
        yield from take(True)

    return run


def _key(h: np.ndarray, more: np.ndarray) -> bytes:
    """The lower 56 bits of hashes (the bucket has the upper ones) and 24 bits of the second ones."""
    out = np.empty((len(h), 10), np.uint8)
    out[:, :7] = np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :7]
    out[:, 7:] = np.ascontiguousarray(more).view(np.uint8).reshape(-1, 4)[:, :3]
    return out.tobytes()


def _unkey(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    packed = joined(column, np.uint8).reshape(-1, 10)
    h, more = np.zeros((len(packed), 8), np.uint8), np.zeros((len(packed), 4), np.uint8)
    h[:, :7], more[:, :3] = packed[:, :7], packed[:, 7:]
    return h.view(np.uint64).reshape(-1), more.view(np.uint32).reshape(-1)


def _pack(doc: np.ndarray, mark: np.ndarray, count: np.ndarray, start: np.ndarray, length: np.ndarray | None) -> tuple:
    """Runs of windows: of each document its id, mark and number of windows; of each window its start."""
    return squeezed(np.diff(doc, prepend=0), np.int64), squeezed(mark, np.uint32), squeezed(count, np.uint32), squeezed(steps(start, count), np.uint32), None if length is None else squeezed(length, np.uint32)


def _unpack(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Ids, marks and numbers of the runs of all rows, and all starts."""
    if not rows.num_rows:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint32), none, none
    count = [c.astype(np.int64) for c in unsqueezed(rows["counts"], np.uint32)]
    start = [unsteps(s.astype(np.int64), c) for s, c in zip(unsqueezed(rows["starts"], np.uint32), count, strict=True)]
    doc = [np.cumsum(d) for d in unsqueezed(rows["docs"], np.int64)]
    return np.concatenate(doc), np.concatenate(unsqueezed(rows["marks"], np.uint32)), np.concatenate(count), np.concatenate(start)


def _lengths(rows: pa.Table) -> np.ndarray:
    return np.concatenate(unsqueezed(rows["lengths"], np.uint32)).astype(np.int64)


def _settle(groups: int, parts: dict[tuple[int, int], int]):
    """From the windows of a bucket, the ones to remove, packed for the groups of documents; all ``parts``
    of a document with many copies are told."""
    schema = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in ("docs", "marks", "counts", "starts", "lengths"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put, take = row_writer(schema)

        def tell(doc: np.ndarray, mark: np.ndarray, count: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
            to = (doc % _PRIME * _SPREAD % _PRIME + mark) % groups
            if parts:
                times = np.array([parts.get(k, 1) for k in zip(doc.tolist(), mark.tolist(), strict=True)], np.int64)
                first, copy = np.cumsum(count) - count, np.repeat(np.arange(len(doc)), times)
                to = (to[copy] + ragged(np.zeros(len(doc), np.int64), times)) % groups
                at = ragged(first[copy], count[copy])
                doc, mark, count, start, length = doc[copy], mark[copy], count[copy], start[at], length[at]
            owner = np.repeat(np.arange(len(doc)), count)
            for b, at in by_bucket(to[owner].astype(np.int32)):
                x, c = run_lengths(owner[at])
                put(b, *_pack(doc[x], mark[x], c, start[at], length[at]))

        for rows in groups_in_order(batches, ["bucket"]):
            here = rows.column("hashes").is_valid()
            done, rows = rows.filter(pa.compute.invert(here)), rows.filter(here)
            doc, mark, count, start = _unpack(done)
            if len(doc):
                tell(doc, mark, count, start, _lengths(done))
            doc, mark, count, start = _unpack(rows)
            h, more = _unkey(rows["hashes"])
            order = np.argsort(h, kind="stable")
            twice = np.zeros(len(h), bool)
            twice[order] = same_as_neighbour(h[order])
            owner = np.repeat(np.arange(len(doc)), count)[twice]
            h, more, start = h[twice], more[twice], start[twice]
            if len(h):
                order = np.lexsort((start, mark[owner], doc[owner], more, h))
                h, more, owner, start = h[order], more[order], owner[order], start[order]
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (more[1:] != more[:-1])))
                lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
                gone = (doc[owner] != doc[owner[lead]]) | (mark[owner] != mark[owner[lead]]) | (start != start[lead])
                owner, start = owner[gone], start[gone]
                order = np.lexsort((start, owner))
                o, s, n = _intervals(start[order], owner[order])
                x, c = run_lengths(o)
                if len(x):
                    tell(doc[x], mark[x], c, s, n)
            yield from take(False)
        yield from take(True)

    return run


def _cut(window: int, joined_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = None
        told: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if now is not None and bucket[lo] != now:
                    told = {}
                now = bucket[lo]
                part = batch.slice(lo, hi - lo)
                text = part.column("docs").is_null()
                rows = pa.Table.from_batches([part.filter(pa.compute.invert(text))])
                if rows.num_rows:
                    doc, mark, count, start = _unpack(rows)
                    length, cut = _lengths(rows), np.cumsum(count)
                    for d, m, a, b in zip(doc.tolist(), mark.tolist(), (cut - count).tolist(), cut.tolist(), strict=True):
                        told.setdefault((d, m), []).append((start[a:b], length[a:b]))
                part = part.filter(text)
                for at in range(0, part.num_rows, 1000):
                    yield _kept(part.slice(at, 1000), told, window, joined_words)

    return run


def _kept(part: pa.RecordBatch, told: dict, window: int, joined_words: bool) -> pa.RecordBatch:
    column, ids, marks = part.column("text"), part.column("doc").to_numpy(), part.column("mark").to_numpy()
    words, removed, left = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), []
    for w in words_of(column):
        for i in range(w.n):
            n = int(w.first[i + 1] - w.first[i])
            words[w.lo + i] = n
            gone = told.get((int(ids[w.lo + i]), int(marks[w.lo + i]))) if n >= window else None
            text = column[w.lo + i].as_py()
            if gone:
                edge = np.zeros(n + 1, np.int64)
                for start, length in gone:
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + length + window - 1, -1)
                keep = np.cumsum(edge[:-1]) == 0
                removed[w.lo + i] = n - int(keep.sum())
                own = text.encode().split()
                left.append(b" ".join([own[k] for k in np.flatnonzero(keep)]).decode())
            elif joined_words:
                left.append(b" ".join(text.encode().split()).decode() if text else "")
            else:
                left.append(text)
    return pa.RecordBatch.from_arrays([part.column("row"), pa.array(left, pa.string()), pa.array(words), pa.array(removed)], names=["row", "text", "n_words", "n_removed"])
