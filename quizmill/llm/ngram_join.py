"""N-gram Jaccard join: which documents are near copies of each other, as connected components.

The candidate index is a forest of count-vector R-trees: a document's shingles are hashed into a fixed
number of groups, the group counts are a point, and the sum of coordinate minima bounds the overlap of two
documents (or of a document and all documents of a tree node) from above; pairs that survive are verified
on their texts. One tree cannot be dealt out: in count space all texts of one length lie close together,
so each query would have to visit each machine. Shingles therefore route documents to trees:

1. documents with equal shingle sets become one class (aggregation by a 128-bit signature);
2. a document all of whose partners would leave too many of its (sampled) shingles unshared is put
   aside: a necessary condition, evaluated over all documents, that costs no link;
3. the rest are routed by their prefix: of any two documents that link, each has one of the other's first
   ``n - ceil(t * n) + 1`` shingles in a common order. Shingles that are frequent, by a count sketch
   of fixed size, come last in the order. At the first shingle that two documents have in common, all that
   they share is in what each has from there on, so a document's point in a tree counts only these: the
   rare shingles that it has before them, alone, can't pass for shared ones;
4. the documents of a shingle, in blocks of bounded size, form trees (one leaf where they are few). Each
   document takes from each tree the smallest document that the tree lets through. These pairs, one a
   document and tree at most, are verified; most groups of copies, however large, become one component;
5. documents of shingles that are still in several components meet in trees over larger blocks, two and
   two where there are more, and all pairs across components that the trees let through are verified.

Nulls: a null or blank text has an empty set and links with nothing; a row with a null id counts its
shingles and has a null component. Rows that share an id are one node, each with its own size. An
empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .numbering import dealt
from .packing_rows import bucket_of, by_bucket, groups_in_order, joined, row_writer, run_lengths, same_as_neighbour, whole_groups
from .scratch import materialize
from .tasks import tidy
from .wordhash import scramble, shingle_sets

#: One shingle in so many is used to put documents aside.
SAMPLE = 4
#: Sampled shingles that a task keeps before it sends them, and that a bucket holds on average.
HELD, BUCKET = 1 << 19, 1 << 20
#: Counters of the frequency sketch, sent to tasks as one byte each.
SKETCH = 1 << 22
#: Groups that shingles are hashed into, documents in a leaf, children of a node.
GROUPS, LEAF, FAN = 128, 16, 8
#: Documents in a tree at first, and in a block of those that meet across components.
BLOCK, WIDE_BLOCK = 512, 2048
#: Tasks, at most, that the rows of one class are dealt to.
SALTS = 32
#: Pairs whose bounds are taken at once.
_AT_ONCE = 1 << 15
#: Points of one document that a task makes at once.
_POINTS = 1 << 14
#: Ids up to this number are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 500_000


def near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, wide_block: int = WIDE_BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    Two documents link when ``100 * intersection >= percent * union`` of their ``width``-word shingle
    sets; ``component_id`` is the smallest id reachable by links, itself included.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sizes = materialize(docs.mapInArrow(tidy(_sizes(width)), "doc_id long, n long, sampled long, s1 long, s2 long"))
    known = sizes.where("n > 0 and doc_id is not null")
    classes = known.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("tail"), F.max("sampled").alias("sampled"))
    # a class may hold a third of all rows: its rows meet its head in several tasks
    repeated = classes.where("head <> tail").select("s1", "s2", "n", "head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copies = known.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(repeated, ["s1", "s2", "n", "salt"]).where("doc_id <> head")
    copies = copies.select(F.col("doc_id").alias("a"), F.col("head").alias("b"))

    texts = _survivors(docs, sizes, classes, width, percent)
    routed = materialize(_routed(texts, width, percent))
    first = materialize(_first_pairs(routed, percent, block))
    links = materialize(_verified(first, texts, width, percent))
    rest = _open_pairs(routed, connected_components(links), percent, wide_block).join(first, ["a", "b"], "left_anti")
    more = _verified(materialize(rest), texts, width, percent)
    found = connected_components(links.unionByName(more).unionByName(copies))
    return (
        sizes.join(found, sizes["doc_id"] == found["node"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )


def _sizes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((4, batch.num_rows), np.int64)
            for i, u in shingle_sets(batch.column(1), width):
                out[:, i] = len(u), np.count_nonzero(u % np.uint64(SAMPLE) == 0), scramble(u, 1).sum().view(np.int64), scramble(u, 2).sum().view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=["doc_id", "n", "sampled", "s1", "s2"])

    return run


def _slack(percent: int) -> str:
    """Shingles that a document of ``n`` may not share with a partner."""
    return f"floor((100 - {percent}) * n / 100)"


def _survivors(docs: DataFrame, sizes: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, text`` of the class heads that may have partners."""
    total = sizes.agg(F.sum("sampled")).first()[0] or 0
    buckets = max(4 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET))
    counts = (
        dealt(docs.mapInArrow(tidy(_send_sampled(width, buckets)), "bucket int, hashes binary, docs binary, counts binary"), F.floor(F.col("bucket") / 4), -(-buckets // 4))
        .sortWithinPartitions("bucket")
        .mapInArrow(tidy(_count_shared), "doc long, shared long")
        .groupBy("doc")
        .agg(F.sum("shared").alias("shared"))
    )
    heads = classes.select(F.col("head").alias("doc"), "n", "sampled")
    kept = materialize(heads.join(counts, "doc", "left").where(f"sampled - coalesce(shared, 0) <= {_slack(percent)}").select(F.col("doc").alias("doc_id"), "n"))
    ids = F.broadcast(kept) if kept.count() <= BROADCAST_IDS else kept
    # rows that share an id may hold other texts than the head of the class: all are kept, and are one node
    return materialize(docs.join(ids.select("doc_id"), "doc_id", "left_semi"))


def _send_sampled(width: int, buckets: int):
    """Rows of packed sampled shingles. One that a task holds twice is known to be shared: its
    documents are counted at once, and only the shingle itself is sent."""
    schema = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put, take = row_writer(schema)
        kept: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        size = 0

        def send() -> None:
            h, d = np.concatenate(kept), np.concatenate(ids)
            kept.clear()
            ids.clear()
            order = np.argsort(h, kind="stable")
            twice = np.zeros(len(h), bool)
            twice[order] = same_as_neighbour(h[order])
            doc, n = np.unique(d[twice], return_counts=True)
            if len(doc):
                put(int(doc[0] % buckets), None, doc.tobytes(), n.astype(np.uint32).tobytes())
            for b, at in by_bucket(bucket_of(once := h[~twice], buckets)):
                doc, n = run_lengths(d[~twice][at])
                put(b, once[at].tobytes(), doc.tobytes(), n.astype(np.uint32).tobytes())
            for b, at in by_bucket(bucket_of(more := np.unique(h[twice]), buckets)):
                put(b, more[at].tobytes(), None, None)

        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            null = np.asarray(batch.column(0).is_null())
            for i, u in shingle_sets(batch.column(1), width):
                if null[i]:
                    continue
                u = u[u % np.uint64(SAMPLE) == 0]
                kept.append(u)
                ids.append(np.full(len(u), doc[i], np.int64))
                size += len(u)
                if size >= HELD:
                    send()
                    size = 0
                    yield from take(True)
        if kept:
            send()
        yield from take(True)

    return run


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in groups_in_order(batches, ["bucket"]):
        here = rows.column("hashes").is_valid()
        told = rows.filter(pa.compute.invert(here))
        parts = [(joined(told["docs"], np.int64), joined(told["counts"], np.uint32).astype(np.int64))]
        rows = rows.filter(here)
        whole = rows.filter(rows.column("docs").is_valid())
        h = joined(whole["hashes"], np.uint64)
        d = np.repeat(joined(whole["docs"], np.int64), joined(whole["counts"], np.uint32))
        known = joined(rows.filter(rows.column("docs").is_null())["hashes"], np.uint64)
        order = np.argsort(np.concatenate((h, known)), kind="stable")
        twice = np.zeros(len(order), bool)
        twice[order] = same_as_neighbour(np.concatenate((h, known))[order])
        doc, n = np.unique(d[twice[: len(h)]], return_counts=True)
        parts.append((doc, n))
        for doc, n in parts:
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(n)], names=["doc", "shared"])


def _sketch(texts: DataFrame, width: int) -> np.ndarray:
    """Twice the logarithm of how many documents have a shingle of each of ``SKETCH`` classes."""
    part = 1 << 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int32)
        for batch in batches:
            for _, u in shingle_sets(batch.column(0), width):
                total[(u % np.uint64(SKETCH)).astype(np.int64)] += 1
        for i in range(0, SKETCH, part):
            if total[i : i + part].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // part], pa.int32()), pa.array([total[i : i + part].tobytes()])], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(part, np.int64)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([(2 * np.log2(total + 1)).astype(np.uint8).tobytes()])], names=["part", "counts"])
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now is not None and i != now:
                    yield done()
                    total[:] = 0
                now = i
                total += np.frombuffer(x, np.int32)
        if now is not None:
            yield done()

    parts = texts.select("text").mapInArrow(tidy(count), "part int, counts binary").repartition(16, "part").sortWithinPartitions("part").mapInArrow(tidy(add), "part int, counts binary")
    levels = np.zeros(SKETCH, np.uint8)
    for i, x in parts.collect():  # SKETCH bytes, whatever the corpus
        levels[i * part : (i + 1) * part] = np.frombuffer(x, np.uint8)
    return levels


def _in_order(u: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The shingles of a document in the common order: rare ones first, then by hash."""
    return u[np.argsort(levels[(u % np.uint64(SKETCH)).astype(np.int64)], kind="stable")]


def _set_of(u: np.ndarray) -> int:
    """A number that tells the sets of rows that share an id apart."""
    return int(scramble(u, 1).sum().view(np.int64))


def _prefixes(texts: DataFrame, levels: Broadcast, width: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            keys, ids, sets, left = [], [], [], []
            for i, u in shingle_sets(batch.column(1), width):
                n = len(u)
                first = _in_order(u, levels.value)[: (100 - percent) * n // 100 + 1]
                keys.append(first)
                ids.append(np.full(len(first), doc[i]))
                sets.append(np.full(len(first), _set_of(u)))
                left.append(n - np.arange(len(first)))
            if keys:
                columns = [np.concatenate(keys).view(np.int64), *map(np.concatenate, (ids, sets, left))]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["key", "doc", "set", "left"])

    return texts.mapInArrow(tidy(run), "key long, doc long, set long, left long")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link, by the shingle sets of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                left: dict[int, np.ndarray] = {}
                seen: dict[int, int] = {}
                a = part.column(0).to_pylist()
                text = part.column(2).to_pylist()
                slot = [seen.setdefault((x, t), len(seen)) for x, t in zip(a, text, strict=True)]
                for i, u in shingle_sets(pa.array([t for _, t in seen], pa.large_string()), width):
                    left[i] = u
                keep = []
                for i, u in shingle_sets(part.column(3), width):
                    if (v := left.get(slot[i])) is not None and 100 * min(len(u), len(v)) >= percent * max(len(u), len(v)):
                        both = len(np.intersect1d(u, v, assume_unique=True))
                        if 100 * both >= percent * (len(u) + len(v) - both):
                            keep.append(i)
                if keep:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), part.column(1).take(pa.array(keep))], names=["a", "b"])

    return (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(tidy(run), "a long, b long")
    )


def _routed(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``key, members, doc, size, point``: the documents of each prefix shingle that several have; the point
    counts a document's shingles from that one on."""
    levels = texts.sparkSession.sparkContext.broadcast(_sketch(texts, width))
    keys = materialize(_prefixes(texts, levels, width, percent))
    shared = keys.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("members")).where("lo <> hi")
    rows = keys.join(shared.select("key", "members"), "key").groupBy("doc", "set").agg(F.sort_array(F.collect_set(F.struct("left", "key", "members"))).alias("at"))
    groups = texts.mapInArrow(tidy(_groups(width, levels)), "doc long, set long, groups binary").dropDuplicates(["doc", "set"])
    return rows.join(groups, ["doc", "set"]).select("doc", "at.left", "at.key", "at.members", "groups").mapInArrow(tidy(_points), "key long, members long, doc long, size long, point binary")


def _groups(width: int, levels: Broadcast):
    """The group of each shingle of a document, a byte each, in the common order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            found = [(doc[i], _set_of(u), ((_in_order(u, levels.value) >> np.uint64(40)) % np.uint64(GROUPS)).astype(np.uint8).tobytes()) for i, u in shingle_sets(batch.column(1), width)]
            if found:
                ids, sets, groups = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.int64()), pa.array(groups, pa.binary())], names=["doc", "set", "groups"])

    return run


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a document's shingles by group, from each prefix shingle on, in bytes: rounded up to a power
    of two where they are large."""
    names = ["key", "members", "doc", "size", "point"]
    for batch in batches:
        for i in range(batch.num_rows):
            doc, left, key, members, groups = (batch.column(c)[i] for c in range(5))
            groups = np.frombuffer(groups.as_py(), np.uint8)
            left = left.values.to_numpy()
            counts, at = np.zeros(GROUPS, np.int64), len(groups)
            for lo in range(0, len(left), _POINTS):  # the least that is left first
                points = []
                for n in left[lo : lo + _POINTS].tolist():
                    counts += np.bincount(groups[len(groups) - n : at], minlength=GROUPS)
                    at = len(groups) - n
                    points.append(_packed(counts))
                k = len(points)
                columns = [key.values.slice(lo, k), members.values.slice(lo, k), pa.array(np.full(k, doc.as_py())), pa.array(np.full(k, len(groups))), pa.array(points, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _packed(counts: np.ndarray) -> bytes:
    shift = max(0, int(counts.max() - 1).bit_length() - 8)
    while -(-int(counts.max()) >> shift) > 255:
        shift += 1
    return np.append(-(-counts >> shift), shift).astype(np.uint8).tobytes()


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """No count is less than it was."""
    packed = joined(column, np.uint8).reshape(-1, GROUPS + 1)
    points, shift = packed[:, :GROUPS], packed[:, GROUPS:]
    return points.astype(np.int64) << shift if shift.any() else points


def _first_pairs(routed: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs ``a, b``: each document with the smallest one that a tree it is in lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "x"]):
            doc, best = rows["doc"].to_numpy(), np.full(rows.num_rows, rows.num_rows)
            for i, j in _let_through(rows, ["key", "x"], percent, lambda i, j, doc=doc: doc[i] < doc[j]):
                np.minimum.at(best, j, i)
            has = np.flatnonzero(best < len(best))
            if len(has):
                yield pa.RecordBatch.from_arrays([pa.array(doc[best[has]]), pa.array(doc[has])], names=["a", "b"])

    blocks = F.ceil(F.col("members") / block)
    return (
        routed.withColumn("x", F.pmod(F.xxhash64("doc", "key"), blocks))
        .repartition("key", "x")
        .sortWithinPartitions("key", "x", "doc")
        .mapInArrow(tidy(run), "a long, b long")
        .distinct()
    )


def _open_pairs(routed: DataFrame, groups: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs ``a, b`` of different components that share a prefix shingle and that the trees let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "x", "y"]):
            doc, component, own, x, y = (rows[c].to_numpy() for c in ("doc", "component", "block", "x", "y"))
            wanted = lambda i, j: (doc[i] < doc[j]) & (component[i] != component[j]) & ((x[i] == y[i]) | (own[i] != own[j]))  # noqa: B023, E731
            for i, j in _let_through(rows, ["key", "x", "y"], percent, wanted):
                yield pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(doc[j])], names=["a", "b"])

    marked = routed.join(groups, routed["doc"] == groups["node"], "left").select(*routed.columns, F.coalesce("component", "doc").alias("component"))
    marked = materialize(marked)
    still = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    blocks = F.ceil(F.col("members") / block)
    return (
        marked.join(still.select("key"), "key")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("doc", "key"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("x", F.least("block", "other"))
        .withColumn("y", F.greatest("block", "other"))
        .select("key", "x", "y", "block", "doc", "size", "component", "point")
        .repartition("key", "x", "y")
        .sortWithinPartitions("key", "x", "y", "doc")
        .mapInArrow(tidy(run), "a long, b long")
        .distinct()
    )


def _let_through(rows: pa.Table, key: list[str], percent: int, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of one group that are ``wanted`` and that the group's tree lets through. A group of
    no more documents than a leaf is a tree of one leaf; these are taken together."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in key:
        c = rows[k].to_numpy()
        new[1:] |= c[1:] != c[:-1]
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, rows.num_rows))
    size, points = rows["size"].to_numpy(), _unpacked(rows["point"])
    place = np.arange(rows.num_rows) - np.repeat(start, length)
    few = np.repeat(length <= LEAF, length)
    for step in range(1, LEAF):
        later = np.flatnonzero(few & (place >= step))
        for lo in range(0, len(later), _AT_ONCE):
            j = later[lo : lo + _AT_ONCE]
            i = j - step
            ok = wanted(i, j) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
            i, j = i[ok], j[ok]
            bound = np.minimum(points[i], points[j]).sum(axis=1, dtype=np.int64)
            ok = (100 + percent) * bound >= percent * (size[i] + size[j])
            if ok.any():
                yield i[ok], j[ok]
    for at, n in zip(start[length > LEAF].tolist(), length[length > LEAF].tolist(), strict=True):
        for i, j in CountTree(points[at : at + n].astype(np.int64), size[at : at + n]).visits(percent):
            i, j = at + np.minimum(i, j), at + np.maximum(i, j)
            ok = wanted(i, j)
            if ok.any():
                yield i[ok], j[ok]


class CountTree:
    """An R-tree over count vectors, packed level by level: leaves hold neighbours in the order of a
    recursive split along the widest coordinate; a node keeps its coordinates' maxima and its sizes' range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        order: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            part = todo.pop()
            if len(part) <= LEAF:
                order.append(part)
                continue
            widest = int(np.argmax(np.ptp(points[part], axis=0)))
            part = part[np.argsort(points[part, widest], kind="stable")]
            half = -(-len(part) // (2 * LEAF)) * LEAF
            todo += [part[half:], part[:half]]
        self.order = np.concatenate(order)
        self.points, self.sizes = points[self.order], sizes[self.order]
        #: From the leaves up: first child, maxima, least and greatest size of each node.
        self.levels = []
        at = np.arange(0, len(points), LEAF)
        most, low, high = self.points, self.sizes, self.sizes
        while True:
            most, low, high = np.maximum.reduceat(most, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((np.append(at, (at[-1] + LEAF * FAN)), most, low, high))
            if len(most) == 1:
                break
            at = np.arange(0, len(most), FAN)

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pairs, both ways round, that may link."""
        found = list(self.visits(percent))
        return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])

    def visits(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of documents and of those that each may link with (itself too): the sum of minima
        reaches the overlap that their sizes call for. Some documents at a time, from the root down."""
        for lo in range(0, len(self.points), 32):  # bounds the pairs that are held at once
            q = np.arange(lo, min(lo + 32, len(self.points)))
            node = np.zeros(len(q), np.int64)
            for level in range(len(self.levels) - 1, -1, -1):
                first, most, low, high = self.levels[level]
                ok = self._may(q, most[node], low[node], high[node], percent)
                q, node = q[ok], node[ok]
                below = len(self.levels[level - 1][1]) if level else len(self.points)
                start, stop = first[node], np.minimum(first[node + 1], below)
                q = np.repeat(q, stop - start)
                cut = np.cumsum(stop - start)
                node = np.arange(len(q)) - np.repeat(cut - (stop - start), stop - start) + np.repeat(start, stop - start)
            ok = self._may(q, self.points[node], self.sizes[node], self.sizes[node], percent)
            yield self.order[q[ok]], self.order[node[ok]]

    def _may(self, q: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
        own = self.sizes[q]
        least = np.maximum(low, -(-percent * own // 100))
        ok = (100 * low * 1 <= 100 * own * 100 // percent) & (100 * high >= percent * own)
        bound = np.minimum(self.points[q], most).sum(axis=1)
        return ok & ((100 + percent) * bound >= percent * (own + least))
