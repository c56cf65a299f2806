"""Many small numbers in few rows: columns of numbers packed as binary values, dealt by a hash's range.

A shuffle of one row per shingle or window costs far more than its bytes. Tasks therefore send, per
range ("bucket") of the hash, one row that holds the hashes and, run-length coded, the documents they
came from. Spark deals and sorts these rows; a task reads its buckets one after another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs with the places that hold it, in their order."""
    order = np.argsort(buckets, kind="stable")
    ends = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, ends):
        if len(part):
            yield int(buckets[part[0]]), part


def run_lengths(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the runs of equal neighbours."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    at = np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1))
    return x[at], np.diff(np.concatenate((at, [len(x)])))


def same_as_neighbour(x: np.ndarray) -> np.ndarray:
    """In a sorted array, whether a value occurs more than once."""
    same = np.zeros(len(x), bool)
    if len(x) > 1:
        eq = x[1:] == x[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    return same


def groups_in_order(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The runs of equal ``key`` in a partition that Spark has sorted by it. Only one run is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)) for k in key]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for i in range(len(cuts) - 1):
            if i:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(cuts[i], cuts[i + 1] - cuts[i]))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Stretches of a partition that Spark has sorted by ``key``, each of whole groups: about a batch of
    rows, or one group if that is larger."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in key]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        new[0] = bool(held) and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(key, cols, strict=True))
        at = np.flatnonzero(new)
        if len(at):
            yield pa.Table.from_batches([*held, batch.slice(0, int(at[-1]))])
            held = []
        held.append(batch.slice(int(at[-1]) if len(at) else 0))
    if held:
        yield pa.Table.from_batches(held)


def joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """The numbers of a column of packed values, one after another."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), dtype)


def squeezed(x: np.ndarray, dtype: type) -> bytes:
    """Numbers by planes of bytes, compressed: high bytes of small numbers cost next to nothing."""
    planes = np.ascontiguousarray(x.astype(dtype)).view(np.uint8).reshape(len(x), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(column: pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    """The numbers of each row of a column of ``squeezed`` values."""
    width = np.dtype(dtype).itemsize
    out = []
    for x in column.to_pylist():
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1))
    return out


def steps(x: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Differences within runs of the given lengths; each run begins with its first number."""
    out = np.diff(x, prepend=0)
    first = np.cumsum(run) - run
    out[first] = x[first]
    return out


def unsteps(x: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The inverse of ``steps``."""
    total = np.cumsum(x)
    first = np.cumsum(run) - run
    return total - np.repeat(total[first] - x[first], run)


def row_writer(schema: pa.Schema, rows_at_once: int = 256) -> tuple[Callable[..., None], Callable[[bool], Iterator[pa.RecordBatch]]]:
    """``put(value, ...)`` keeps a row; ``take(all)`` gives batches of what is kept."""
    kept: list[tuple] = []

    def put(*row: object) -> None:
        kept.append(row)

    def take(everything: bool = False) -> Iterator[pa.RecordBatch]:
        while len(kept) >= rows_at_once or everything and kept:
            part = kept[:rows_at_once]
            del kept[:rows_at_once]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)

    return put, take
