"""Runs of repeated words: stretches whose words come again after a period, three times or more.

A run is a stretch with smallest period q and at least ``max(least, 3 * q)`` words that no neighbouring
word extends. Periods up to ``SHORT`` are found by comparing each text with itself at that lag. For longer
ones there are scales S = 64, 128, ..., each for the periods in (S/2, S]: of the hashes of S/6 consecutive
words, the least one of every S/12 neighbours is a minimizer (the last of equal ones). In a run the
minimizers repeat at period distance, so pairs of equal ones that lie (S/2, S] apart give lags; each is
extended both ways as far as the words agree at that lag.

Why no run is lost: the windows that begin in one period of a run, S/12 words into it, choose places that
the windows one period on choose too, as 3/12 S + 1.5/6 S <= S/2 < q words suffice for all windows that
matter. A minimizer that is followed by an equal one within half its length is part of a shorter
repetition and is left out, else such a stretch would pair with itself everywhere; were all minimizers of
a period left out, the run would have that shorter period. What is left lies more than S/12 apart, so a
place has at most twelve partners within S, and pairs grow with the text.

Words are told apart by 64-bit hashes. Lengths come from hashes of word sequences and are compared word by
word afterwards. Texts without words or null have no runs; rows are judged each on its own, so ids may
repeat or be null; columns other than id and text aren't read. A text is held by one task, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tasks import tidy
from .wordhash import Words, prefix_powers, scramble, words_of

#: Longest period that is looked for at its lag directly.
SHORT = 32

RUNS = "array<struct<start: long, length: long, period: long>>"


def collapse_runs(docs: DataFrame, least: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row: its runs by start and period, and the words that
    no run holds after its first period, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column(1)):
                text, start, length, period = runs_of(words, least)
                first = np.searchsorted(text, np.arange(words.n + 1))
                pairs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
                kept = [_collapsed(words, i, start[a:b], length[a:b], period[a:b]) for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))]
                at = np.cumsum([0, *map(len, kept)], dtype=np.int64)
                collapsed = pa.LargeStringArray.from_buffers(words.n, pa.py_buffer(at), pa.py_buffer(b"".join(kept)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.lo, words.n), pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pairs), collapsed.cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string")


def _collapsed(words: Words, i: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    lo, hi = words.first[i], words.first[i + 1]
    if lo == hi:
        return b""
    own = words.data[words.start[lo] : words.end[hi - 1]].tobytes().split()
    if len(start):
        keep = np.ones(len(own), bool)
        for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
            keep[s + q : s + n] = False
        own = [own[k] for k in np.flatnonzero(keep)]
    return b" ".join(own)


class Sequences:
    """Hashes of the ``n`` words from each place on, from sums that are made once."""

    def __init__(self, h: np.ndarray) -> None:
        up, self.down = prefix_powers(len(h) + 1)
        self.total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[:-1], out=self.total[1:])

    def of(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return (self.total[at + n] - self.total[at]) * self.down[at]


def runs_of(words: Words, least: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (word of its text), length and period of all runs, sorted by these."""
    count = np.diff(words.first)
    text = np.repeat(np.arange(words.n), count)
    found = [_at_lag(words.hash, text, q, least) for q in range(1, min(SHORT, int(count.max(initial=0)) // 3) + 1)]
    scale, sequences = 2 * SHORT, Sequences(words.hash)
    while len(own := np.flatnonzero(count > 3 * (scale // 2))):
        at, lag = minimizer_pairs(words, sequences, own, scale)
        found.append(_extended(words, sequences, text, at, lag, least))
        scale *= 2
    lo, hi, lag = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    # a stretch that is found at several lags has the smallest as its period
    order = np.lexsort((lag, hi, lo))
    lo, hi, lag = lo[order], hi[order], lag[order]
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    lo, hi, lag = lo[new], hi[new], lag[new]
    order = np.lexsort((lag, lo))
    lo, hi, lag = lo[order], hi[order], lag[order]
    return text[lo], lo - words.first[text[lo]], hi - lo, lag


def _at_lag(h: np.ndarray, text: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and lag of the stretches that are long enough, by a direct scan."""
    same = np.flatnonzero((h[q:] == h[:-q]) & (text[q:] == text[:-q]))
    if not len(same):
        return (np.zeros(0, np.int64),) * 3
    new = np.concatenate(([True], (same[1:] != same[:-1] + 1) | (text[same[1:]] != text[same[:-1]])))
    lo, hi = same[new], same[np.concatenate((new[1:], [True]))] + 1 + q
    enough = hi - lo >= max(least, 3 * q)
    return lo[enough], hi[enough], np.full(int(enough.sum()), q, np.int64)


def minimizer_pairs(words: Words, sequences: Sequences, own: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of minimizers that come again, and the lags, of the texts ``own``."""
    wide, window = scale // 6, scale // 12
    count = words.first[own + 1] - words.first[own]
    text = np.repeat(own, count)
    at = np.repeat(words.first[own] - (np.cumsum(count) - count), count) + np.arange(len(text))
    fits = at + wide <= words.first[text + 1]
    key = np.full(len(at), np.iinfo(np.uint64).max, np.uint64)
    key[fits] = scramble(sequences.of(at[fits], wide))
    # the last of the least keys of every window, by windows of doubled size
    best, size = np.arange(len(at)), 1
    join = lambda a, b: np.where(key[b] <= key[a], b, a)
    while 2 * size <= window:
        best, size = join(best[:-size], best[size:]), 2 * size
    if size < window:
        best = join(best[: len(best) - (window - size)], best[window - size :])
    last = np.arange(len(best)) + window - 1
    best = np.unique(best[fits[last] & (text[last] == text[: len(best)])])
    order = np.lexsort((best, key[best], text[best]))
    place = best[order]
    like = lambda a, b: (key[a] == key[b]) & (text[a] == text[b])
    go = np.zeros(len(place), bool)
    go[:-1] = like(place[:-1], place[1:]) & (2 * (place[1:] - place[:-1]) <= wide)
    place = place[~go]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for j in range(1, len(place)):
        near = like(place[:-j], place[j:]) & (place[j:] - place[:-j] <= scale)
        if not near.any():
            break
        a, b = place[:-j][near], place[j:][near]
        far = b - a > scale // 2
        found.append((at[a[far]], b[far] - a[far]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _extended(words: Words, sequences: Sequences, text: np.ndarray, at: np.ndarray, lag: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches around ``at`` whose words agree at ``lag``."""
    first, last = words.first[text[at]], words.first[text[at] + 1]
    right = _longest(last - at - lag, lambda n, k: sequences.of(at[k], n) == sequences.of(at[k] + lag[k], n))
    left = _longest(at - first, lambda n, k: sequences.of(at[k] - n, n) == sequences.of(at[k] + lag[k] - n, n))
    lo, hi = at - left, at + lag + right
    enough = hi - lo >= np.maximum(least, 3 * lag)
    rows = np.unique(np.stack([lo[enough], hi[enough], lag[enough]], axis=1), axis=0)
    h, out = words.hash, []
    for s, e, q in rows.tolist():
        if np.array_equal(h[s : e - q], h[s + q : e]):
            out.append((s, e, q))
        else:  # hashes of sequences met: all stretches of this text at this lag, word by word
            a, b = words.first[text[s]], words.first[text[s] + 1]
            out += [(x + a, y + a, q) for x, y, _ in zip(*_at_lag(h[a:b], np.zeros(b - a, np.int64), q, least), strict=True)]
    return tuple(np.array(sorted(set(out)), np.int64).reshape(-1, 3).T)


def _longest(most: np.ndarray, agree) -> np.ndarray:
    """The greatest length up to ``most`` for which ``agree(length, pair)`` holds, if it holds for all shorter ones."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    while len(k := np.flatnonzero(low < high)):
        middle = (low[k] + high[k] + 1) // 2
        ok = agree(middle, k)
        low[k[ok]], high[k[~ok]] = middle[ok], middle[~ok] - 1
    return low
