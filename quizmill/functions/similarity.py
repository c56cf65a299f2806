"""The token-set ratio of many pairs of texts at once.

Words become ranks in the batch's sorted list of words, sets of words become sorted numbers, and the longest
common subsequences of all pairs go forward together: a pair's shorter text is the bits of one to four
64-bit numbers, and step ``j`` takes in character ``j`` of every pair's longer text. Few pairs are left for the
longest texts; those, and pairs whose shorter text has over 256 characters, go one by one through whole numbers
of any length (``common_length``).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: 64-bit numbers a pair may have, and pairs below which a step for all of them doesn't pay.
WORDS, FEW = 4, 32
#: Masks, one a pair, letter and number, that are held together.
MASKS = 1 << 17


def common_length(a: Sequence, b: Sequence) -> int:
    """Length of the longest common subsequence, by bit-parallel columns."""
    if not len(a) or not len(b):
        return 0
    masks: dict = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & masks.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``first[i], first[i] + 1, ...``, ``n[i]`` of them, for each ``i``, one after the other."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def _together(chars: np.ndarray, letters: int, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, words: int) -> np.ndarray:
    """The lengths for pairs whose shorter texts ``chars[a:a + n]`` fit into ``words`` numbers; longest ``m`` first."""
    masks = np.zeros((words, len(n) * letters), np.uint64)  # of each pair and letter
    own = np.arange(len(n)) * letters
    for i in range(n.max()):
        at = np.flatnonzero(n > i)
        masks[i >> 6, own[at] + chars[a[at] + i]] |= np.uint64(1 << (i & 63))
    free = np.full((words, len(n)), np.iinfo(np.uint64).max)
    left = np.searchsorted(-m, -np.arange(m[0]), side="left")  # pairs that have a character j
    for j, k in enumerate(left.tolist()):
        at = own[:k] + chars[b[:k] + j]
        carry = None
        for w in range(words):
            now = free[w, :k]
            hit = now & masks[w].take(at)
            total = now + hit
            if w + 1 < words:
                over = total < hit
            if carry is not None:
                total += carry
                if w + 1 < words:
                    over |= total < carry
            free[w, :k] = total | (now ^ hit)
            carry = over.astype(np.uint64) if w + 1 < words else None
    return np.bitwise_count(~free).sum(axis=0, dtype=np.int64)


def common_lengths(chars: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Longest common subsequences of ``chars[a:a + n]`` and ``chars[b:b + m]`` (code points), all pairs at once."""
    a, n, b, m = np.where(n <= m, a, b), np.minimum(n, m), np.where(n <= m, b, a), np.maximum(n, m)
    out = np.zeros(len(n), np.int64)
    if not len(chars):
        return out
    known = np.zeros(chars.max() + 1, np.int64)
    known[chars] = 1
    letters = int(known.sum())
    chars = (np.cumsum(known) - 1)[chars]
    size = -(-n // 64)
    for words in range(1, WORDS + 1):
        which = np.flatnonzero(size == words)
        which = which[np.argsort(-m[which], kind="stable")]
        alone, which = which[:FEW], which[FEW:]
        size[alone] = WORDS + 1
        step = max(1, MASKS // (letters * words))
        for lo in range(0, len(which), step):
            at = which[lo : lo + step]
            out[at] = _together(chars, letters, a[at], n[at], b[at], m[at], words)
    for i in np.flatnonzero(size > WORDS).tolist():
        out[i] = common_length(chars[a[i] : a[i] + n[i]].tolist(), chars[b[i] : b[i] + m[i]].tolist())
    return out


def token_set_ratios(x: Sequence[str | None], y: Sequence[str | None]) -> np.ndarray:
    """Similarity from 0 to 100 of each pair of texts as sets of words; 100 if one set holds the other,
    0 where a text is null or has no word."""
    score = np.zeros(len(x))
    texts = [t or "" for side in (x, y) for t in side]
    held = " ".join(texts)
    mark = next(c for c in map(chr, range(sys.maxunicode)) if not c.isspace() and c not in held)  # ends a text
    flat = f" {mark} ".join([*texts, ""]).split()
    words = pc.split_pattern(pa.array([" ".join(flat)], pa.large_string()), " ").flatten()
    end = np.flatnonzero(pc.equal(words, mark).to_numpy(zero_copy_only=False))
    count = np.diff(end, prepend=-1) - 1
    coded = words.filter(pc.not_equal(words, mark)).dictionary_encode()
    if not len(coded):
        return score
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    # each word of the list with a blank after it
    listed = coded.dictionary.take(order)
    chars = np.frombuffer(" ".join([*listed.to_pylist(), ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
    width = pc.utf8_length(listed).to_numpy().astype(np.int64) + 1
    begin = np.cumsum(width) - width
    # (pair, word, side), each once, in order
    owner = np.repeat(np.concatenate((np.arange(len(x)), np.arange(len(x)))), count)
    side = np.repeat(np.arange(2), (count[: len(x)].sum(), count[len(x) :].sum()))
    bits = len(order).bit_length()
    key = np.sort(owner << bits + 1 | rank[coded.indices.to_numpy()] << 1 | side)
    key = key[np.diff(key, prepend=-1) > 0]
    pair, word, side = key >> bits + 1, key >> 1 & (1 << bits) - 1, key & 1
    same = key[1:] >> 1 == key[:-1] >> 1
    both = np.zeros(len(key), bool)
    both[1:] |= same
    both[:-1] |= same
    groups = [both & (side == 0), ~both & (side == 0), ~both & (side == 1)]
    number = [np.bincount(pair[g], minlength=len(x)) for g in groups]
    n, left, right = (np.maximum(np.bincount(pair[g], width[word[g]], len(x)).astype(np.int64) - 1, 0) for g in groups)
    here = (count[: len(x)] > 0) & (count[len(x) :] > 0)
    held = here & (number[0] > 0) & ((number[1] == 0) | (number[2] == 0))
    score[held] = 100.0
    open_ = here & ~held
    gap = (number[0] > 0).astype(np.int64)
    p, q = n + gap + left, n + gap + right
    whole = np.zeros(len(x), np.int64)
    start, flat = [], []
    for g in groups[1:]:
        g = g & open_[pair]
        taken = chars[ragged(begin[word[g]], width[word[g]])]
        total = np.bincount(pair[g], width[word[g]], len(x)).astype(np.int64)
        start.append(np.cumsum(total) - total + sum(map(len, flat)))
        flat.append(taken)
    at = np.flatnonzero(open_)
    whole[at] = common_lengths(np.concatenate(flat), start[0][at], left[at], start[1][at], right[at])
    n, p, q, gap, whole = n[at], p[at], q[at], gap[at], whole[at]
    best = 200.0 * (n + gap + whole) / (p + q)
    for other in (p, q):
        best = np.maximum(best, np.where(gap > 0, 200.0 * n / (n + other), 0.0))
    score[at] = best
    return score
