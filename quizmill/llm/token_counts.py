"""Token counts of a BPE model by rank-synchronous merging of arrays.

A text is cut where no piece of the vocabulary spans: before each run of the blank sign and around
line ends. The distinct pre-tokens of a batch are held as ragged arrays of symbol numbers; in each
round the lowest-ranked adjacent pair of every sequence is merged at once (the leftmost of equal
ranks), until no sequence has a pair that the vocabulary knows, and the surviving symbols are
counted. A symbol outside the vocabulary counts as its UTF-8 bytes where the model falls back to
bytes. A bounded table keeps the counts of pre-tokens that came first, which are the frequent ones.

Null texts count as empty. Nothing is truncated. Columns other than id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tasks import tidy

#: Pre-tokens whose counts a Python worker keeps.
KEPT = 300_000
#: Symbols of pre-tokens that are merged together.
AT_ONCE = 1 << 20
_BLANK = "▁"


class PieceCounter:
    """Counts tokens as sentencepiece does for a BPE model with identity normalisation."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        usual = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in usual}
        self.bytes = any(model.is_byte(i) for i in range(size))
        self.symbol = {p: k for k, p in enumerate(pieces)}
        self.cut_lines = not any("\n" in p for p in pieces)
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError("the vocabulary has pieces that span words")
        rank = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        pairs = sorted({(self.symbol[p[:k]] * len(pieces) + self.symbol[p[k:]], rank[s], self.symbol[p]) for p, s in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces})
        self.width = len(pieces)
        self.pair, self.rank, self.merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.kept: dict[str, int] = {}

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [self._cut(t) if t else ([], 0) for t in texts]
        kept = self.kept
        new = list({w for words, _ in cut for w in words if w not in kept})
        now = dict(zip(new, self._merge_all(new), strict=True))
        if len(kept) + len(now) <= KEPT:
            kept.update(now)
        elif len(kept) < KEPT:
            kept.update(list(now.items())[: KEPT - len(kept)])
        of = kept.__getitem__ if now.keys() <= kept.keys() else lambda w: kept[w] if w in kept else now[w]
        return [sum(map(of, words)) + more for words, more in cut]

    def _cut(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and tokens that are cut off besides."""
        s = _BLANK + text.replace(" ", _BLANK)
        lines = 0
        if self.cut_lines:
            lines = s.count("\n")
            if _BLANK * 2 not in s:
                return s.replace(_BLANK, "\n" + _BLANK).split("\n"), lines
            return re.split(f"\n|(?<=[^{_BLANK}\n])(?={_BLANK})", s), lines
        return re.split(f"(?<=[^{_BLANK}])(?={_BLANK})", s), 0

    def _merge_all(self, words: list[str]) -> Iterator[int]:
        lo = size = 0
        for hi, w in enumerate(words):
            size += len(w)
            if size >= AT_ONCE:
                yield from self._merge(words[lo : hi + 1])
                lo, size = hi + 1, 0
        yield from self._merge(words[lo:])

    def _merge(self, words: list[str]) -> list[int]:
        if not words:
            return []
        known = self.symbol
        text = "".join(words)
        unknown: dict[str, int] = {}
        symbols = np.fromiter((known[c] if c in known else -1 - unknown.setdefault(c, len(c.encode()) if self.bytes else 1) for c in text), np.int64, len(text))
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        counts = np.zeros(len(words), np.int64)
        while len(symbols):
            # rank of the pair that starts at each symbol
            code = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.pair, code), len(self.pair) - 1)
            ok = (self.pair[at] == code) & (word[:-1] == word[1:]) & (symbols[:-1] >= 0) & (symbols[1:] >= 0)
            place = np.flatnonzero(ok)
            open_word = np.zeros(len(words), bool)
            open_word[word[place]] = True
            done = ~open_word[word]
            if done.any():  # sequences without a pair leave; the others go on
                np.add.at(counts, word[done], np.where(symbols[done] >= 0, 1, -1 - symbols[done]))
            if not len(place):
                break
            rank, owner = self.rank[at[place]], word[place]
            first = np.concatenate(([True], owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, np.flatnonzero(first))
            hit = np.flatnonzero(rank == least[np.cumsum(first) - 1])
            hit = hit[np.concatenate(([True], owner[hit][1:] != owner[hit][:-1]))]
            left = place[hit]
            symbols[left] = self.merged[at[left]]
            stay = ~done
            stay[left + 1] = False
            symbols, word = symbols[stay], word[stay]
        return counts.tolist()


@cache
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row; ``model_path`` is read on each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                tokens = counter.count(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
        .mapInArrow(tidy(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
