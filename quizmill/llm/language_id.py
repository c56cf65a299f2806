"""Language identification by nearest centroids.

A text's vector counts its character n-grams (1 to 3, letters lower-cased, other characters one
blank) hashed into ``DIMS`` dimensions, damped by a logarithm, weighted by inverse document frequency
and normalised. Each language has several centroids, from spherical k-means over a sample of labelled
documents of a bounded number of rows, chosen by a hash of the id; frequencies come from that
sample too, being part of the classifier. A text takes the language of the centroid with the greatest
cosine. It is rejected if it has no letter, or if that cosine is far under those that sampled texts of the
language and of similar length have: under a share of their low quantile.

Nulls: a null text has no letter. Rows with a null language or id teach nothing. Without labelled
rows every text is ``und`` with score 0. Ties go to the smaller code. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tasks import tidy

#: Dimensions of a vector, labelled rows of the sample (about, and at most twice), centroids of a language.
DIMS, SAMPLE, CENTROIDS = 2048, 4000, 3
#: Share of a language's texts that a centroid needs. Texts are rejected under ``SLACK`` times the ``LOW``
#: quantile of the cosines of texts of their length; a length with less than ``FEW`` texts has no quantile.
SHARE, SLACK, LOW, FEW = 0.05, 0.75, 0.02, 20
_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
_U = np.uint32


def vector(text: str | None) -> tuple[np.ndarray, int]:
    """Damped n-gram counts, and the number of letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), _U)
    letter = _LETTER[codes] if len(codes) else np.zeros(0, bool)
    letters = int(np.count_nonzero(letter))
    if not letters:
        return np.zeros(DIMS, np.float32), 0
    codes = np.where(letter, codes, _U(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each run of letters
    codes = np.concatenate(([_U(32)], codes[keep]))
    one = codes * _U(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> _U(15))) * _U(0x85EBCA77) + codes[1:]
    three = (two[:-1] ^ (two[:-1] >> _U(13))) * _U(0xC2B2AE3D) + codes[2:]
    counts = sum(np.bincount(((x * _U(0x27D4EB2F)) >> _U(21)).astype(np.int64), minlength=DIMS) for x in (one, two, three))
    return np.log1p(counts).astype(np.float32), letters


class Centroids:
    """A fitted classifier: a few arrays, whose size doesn't depend on the corpus."""

    def __init__(self, vectors: np.ndarray, letters: np.ndarray, langs: list[str]) -> None:
        self.names = sorted(set(langs))
        frequency = np.count_nonzero(vectors, axis=0)
        self.idf = (np.log((1 + len(vectors)) / (1 + frequency)) + 1).astype(np.float32)
        x = self._normal(vectors)
        langs_ = np.array(langs)
        self.centroids = np.concatenate([_spherical_means(x[langs_ == name]) for name in self.names])
        self.owner = np.repeat(np.arange(len(self.names)), CENTROIDS)
        best, name = self._best(x)
        length = np.log2(letters + 1).astype(np.int64)
        self.least = np.stack([self._limits(best[name == k], length[name == k]) for k in range(len(self.names))])

    @staticmethod
    def _limits(best: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The least cosine of a text that isn't rejected, by the binary logarithm of its letters."""
        low = {k: float(np.quantile(best[length == k], LOW)) for k in np.unique(length).tolist() if (length == k).sum() >= FEW}
        floor, out = min(low.values(), default=0.0), np.zeros(64)
        for k in range(64):
            # lengths with few texts have the limit of the shorter ones; the shortest have none
            floor = low.get(k, floor if low and k > min(low) else 0.0)
            out[k] = floor
        # shorter texts are never held to more than longer ones
        return SLACK * np.minimum.accumulate(out[::-1])[::-1]

    def _normal(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def _best(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = x @ self.centroids.T
        cosine = np.stack([cosine[:, self.owner == k].max(axis=1) for k in range(len(self.names))], axis=1)
        return cosine.max(axis=1), cosine.argmax(axis=1)

    def predict(self, vectors: np.ndarray, letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        score, name = self._best(self._normal(vectors))
        score = np.where(letters > 0, np.clip(score, 0, 1), 0.0).astype(np.float64)
        rejected = (letters == 0) | (score < self.least[name, np.log2(letters + 1).astype(np.int64)])
        return [self.names[k] if n else "und" for k, n in zip(name.tolist(), letters.tolist(), strict=True)], score, rejected


def _spherical_means(x: np.ndarray) -> np.ndarray:
    """``CENTROIDS`` unit vectors. They start from equal shares of the texts in the order of their cosine
    with the mean, so an odd text is no start; one that keeps few texts becomes the mean of all."""
    whole = x.mean(axis=0)
    means = np.stack([x[part].mean(axis=0) if len(part) else whole for part in np.array_split(np.argsort(-(x @ whole), kind="stable"), CENTROIDS)])
    for _ in range(10):
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
        near = (x @ means.T).argmax(axis=1)
        means = np.stack([x[near == k].mean(axis=0) if (near == k).sum() >= SHARE * len(x) else whole for k in range(CENTROIDS)])
    return means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = SAMPLE) -> Centroids | None:
    """A classifier from the labelled rows that aren't held out; None without any. ``size`` bounds the
    sample, about, and with it the number of languages: more raise an error."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().limit(size + 1).collect()}
    if not counts:
        return None
    if len(counts) > size:
        raise ValueError(f"more than {size} languages: a larger sample is needed")
    each = max(1, size // len(counts))
    parts = 1_000_000
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(parts, -(-each * parts // n)))])
    # by id and text, equal rows once: rows that share an id, or are repeated very often, don't fill the sample
    drawn = known.withColumn("draw", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    sample = drawn.where(F.pmod("draw", F.lit(parts)) < F.coalesce(share[F.col("lang")], F.lit(0))).dropDuplicates(["lang", "draw"])
    found = sample.mapInArrow(tidy(_vectors), "lang string, letters long, vector binary").where("letters > 0").limit(2 * size).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.lang, r.vector))
    return Centroids(np.stack([np.frombuffer(r.vector, np.float16).astype(np.float32) for r in found]), np.array([r.letters for r in found]), [r.lang for r in found])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [vector(t.as_py()) for t in batch.column("text")]
        if made:
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([n for _, n in made]), pa.array([v.astype(np.float16).tobytes() for v, _ in made])], names=["lang", "letters", "vector"])


def identify(docs: DataFrame, model: Centroids | None, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``row``, a struct of the other columns, with ``lang_pred``, ``score`` and ``rejected``; with
    ``text`` too where ``keep_text``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                made = [vector(t.as_py()) for t in part.column(1)]
                x, letters = np.stack([v for v, _ in made]), np.array([n for _, n in made])
                names, score, out = known.predict(x, letters) if known else (["und"] * len(made), np.zeros(len(made)), letters == 0)
                more = [part.column(1)] if keep_text else []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(score), pa.array(out), *more], names=["row", "lang_pred", "score", "rejected", "text"][: 4 + keep_text])

    out = StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(tidy(run), out.add("text", "string") if keep_text else out)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for each row; ``size`` bounds the sample that is fitted."""
    model = fit(docs, id_col, text_col, lang_col, size)
    found = identify(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
