"""Packing with few open bins, short runs and small groups, so that bins close and groups are many."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quizmill.llm.best_fit import OpenBins, pack, pack_documents


def plain(lengths, limit, most):
    """Online best fit with lists: the fullest bin that fits; the fullest closes when all are open."""
    bins, out = {}, []
    for n in lengths:
        fits = [b for b, free in bins.items() if free >= n]
        free_of = bins.get
        if fits:
            b = min(fits, key=free_of)
        else:
            if len(bins) == most and n < limit:
                del bins[min(bins, key=free_of)]
            b = len({x for x, _ in out})
            bins[b] = limit
        out.append((b, limit - bins[b]))
        bins[b] -= n
        if not bins[b]:
            del bins[b]
    return out


@pytest.mark.parametrize("most", [1, 3, 50, 600])
def test_best_fit_with_a_bound(most):
    lengths = np.random.default_rng(most).integers(1, 101, 600).tolist()
    bins = OpenBins(100, most)
    got = [bins.add(n) for n in lengths]
    fill, sizes, want = Counter(), Counter(), plain(lengths, 100, most)
    for (s, o), n in zip(got, lengths, strict=True):
        assert fill[s] == o
        fill[s] += n
        sizes[s] += 1
    assert max(fill.values()) <= 100 and bins.open <= most
    # of bins equally full either may be taken: the fills agree all the same
    expected = Counter()
    for (b, _), n in zip(want, lengths, strict=True):
        expected[b] += n
    assert sorted(fill.values()) == sorted(expected.values())
    assert (bins.closed > 0) == (most < 600)


def test_groups_and_runs(spark):
    draw = np.random.default_rng(2)
    lengths = np.minimum(draw.geometric(1 / 300, 6000), 1000).tolist()
    found = spark.createDataFrame([(i % 7, 0, 0, n, 0) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = pack(found, 1000, task_tokens=400_000, open_bins=20, run=64).collect()
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert sorted(r.length for r in rows) == sorted(lengths) and max(fill.values()) <= 1000
    assert len({r.sequence_id >> 40 for r in rows}) == -(-sum(n for n in lengths if n < 1000) // 400_000)
    assert len(fill) <= 1.03 * -(-sum(lengths) // 1000)


def test_equal_rows_spread(spark):
    """Ten thousand copies of one piece don't fall into one group."""
    found = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(30).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    groups = Counter(r.sequence_id >> 40 for r in pack(found, 100, task_tokens=30_000).collect())
    assert len(groups) == 10 and max(groups.values()) < 1300


@pytest.mark.parametrize("kind", ["short", "string", "decimal(5,0)"])
def test_other_types_of_id(spark, kind):
    import public_tokenizers

    docs = spark.createDataFrame([(1, "one"), (2, None)], "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    rows = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert rows.schema["doc_id"].dataType == docs.schema["doc_id"].dataType and sorted(int(r.doc_id) for r in rows.collect()) == [1, 2]
