"""Operator 11 against scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import top_k_search
from strata.llm.top_k_search import Block, heads, matrix, sufficient, top_k

SCHEMA = "vec_id long, embedding array<double>, rank string, _q int, score double"


def framed(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=5, scale=256):
    sound = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for at, (query, q) in enumerate(sound):
        if query is None or query % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(q, v, strict=False)), i is None, i) for n, (i, v) in enumerate(sound) if n != at
        ]
        best = sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        found += [(query, rank, i, -less) for rank, (less, _, i) in enumerate(best, 1)]
    return sorted(found, key=str)


def searched(spark, rows, **options):
    found = top_k(framed(spark, rows), F.col("vec_id") % 50 == 0, **options)
    return sorted((tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def unit(rng, size=16):
    v = [rng.gauss(0, 1) for _ in range(size)]
    return [x / math.sqrt(sum(y * y for y in v)) for x in v]


def test_random_vectors_in_several_blocks(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, unit(rng)) for i in range(600)]
    assert searched(spark, rows) == brute(rows)
    monkeypatch.setattr(top_k_search, "QUERY_BLOCK", 5)
    assert searched(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(4)
    nan, inf = float("nan"), float("inf")
    rows = [(None, unit(rng)), (None, unit(rng)), (50, None), (100, [None, 0.1]), (150, [nan]), (200, [inf, 1.0])]
    rows += [(250, []), (300, [0.0] * 16), (350, [0.5]), (350, [0.5]), (400, unit(rng, 40)), (1, None), (2, [-inf])]
    rows += [(i, unit(rng)) for i in range(401, 460)]
    assert searched(spark, rows) == brute(rows)


def test_a_vector_that_most_rows_share_and_ties(spark):
    rng = random.Random(7)
    hot = unit(rng)
    rows = [(i, hot if i % 3 else unit(rng)) for i in range(300)] + [(50, hot), (50, hot), (7, hot)]
    rows += [(1000 + i, [0.0, float(i % 2)]) for i in range(100)]
    assert searched(spark, rows) == brute(rows)


def test_few_or_no_vectors(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert searched(spark, [(0, [1.0])]) == []
    rows = [(0, [1.0, 2.0]), (3, [-1.0, 0.5]), (4, [-1.0, 0.5])]
    assert searched(spark, rows) == brute(rows) == [(0, 1, 3, 0), (0, 2, 4, 0)]


@pytest.mark.parametrize("large", [1e3, 1e5])
def test_wide_scores_stay_exact(spark, large):
    rng = random.Random(2)
    rows = [(i, [large * rng.uniform(-1, 1) for _ in range(8)]) for i in range(200)]
    assert searched(spark, rows, scale=1 << 8) == brute(rows)
    with pytest.raises(ArithmeticError):
        searched(spark, [(0, [1e15]), (1, [1e15])])


def test_the_cutoff_collects_few_entries_and_loses_none():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(6000, 64))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64)
    block = Block(vectors[:40], 64 * int(np.abs(vectors).max()) ** 2)
    import pyarrow as pa

    batches = [
        pa.RecordBatch.from_pydict({"_c": np.arange(a, a + 1500), "_v": pa.array(vectors[a : a + 1500].tolist())})
        for a in range(0, 6000, 1500)
    ]
    assert (matrix(batches[1].column("_v"), 64) == vectors[1500:3000]).all()
    scores = vectors[:40] @ vectors.T
    cutoff = np.full(40, np.iinfo(np.int64).min)
    (sent,) = heads(block, 6)(iter(batches))
    for q in range(40):
        cutoff[q] = sorted(np.asarray(sent.column("_score"))[np.asarray(sent.column("_q")) == q])[-6]
    exact = np.sort(scores, axis=1)[:, -6]
    assert (cutoff <= exact).all()
    entries = [b.to_pandas() for b in sufficient(block, cutoff)(iter(batches))]
    assert sum(map(len, entries)) < 0.1 * scores.size
    held = {(q, c): (low, high) for e in entries for q, c, low, high in e.itertuples(index=False)}
    for q, c in zip(*np.nonzero(scores >= exact[:, None]), strict=True):
        low, high = held[q, c]
        assert low <= scores[q, c] <= high
