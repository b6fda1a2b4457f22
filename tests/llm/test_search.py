"""MaxScore search against all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, every=50, k=5):
    fine = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    found = {}
    for i, q in fine:
        if i is not None and i % every == 0:
            for j, v in fine:
                if j != i:
                    score = min(max(sum(a * b for a, b in zip(q, v, strict=False)), -2**63), 2**63 - 1)
                    found.setdefault(i, set()).add((-score, j is None, j or 0, j))
    return sorted((i, r, m[3], -m[0]) for i, ms in found.items() for r, m in enumerate(sorted(ms, key=lambda m: m[:3])[:k], 1))


def found(spark, rows, schema=SCHEMA, **params):
    from lifetide.llm import maxscore
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in ("id", "vec", "score", "rank", "_block")})
    all_rows = maxscore.prepared(df)
    out = maxscore.search(all_rows, all_rows.filter(F.col("id") % 50 == 0), **params)
    return sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())


def vectors(seed, n=900, width=24):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.3) for _ in range(width)] for _ in range(6)]
    return [(i, [c + rnd.gauss(0, 0.2) for c in rnd.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("cell", [1 << 22, 1500])
def test_search(spark, cell):
    """One block and shard, and many."""
    rows = vectors(1)
    assert found(spark, rows, cell=cell) == brute(rows)


def test_odd_vectors(spark):
    """Nulls, odd components, other lengths, ties, copies, several vectors of an id, no id."""
    rows = vectors(2, 120, 4) + [(1000, [0.1] * 4)] * 3 + [(i, [0.9] * 4) for i in range(200, 260)]
    rows += [(50, None), (100, [math.nan, 1.0]), (150, [1.0, math.inf]), (1, [None, 2.0]), (1050, []), (1100, [1.0] * 9), (2, [3.0] * 2),
             (None, [2.0] * 4), (None, [2.0] * 4), (None, None), (1150, [0.5] * 4), (1150, [-0.5] * 4), (3, [5.0] * 300), (1200, [0.0] * 4)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, cell=64) == brute(rows)


def test_large_components(spark):
    """Scores beyond 2^24, 2^53 and 2^63 are exact, or the largest long."""
    rnd = random.Random(3)
    for scale in (1e3, 1e6, 1e15):
        rows = [(i, [rnd.choice((-1, 1)) * rnd.random() * scale for _ in range(5)]) for i in range(120)] + [(i, [rnd.random() for _ in range(5)]) for i in range(120, 240)]
        assert found(spark, rows) == brute(rows)


def test_floats_and_whole_numbers(spark):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in vectors(4, 150, 8)]
    assert found(spark, rows, "vec_id long, embedding array<float>") == brute(rows)
    rows = [(i, [i % 7, -(i % 5), 3]) for i in range(120)]
    assert found(spark, rows, "vec_id int, embedding array<int>") == brute(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_terms_are_skipped():
    """Vectors that cannot reach the threshold are left out early, the others are scored in full."""
    from lifetide.llm.maxscore import max_score
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(size=(3000, 32)) * 100).astype(np.float32)
    q = np.floor(np.abs(rng.normal(size=32)) ** 4 * 50).astype(np.float32)
    postings = np.ascontiguousarray(v.T)
    bounds = np.maximum(q * postings.max(axis=1), q * postings.min(axis=1))
    order = np.argsort(bounds)
    sums = np.cumsum(bounds[order])
    scores = v @ q
    best = np.sort(scores)[-5]
    at, score = max_score(q, bounds, order, sums, postings, best)
    assert sorted(at) == sorted(np.flatnonzero(scores >= best)) and (score == scores[at]).all()
    assert max_score(q, bounds, order, sums, postings, sums[-1] + 1) is None


def test_cell_of_nothing():
    from lifetide.llm.maxscore import search_cell
    empty = pa.table({"id": pa.array([], pa.int64()), "vec": pa.array([], pa.list_(pa.float64()))})
    assert search_cell(empty, empty, 5).num_rows == 0
