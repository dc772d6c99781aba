"""Exact search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import maxscore


def plain(rows, is_query, k):
    rows = [(i, np.floor(1024 * np.array(v, np.float64)).astype(object)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in rows:
        if is_query(i):
            asked[i] = min(asked.get(i, v), v, key=list)
    out = []
    for q, w in asked.items():
        scores = sorted((-min(max(sum(int(a) * int(b) for a, b in zip(w, v)), -(2**63)), 2**63 - 1), i) for i, v in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def rows_of(kind):
    draw = np.random.default_rng(4)
    if kind == "dense":
        vectors = draw.normal(size=(900, 12)).astype(np.float32)
    elif kind == "sparse":
        vectors = draw.normal(size=(900, 30)) * (draw.random((900, 30)) < 0.1)
    else:
        vectors = draw.integers(-1, 2, size=(900, 4)).astype(float)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(draw.permutation(2000)[:900] - 500, vectors)]
    zero = [0.0] * len(rows[0][1])
    return rows + [(None, zero), (3000, None), (3001, [float("nan")] * 4), (3002, [None, 1.0]), (3003, [float("inf")]), (3004, []), (3005, [1.0]), (3006, zero), rows[0], rows[5]]


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties"])
@pytest.mark.parametrize("blocks", [1, 3])
def test_search(spark, monkeypatch, kind, blocks):
    monkeypatch.setattr(maxscore, "LEAST_SHARDS", 2)
    monkeypatch.setattr(maxscore, "FIRST_STRIP", 32)
    monkeypatch.setattr(maxscore, "BLOCK_ROWS", 1 << 12 if blocks == 1 else 40)
    rows = rows_of(kind)
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int").repartition(4)
    got = sorted(map(tuple, maxscore.search(vectors, F.col("id") % 10 == 0).collect()))
    assert got == plain(rows, lambda i: i % 10 == 0, 10)


@pytest.mark.parametrize("size", [65536.5, 1e5, 1e12, 1e200])
def test_large_components(spark, monkeypatch, size):
    """Scores beyond doubles, and beyond 64 bits, next to small ones."""
    monkeypatch.setattr(maxscore, "LEAST_SHARDS", 2)
    monkeypatch.setattr(maxscore, "FIRST_STRIP", 16)
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(120, 3)) * np.where(draw.random((120, 1)) < 0.4, size, 1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(500, [size, 0.0, 1.0]), (510, [size, size, size]), (520, [-size] * 3), (530, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, maxscore.search(table, F.col("id") % 10 == 0).collect()))
    assert got == plain(rows, lambda i: i % 10 == 0, 10)


def test_few_and_none(spark):
    vectors = spark.createDataFrame([(0, [1.0, -0.5]), (1, [0.5, 0.25]), (100, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, maxscore.search(vectors, F.col("id") % 100 == 0).collect()))
    assert got == [(0, 1, 1, 384 * 1024), (0, 2, 100, -(1024**2)), (100, 1, 1, -512 * 1024), (100, 2, 0, -(1024**2))] or got == plain(
        [(0, [1.0, -0.5]), (1, [0.5, 0.25]), (100, [-1.0, 0.0])], lambda i: i % 100 == 0, 10
    )
    assert maxscore.search(vectors.limit(0), F.col("id") % 100 == 0).collect() == []
    assert maxscore.search(vectors, F.col("id") == 7).collect() == []


def test_bounds_leave_work_out(monkeypatch):
    """With a score to reach, terms of small bounds are probed for few vectors only."""
    draw = np.random.default_rng(0)
    matrix = (draw.normal(size=(4000, 20)) * 100 * np.linspace(3, 0.05, 20)).astype(np.int64)
    shard = maxscore.Shard(np.arange(4000), matrix)
    seen = []
    strip = shard.strip

    def watched(*args):
        seen.append(strip(*args))
        return seen[-1]

    shard.strip = watched
    ids, scores = shard.top(-1, matrix[17], 10)
    want = sorted((-int(s), i) for i, s in enumerate(matrix @ matrix[17]))[:10]
    assert list(zip((-scores).tolist(), ids.tolist())) == want
    assert sum(len(found) for found, _ in seen[1:]) < 100
