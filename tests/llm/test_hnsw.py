"""Graph search against brute force."""

import numpy as np
import pytest

from loanloom.llm import hnsw
from loanloom.llm.storage import Scratch


def brute(rows, queries, k):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good.get(i, v), v)
    out = []
    for q in queries:
        if q in good:
            near = sorted((float(np.sqrt(((np.array(v) - np.array(good[q])) ** 2).sum())), i)
                          for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near)]
    return out


def solve(spark, rows, queries, k):
    frame = spark.createDataFrame([(v, 0, i) for i, v in rows], "embedding array<float>, rank int, vec_id bigint").repartition(3)
    asked = frame.where(frame.vec_id.isin(list(queries)))
    found = hnsw.nearest(frame, asked, k, Scratch(spark, "hnsw")).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    return (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, d))).astype(np.float32).tolist()


def test_small_shards_are_exact_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 40)
    monkeypatch.setattr(hnsw, "QUERY_PART", 3)
    rows = list(enumerate(vectors(1, 150, 6)))
    hot = rows[7][1]
    rows += [(1000 + i, hot) for i in range(60)]  # many copies of one vector
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [float("nan")] * 6), (2003, [None] * 6), (2004, [float("inf")] + [1.0] * 5),
             (2005, []), (2006, [1.0, 2.0]), (2007, [1.0, 2.5]), (None, hot), (3, rows[3][1]), (2008, [0.0, -0.0]), (2009, [-0.0, 1.0]), (2010, [0.0, 1.0])]
    queries = [0, 7, 50, 1005, 1059, 2000, 2001, 2006, 2009]
    got, want = solve(spark, rows, queries, 10), brute(rows, queries, 10)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=1e-12, atol=0)


@pytest.mark.parametrize("n, d", [(3000, 32)])
def test_recall(spark, n, d):
    rows = list(enumerate(vectors(2, n, d)))
    queries = range(0, n, 100)
    got, want = solve(spark, rows, queries, 10), brute(rows, queries, 10)
    found = {x[::2] for x in [(a, 0, c) for a, _, c, _ in got]}
    assert sum((a, c) in found for a, _, c, _ in want) >= 0.95 * len(want)


def test_each_shard_travels_once(spark, monkeypatch):
    """However many queries there are, the plan holds one row per shard and dimension of the index."""
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 40)
    scratch = Scratch(spark, "hnsw")
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors(4, 120, 6))], "first bigint, vector array<double>")
    index = scratch.store(hnsw.build_index(rows, 3))
    queries = rows.withColumnRenamed("first", "id")
    seen = []
    plain = type(index).unionByName
    monkeypatch.setattr(type(index), "unionByName", lambda a, b, **o: seen.append(a.count()) or plain(a, b, **o))
    assert hnsw.search_index(index, queries, 3, 5).count() == 120 * 3 * 5
    monkeypatch.setattr(hnsw, "QUERY_PART", 60)
    assert hnsw.search_index(index, queries, 3, 5).count() == 120 * 3 * 5
    assert seen == [3, 6]


def test_graph_survives_flattening():
    x = np.array(vectors(3, 300, 8))
    graph = hnsw.Graph(x)
    again = hnsw.Graph.of(x, graph.flat())
    assert all(graph.search(q, 5) == again.search(q, 5) for q in x[:20])


def test_empty(spark):
    assert solve(spark, [], [1], 10) == []
    assert solve(spark, [(1, [1.0])], [1], 10) == []
