import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import knn


def plain(rows, queries, k):
    whole = [(i, np.floor(1024 * np.array(v, float)).astype(object)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if queries(q):
            n = lambda b: sum(x * y for x, y in zip(a, b))
            best = sorted(((-n(b), i) for i, b in whole if i != q))[:k]
            out.extend((q, r + 1, i, int(-s)) for r, (s, i) in enumerate(best))
    return sorted(out)


@pytest.mark.parametrize(("part", "pivots"), [(4096, 1024), (32, 8), (64, 1)])
def test_clusters_ties_and_parts(spark, monkeypatch, part, pivots):
    monkeypatch.setattr(knn, "PART", part)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(5, 6))
    rows = [(k, (centers[k % 5] + 0.1 * rng.normal(size=6)).tolist()) for k in range(300)]
    rows += [(300 + k, rows[0][1]) for k in range(60)]  # a third of a group is one vector
    random.Random(1).shuffle(rows)
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), F.col("vec_id") % 20 == 0, k=5, max_pivots=pivots)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda q: q % 20 == 0, 5)


def test_edges(spark):
    rows = [
        (0, [1.0, -0.5]), (1, None), (2, [0.5, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []),
        (6, [0.25]), (7, [0.0, 0.0]), (8, [0.0, 0.0]), (None, [9.0, 9.0]), (9, [1e6, -1e6]), (10, [1.0, -0.5]), (20, [0.1, 0.1, 0.1]),
    ]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, q int")
    got = knn.top_k(frame, F.col("vec_id") % 10 == 0, k=20)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda q: q % 10 == 0, 20)
    assert knn.top_k(frame.limit(0), F.lit(True)).count() == 0
    assert knn.top_k(frame.filter("vec_id = 0"), F.lit(True)).count() == 0


def test_a_query_id_that_stands_several_times(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = []
    for copies in (2, 12):  # the query and nine others are one vector, and all others score less
        rows = [(0, [1.0, 1.0])] * copies + [(k, [1.0, 1.0]) for k in range(1, 10)] + [(100 + k, [0.01 * k, 0.0]) for k in range(5)]
        want = [r[1:] for r in plain(rows, lambda q: q == 0, 10)]
        found = knn.top_k(frame(rows), F.col("vec_id") == 0, k=10).collect()
        got.append(sorted(tuple(r)[1:] for r in found) == sorted(want))
    assert got == [True, True]
