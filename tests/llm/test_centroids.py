"""Centroid clustering against a comparison with every centroid."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from liftlens.llm import centroids as cc


def _brute(rows, clusters=cc.CLUSTERS, rounds=cc.ROUNDS, dim=cc.DIMENSION):
    """(vec_id, cluster, distance) of rows (id, vector), and the centroids."""
    kept = [(i, [math.floor(cc.SCALE * x) if abs(x) < 1e300 else int(x) * cc.SCALE for x in v])
            for i, v in rows if v is not None and len(v) == dim
            and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept
                    if i is not None))
    centres = [v for _, v in named[:clusters]]
    if not centres:
        return [], []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else m
                   for c, m in enumerate(centres)]
    return [(i, *reversed(near(v))) for i, v in kept], centres


def _key(row):
    return tuple((x is None, x or 0) for x in row)


def _check(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got, vectors = cc.cluster(frame, **kw)
    expected, centres = _brute(rows, **kw)
    assert vectors == centres
    expected = [(i, c, d if d < 2**63 else None) for i, c, d in expected]
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(expected, key=_key)


@pytest.mark.parametrize("seed", range(12))
def test_search_is_comparison_with_all(seed):
    rnd = random.Random(seed)
    dim, many = rnd.choice([1, 3, 8, 64]), rnd.randint(1, 40)
    size = rnd.choice([1, 2, 50, 300, cc.WIDE])
    vectors = [[rnd.randint(-size, size) for _ in range(dim)] for _ in range(many)]
    vectors += rnd.choices(vectors, k=3)  # ties
    wide = [list(v) for v in vectors]
    wide[0][0], wide[-1][-1] = 1 << 40, -10 ** 200
    x = np.array([[rnd.randint(-size, size) for _ in range(dim)] for _ in range(200)] + vectors)
    for these in (vectors, wide):
        search = cc.Centroids(these)
        numbers, distances = search.nearest(x)
        for row, n, d in zip(x.tolist(), numbers.tolist(), distances.tolist()):
            expected = min((sum((a - b) ** 2 for a, b in zip(row, v)), i)
                           for i, v in enumerate(these))
            assert (d, n) == expected
            assert search.nearest_exact(row) == (n, d)


def test_bounds_reject_most_centroids():
    rnd = np.random.default_rng(1)
    vectors = (rnd.normal(0, 40, (400, 64)) + rnd.normal(0, 400, (400, 1))).astype(int)
    search = cc.Centroids(vectors.tolist())
    looked = []
    search.matrix = type("Counting", (), {
        "__getitem__": lambda self, i: looked.append(len(i)) or vectors[search.order][i]})()
    x = (rnd.normal(0, 40, (500, 64)) + rnd.normal(0, 400, (500, 1))).astype(np.int64)
    search.nearest(x)
    assert sum(looked) < 0.5 * 500 * 400


def test_odd_vectors(spark):
    rnd = random.Random(7)
    rows = [(i, [rnd.gauss(i % 7, 1.0) for _ in range(64)]) for i in range(150)]
    rows += rows[:5] + [(3, [0.25] * 64), (None, [1.0] * 64), (900, None), (901, []),
                        (902, [1.0] * 63), (903, [None] + [1.0] * 63),
                        (904, [float("nan")] * 64), (905, [float("inf")] + [0.0] * 63),
                        (906, [1e9] + [0.0] * 63), (907, [-1e308] * 64), (908, [1e25] * 64)]
    _check(spark, rows)


def test_fewer_vectors_than_clusters_and_equal_ones(spark):
    _check(spark, [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)])
    _check(spark, [(i, [i / 3, -1.0]) for i in range(30)], clusters=4, rounds=2, dim=2)


def test_query_with_extra_columns_and_empty_table(spark, empty_dir, tmp_path):
    assert cc.op13_centroids(spark, empty_dir).collect() == []
    rnd = random.Random(8)
    rows = [(i, [rnd.random() for _ in range(64)], 1, "d", 2) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, distance string, "
                          "vec int").write.parquet(f"{tmp_path}/x/embeddings.parquet")
    got = cc.op13_centroids(spark, f"{tmp_path}/x").collect()
    expected, centres = _brute([(i, [float(np.float32(x)) for x in v]) for i, v, *_ in rows])
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(expected)
    for r in got:
        mine = [d for _, c, d in expected if c == r.cluster]
        assert r.cluster_inertia == sum(mine) and r.inertia == sum(d for _, _, d in expected)
        assert r.centroid_sha256 == cc.centroid_digest(centres[r.cluster])
