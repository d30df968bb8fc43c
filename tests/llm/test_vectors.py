"""Operators on vectors against brute force: nulls, values that are not finite, lengths, copies, ties, clashing columns."""

import hashlib
import math
import random

import numpy as np
import pytest

from opstelemetry.llm import centroids, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id long, n long, vec string, cluster string, cached int, size int, v int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x", "y", 4, 5, 6) for i, v in rows], SCHEMA).repartition(3)


def vectors(n, size=64, seed=3, spread=1.0):
    rnd = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in row] for row in rnd.standard_normal((n, size)) * spread]


def odd(size=64):
    flat = [0.5] * size
    return [
        (900, None), (901, []), (902, [0.0] * size), (903, [None, *flat[1:]]), (904, [math.nan, *flat[1:]]),
        (905, [math.inf, *flat[1:]]), (906, flat[:5]), (907, flat * 2), (None, flat), (908, flat), (908, flat),
    ]


def lloyd(rows, k=16, rounds=3):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in kept]
    name = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centre = [v for _, v in sorted(kept, key=name)[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centre)) for _, v in kept]

    for _ in range(rounds):
        where = assigned()
        for j in range(len(centre)):
            mine = [v for (_, v), (_, c) in zip(kept, where, strict=True) if c == j]
            if mine:
                centre[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    where = assigned()
    sums = {j: sum(d for d, c in where if c == j) for j in range(len(centre))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(repr((i, c, d, sums[c], sum(sums.values()), sha[c])) for (i, _), (d, c) in zip(kept, where, strict=True))


CLUSTER = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("spread", [0.2, 0.01])  # the small one has many equal distances
def test_clustering(spark, spread):
    rows = list(enumerate(vectors(300, spread=spread))) + odd()
    rows += [(i, rows[0][1]) for i in range(1000, 1150)] + [rows[5]] * 3
    got = centroids.clustered(frame(spark, rows))
    assert got.columns == CLUSTER
    assert sorted(repr(tuple(r)) for r in got.collect()) == lloyd(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 9])
def test_clustering_of_few(spark, n):
    rows = [*enumerate(vectors(n)), (50, None), (51, [3e38] * 64)]
    got = centroids.clustered(frame(spark, rows)).select(*CLUSTER).collect()
    assert sorted(repr(tuple(r)) for r in got) == lloyd(rows[:-1])


def test_bounds_hold_and_spare_distances():
    rnd = np.random.default_rng(4)
    middles = rnd.integers(-400, 400, (16, 64))
    v = (middles[rnd.integers(0, 16, 4000)] + rnd.integers(-9, 9, (4000, 64))).astype(np.int64)
    for pivots in (v[:16], np.repeat(v[:1], 4, axis=0), v[:1]):
        cached, away = np.sqrt(centroids.squared(v, pivots)), np.sqrt(centroids.squared(v[:16], pivots))
        low = centroids.bounds(cached, away, centroids.pivot_pairs(pivots))
        assert (low <= np.sqrt(centroids.squared(v, v[:16])) * (1 + 1e-12)).all()
    pairs = centroids.pivot_pairs(v[:16])
    away = np.sqrt(centroids.squared(v[:16], v[:16]))
    cluster, best, measured = centroids.nearest(v, np.sqrt(centroids.squared(v, v[:16])), v[:16], away, pairs)
    exact = centroids.squared(v, v[:16])
    assert (cluster == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert measured < 0.5 * exact.size


def linked(rows, threshold=0.95):
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [near_vectors.units(np.array([v], float))[0] if usable(v) else None for _, v in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links, pairs = [0] * len(rows), set()
    for i, x in enumerate(unit):
        for j in range(i):
            y = unit[j]
            if x is not None and y is not None and len(x) == len(y) and x @ y >= threshold:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
                pairs.add((i, j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    ids = [least.get(top(i)) for i in range(len(rows))]
    return sorted(repr((r[0], n, c, r[0] == c)) for r, n, c in zip(rows, links, ids, strict=True))


def near_rows(seed=5):
    rnd = np.random.default_rng(seed)
    base = rnd.standard_normal((120, 64))
    rows = [v.tolist() for v in base]
    rows += [(v + 0.03 * rnd.standard_normal(64)).tolist() for v in np.repeat(base[:20], 4, axis=0)]
    rows += [(base[50] + 0.05 * rnd.standard_normal(64)).tolist() for _ in range(150)]
    rows += [(3 * base[7]).tolist(), (1e-30 * base[7]).tolist(), (1e30 * base[8]).tolist()]
    rows = [[float(np.float32(x)) for x in v] for v in rows]
    return [*enumerate(rows), *odd(), (None, rows[0]), (2, rows[1]), *[(i, rows[60]) for i in range(2000, 2100)]]


COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


@pytest.mark.parametrize("block", [8, 1024])
def test_near_duplicates(spark, block):
    rows = near_rows()
    got = near_vectors.near_duplicates(frame(spark, rows), block=block)
    assert got.columns == COLUMNS
    assert sorted(repr(tuple(r)) for r in got.collect()) == linked(rows)


def test_near_duplicates_of_few(spark):
    assert near_vectors.near_duplicates(frame(spark, [])).collect() == []
    rows = [(4, None), (None, None), (5, [1.0, 0.0]), (6, [1.0, 0.1]), (None, [0.0, 1.0])]
    got = near_vectors.near_duplicates(frame(spark, rows)).collect()
    want = [(4, 0, 4, True), (None, 0, None, True), (5, 1, 5, True), (6, 1, 5, False), (None, 0, None, True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.951: at least 0.9 of them are found."""
    rnd = np.random.default_rng(6)
    base = near_vectors.units(rnd.standard_normal((1000, 64)))
    away = rnd.standard_normal((1000, 64))
    away = near_vectors.units(away - (away * base).sum(axis=1, keepdims=True) * base)
    other = 0.951 * base + math.sqrt(1 - 0.951**2) * away
    rows = [*enumerate(base.tolist()), *enumerate(other.tolist(), 1000)]
    got = near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = got.where("vec_id < 1000 and n_links > 0").count()
    assert found >= 900
