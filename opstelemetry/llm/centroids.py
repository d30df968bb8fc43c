"""Centroid clustering with Ptolemaic pivots.

Components become integers, so every distance, sum and comparison is exact. Euclidean distance obeys Ptolemy's
inequality: for two pivots p and s, ``d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|``. The pivots
are the first centroids, paired far from near, and stay fixed; each vector keeps its distances to them. A round
takes the largest of the pairs' bounds, measures the centroid with the least bound, and then only those whose
bound, rounded down, does not exceed it. What is left out is therefore farther away, never nearer or a tie.

Rows stay where they are: a round is one map over the settled vectors, whose tasks return a sum per cluster.
The driver holds the centroids only, ``k`` rows.

Kept are vectors of exactly ``size`` components, none null or not finite. Components beyond 2**21 in size are left
out too, as squared distances would no longer fit a long. Null ids count as empty in the order of the first
centroids; rows with equal ids are ordered by their components; repeated rows are vectors of their own. With fewer
than ``k`` vectors each is a centroid; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import remove, settle

SIZE = 64
LIMIT = float(1 << 21)
_EPS = float(np.finfo(np.float64).eps)


def integral(vectors: DataFrame, size: int = SIZE, scale: int = 64) -> DataFrame:
    """(vec_id, v): the vectors kept, each component x as floor(scale * x)."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    rows = vectors.select("vec_id", x.alias("x")).where(F.size("x") == size)
    rows = rows.where(F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= LIMIT), F.lit(False))))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = kept.orderBy(name, "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in found], np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def pivot_pairs(pivots: np.ndarray) -> list[tuple[int, int, float]]:
    """(p, s, distance): every pivot with the one farthest from it; pivots that coincide make no pair."""
    apart = squared(pivots, pivots)
    pairs = {tuple(sorted((p, int(apart[p].argmax())))) for p in range(len(pivots))}
    return [(p, s, float(np.sqrt(apart[p, s]))) for p, s in sorted(pairs) if apart[p, s]]


def bounds(cached: np.ndarray, away: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Lower bounds of the distances from vectors to centroids; never above the true ones.

    ``cached`` and ``away`` hold the distances of vectors and of centroids to the pivots. Each is off by
    a rounding at most, so the difference of products is lowered by its possible error.
    """
    least = np.zeros((len(cached), len(away)))
    for p, s, apart in pairs:
        one = cached[:, p, None] * away[None, :, s]
        two = cached[:, s, None] * away[None, :, p]
        np.maximum(least, (np.abs(one - two) - 8 * _EPS * (one + two)) / apart * (1 - 8 * _EPS), out=least)
    return least


def nearest(v: np.ndarray, cached: np.ndarray, centroids: np.ndarray, away: np.ndarray, pairs: list) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of every vector, ties to the smaller number; and how many distances were measured."""
    low = bounds(cached, away, pairs)
    cluster = low.argmin(axis=1)
    best = ((v - centroids[cluster]) ** 2).sum(axis=1)
    first, measured = cluster.copy(), len(v)
    low *= low * (1 - 8 * _EPS)
    for c in range(len(centroids)):
        rows = np.flatnonzero((low[:, c] <= best * (1 + 8 * _EPS)) & (first != c))
        exact = ((v[rows] - centroids[c]) ** 2).sum(axis=1)
        better = (exact < best[rows]) | ((exact == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = exact[better], c
        measured += len(rows)
    return cluster, best, measured


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


class _Round:
    """The centroids of a round, as tasks need them."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids, self.size, self.count = centroids, centroids.shape[1], len(pivots)
        self.away, self.pairs = np.sqrt(squared(centroids, pivots)), pivot_pairs(pivots)

    def _assigned(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = _matrix(batch.column("v"), self.size).astype(np.int64)
        cluster, distance, _ = nearest(v, _matrix(batch.column("cached"), self.count), self.centroids, self.away, self.pairs)
        return v, cluster, distance

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(self.centroids), self.size), np.int64)
        count = np.zeros(len(self.centroids), np.int64)
        for batch in batches:
            v, cluster, _ = self._assigned(batch)
            for c in np.unique(cluster):
                rows = v[cluster == c]
                total[c] += rows.sum(axis=0)
                count[c] += len(rows)
        met = np.flatnonzero(count)
        columns = [pa.array(met, pa.int32()), pa.array(count[met]), pa.array(total[met].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = self._assigned(batch)
            columns = [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])


def _with_pivots(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    size = pivots.shape[1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.sqrt(squared(_matrix(batch.column("v"), size).astype(np.int64), pivots))
            cached = pa.ListArray.from_arrays(np.arange(0, apart.size + 1, len(pivots), dtype=np.int32), apart.reshape(-1))
            yield pa.RecordBatch.from_arrays([*batch.columns, cached], [*batch.schema.names, "cached"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(measured, f"vec_id {kind}, v array<int>, cached array<double>")


def moved(vectors: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor of the mean of each one's vectors; empty ones stay."""
    size = centroids.shape[1]
    found = vectors.mapInArrow(_Round(centroids, pivots).sums, "cluster int, n bigint, total array<bigint>")
    sums = [F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(size)]
    out = centroids.copy()
    for r in found.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        out[r["cluster"]] = [r[f"c{i}"] // r["n"] for i in range(size)]
    return out


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, size: int = SIZE, scale: int = 64) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``distance`` is squared. Sums that no longer fit a long are null.
    """
    kept = settle(integral(vectors, size, scale))
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return kept.selectExpr(
            "vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256"
        )
    pivots = centroids
    table = settle(_with_pivots(kept, pivots))
    for _ in range(rounds):
        centroids = moved(table, centroids, pivots)
    kind = kept.schema["vec_id"].dataType.simpleString()
    found = settle(table.mapInArrow(_Round(centroids, pivots).rows, f"vec_id {kind}, cluster int, distance bigint"))
    remove(table)
    remove(kept)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    whole = sums.agg(F.try_sum("cluster_inertia").alias("inertia"))
    digest = F.element_at(F.array(*map(F.lit, names)), F.col("cluster") + 1).alias("centroid_sha256")
    # k rows and one row
    return found.join(F.broadcast(sums.join(F.broadcast(whole))), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest
    )


def oracle_sql(k: int = 16, rounds: int = 3, seed: int = 1, size: int = SIZE, scale: int = 64) -> str:
    """Every vector against every centroid, in integers."""

    def assigned(number: int) -> str:
        return f"""
    a{number} AS (
      SELECT r, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, c{number}) GROUP BY r, v)"""

    def step(number: int) -> str:
        return f"""
    s{number} AS (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{number - 1}) GROUP BY c, i),
    c{number} AS (
      SELECT o.c, coalesce(f.m, o.m) AS m FROM c{number - 1} o LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{number} GROUP BY c) f ON o.c = f.c)"""

    parts = [assigned(0)]
    for i in range(1, rounds + 1):
        parts += [step(i), assigned(i)]
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
      FROM embeddings
      WHERE len(embedding) = {size}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
    c0 AS (
      SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS c, v AS m
      FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept) ORDER BY h, v LIMIT {k}),
    {",".join(parts)},
    t AS (SELECT c, sum(d)::BIGINT AS s FROM a{rounds} GROUP BY c)
    SELECT vec_id, a.c AS cluster, a.d AS distance, t.s AS cluster_inertia,
           (SELECT sum(s) FROM t)::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM kept JOIN a{rounds} a USING (r) JOIN t ON a.c = t.c JOIN c{rounds} f ON a.c = f.c"""
