"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, rerank with the original vectors.

Rotations are learned on a bounded sample of distinct vectors so that the signs of the rotated components lose
little (iterative quantisation); each bit is cut at the sample's median, which balances it. Two rotations give 128
bits for 64 components. Near copies count once in the sample, or a large group of them would draw the cuts onto
itself. The bits are cut into eight pieces, a table each. A vector stands in its own bucket of a
table and probes the buckets with one more bit set, so two vectors with at most one different bit in a piece
meet exactly once in that table; they are compared in the first table where they meet.

Buckets are compared in tasks without writing pairs. A first pass sees codes only and keeps the rows with a partner
within ``max_bits`` of the whole code; only these fetch their vectors for the second, which measures
cosines and returns a row per vector: how many it links to, and the smallest vector its links lead to
inside the bucket. A bucket above ``BLOCK`` rows is cut into blocks by a hash and compared block by block, so one
large group of near copies is spread over tasks and none is dropped.

Equal vectors are put together first and count as many. A vector that is null, empty, zero or holds a null or a
value that is not finite links with nothing. Vectors of different lengths have no cosine and are not compared.
Null ids never name a component unless all ids in it are null; then its rows are all kept. Rows with equal ids are
vectors of their own. An empty table gives no rows. Other columns are not read.

The search finds a pair with a probability that rises with its cosine: README has the measured recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import lookup_join, remove, settle
from opstelemetry.llm.graph import components

BITS = 128
PIECES = 8
WIDTH = BITS // PIECES
BLOCK = 1024
_PAIRS = 1 << 21
_MEASURED = 1 << 16
_KEY = ["size", "piece", "bucket", "one", "two"]


def learned_rotation(rows: np.ndarray, bits: int, rnd: np.random.Generator, rounds: int = 50) -> np.ndarray:
    """An orthogonal matrix that turns centred rows close to the corners of a cube."""
    _, _, axes = np.linalg.svd(rows, full_matrices=False)
    axes = axes[:bits].T
    turned = rows @ axes
    spin, _ = np.linalg.qr(rnd.standard_normal((axes.shape[1], axes.shape[1])))
    for _ in range(rounds):
        corners = np.where(turned @ spin >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ turned)
        spin = (left @ right).T
    return axes @ spin


def thinned(sample: np.ndarray, threshold: float) -> np.ndarray:
    """Unit rows without those near an earlier one that stays."""
    covered, kept = np.zeros(len(sample), bool), []
    for i, row in enumerate(sample):
        if not covered[i]:
            kept.append(i)
            covered |= sample @ row >= threshold
    return sample[kept]


class Coder:
    """Codes of ``BITS`` bits for unit vectors of one length, learned on a sample."""

    def __init__(self, sample: np.ndarray, threshold: float, seed: int = 0):
        rnd = np.random.default_rng(seed)
        sample = thinned(sample, threshold)
        size = sample.shape[1]
        learns = len(sample) > size  # else random axes through the origin
        self.centre = sample.mean(axis=0) if learns else np.zeros(size)
        rows = sample - self.centre
        parts: list[np.ndarray] = []
        while sum(p.shape[1] for p in parts) < BITS:
            if learns:
                parts.append(learned_rotation(rows, min(size, BITS), rnd))
            else:
                parts.append(np.linalg.qr(rnd.standard_normal((size, size)))[0][:, :BITS])
        self.axes = np.concatenate(parts, axis=1)[:, :BITS]
        self.cut = np.median(rows @ self.axes, axis=0) if learns else np.zeros(BITS)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Two signed longs a row."""
        bits = (unit - self.centre) @ self.axes >= self.cut
        return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _usable(x: Column) -> Column:
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def classes(vectors: DataFrame) -> DataFrame:
    """(vec, n, least, id): the distinct vectors that can link, how many rows have each, and their smallest id."""
    found = vectors.where("vec is not null").groupBy("vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    return found.withColumn("id", F.monotonically_increasing_id())


def coders(distinct: DataFrame, threshold: float, sample: int, seed: int) -> dict[int, Coder]:
    """A coder for each length of vectors, from at most ``sample`` of them in hash order."""
    out = {}
    for r in distinct.groupBy(F.size("vec").alias("size")).count().collect():
        rows = distinct.where(F.size("vec") == r["size"]).orderBy(F.xxhash64("vec"), "id").limit(sample)
        out[r["size"]] = Coder(units(np.array([x["vec"] for x in rows.select("vec").collect()])), threshold, seed)
    return out


def coded(distinct: DataFrame, of_size: dict[int, Coder]) -> DataFrame:
    """(id, n, size, c0, c1) of every distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            codes = np.zeros((len(size), 2), np.int64)
            for s in np.unique(size):
                rows = np.flatnonzero(size == s)
                values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                codes[rows] = of_size[int(s)].codes(units(values.reshape(len(rows), s)))
            columns = [batch.column("id"), batch.column("n"), pa.array(size, pa.int32()), pa.array(codes[:, 0]), pa.array(codes[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "size", "c0", "c1"])

    return distinct.select("id", "n", "vec").mapInArrow(run, "id bigint, n bigint, size int, c0 bigint, c1 bigint")


def placed(codes: DataFrame, block: int) -> DataFrame:
    """A row for each bucket a code stands in or probes, and for each pair of blocks where the bucket is large."""
    per = 64 // WIDTH
    spread = codes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    own = F.expr(f"cast(shiftrightunsigned(if(piece < {per}, c0, c1), {WIDTH} * (piece % {per})) & {(1 << WIDTH) - 1} as int)")
    spread = spread.withColumn("own", own)
    met = F.expr(f"filter(transform(sequence(-1, {WIDTH - 1}), b -> if(b < 0, own, own | shiftleft(1, b))), (v, i) -> i = 0 or v != own)")
    spread = spread.withColumn("bucket", F.explode(met)).withColumn("probes", F.col("bucket") != F.col("own")).drop("own")
    key = ["size", "piece", "bucket"]
    large = settle(
        spread.groupBy(*key).count().where(F.col("count") > block).select(*key, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    cut = lookup_join(spread, large, {k: k for k in key}).fillna({"blocks": 1})
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return cut.withColumn("other", other).select(
        "size", "piece", "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "block", "probes", "id", "n", "c0", "c1",
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the borders of the groups; the rows are sorted by the key."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        first = np.zeros(table.num_rows, bool)
        first[0] = True
        for name in _KEY:
            v = table.column(name).to_numpy()
            first[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(first)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        held = table.slice(starts[-1])
    if held is not None:
        yield held, np.array([0, held.num_rows])


def _pairs(table: pa.Table, borders: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left, right) row numbers of the pairs that are compared here: near by code, and met in no earlier table."""
    column = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("piece", "block", "one", "two", "probes", "c0", "c1")}
    code = np.stack([column["c0"], column["c1"]], axis=1)
    n_rows = int(borders[-1])
    end = np.repeat(borders[1:], np.diff(borders))
    partners = end - np.arange(n_rows) - 1
    total = np.cumsum(partners)
    first = 0
    while first < n_rows:
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + _PAIRS, "right")))
        some = partners[first:last]
        left = np.repeat(np.arange(first, last), some)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        first = last
        keep = ~(column["probes"][left] & column["probes"][right])
        keep &= (column["one"][left] == column["two"][left]) | (column["block"][left] != column["block"][right])
        left, right = left[keep], right[keep]
        apart = np.bitwise_count((code[left] ^ code[right]).view(np.uint16)).reshape(len(left), PIECES)
        keep = apart.sum(axis=1, dtype=np.int64) <= max_bits
        left, right, apart = left[keep], right[keep], apart[keep]
        keep = (apart <= 1).argmax(axis=1) == column["piece"][left]
        yield left[keep], right[keep]


def _with_partner(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in _runs(batches):
            met = np.zeros(table.num_rows, bool)
            for left, right in _pairs(table, borders, max_bits):
                met[left] = met[right] = True
            yield from table.take(pa.array(np.flatnonzero(met))).combine_chunks().to_batches()

    return run


def _least_reached(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels lowered along the pairs until each row has the least one that pairs lead to."""
    while True:
        least = np.minimum(labels[left], labels[right])
        now = labels.copy()
        np.minimum.at(now, left, least)
        np.minimum.at(now, right, least)
        if (now == labels).all():
            return now
        labels = now


def _measured(threshold: float, max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in _runs(batches):
            n, ids = table.column("n").to_numpy(), table.column("id").to_numpy()
            lists = table.column("vec").combine_chunks()
            size = table.column("size").to_numpy()
            start = np.concatenate([[0], np.cumsum(size[:-1])]).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            links, met = np.zeros(table.num_rows, np.int64), []
            for left, right in _pairs(table, borders, max_bits):
                for i in range(0, len(left), _MEASURED):
                    for s in np.unique(size[left[i : i + _MEASURED]]):
                        a, b = left[i : i + _MEASURED], right[i : i + _MEASURED]
                        a, b = a[size[a] == s], b[size[a] == s]
                        at = np.arange(s)
                        x, y = units(flat[start[a][:, None] + at]), units(flat[start[b][:, None] + at])
                        near = np.einsum("ij,ij->i", x, y) >= threshold
                        a, b = a[near], b[near]
                        np.add.at(links, a, n[b])
                        np.add.at(links, b, n[a])
                        met.append((a, b))
            if met:
                left, right = (np.concatenate(x) for x in zip(*met, strict=True))
                low = _least_reached(ids.copy(), left, right)
                rows = np.flatnonzero(links)
                columns = [pa.array(ids[rows]), pa.array(links[rows]), pa.array(low[rows])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "links", "low"])

    return run


def linked(distinct: DataFrame, threshold: float, max_bits: int, sample: int, seed: int, block: int) -> DataFrame:
    """(id, links, low): a row for each bucket in which a vector has links."""
    codes = settle(coded(distinct, coders(distinct, threshold, sample, seed)))
    rows = placed(codes, block)
    near = settle(rows.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(_with_partner(max_bits), rows.schema))
    full = near.join(distinct.select("id", "vec"), "id")
    return full.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(_measured(threshold, max_bits), "id bigint, links bigint, low bigint")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, max_bits: int = 40, sample: int = 4096, seed: int = 0, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept (whether it names its component)."""
    x = F.transform("embedding", lambda c: c.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", F.when(_usable(x), x).alias("vec"))
    distinct = settle(classes(rows))
    found = settle(linked(distinct, threshold, max_bits, sample, seed, block))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")).where("a != b"))
    named = distinct.drop("vec").join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(
        named.join(least, "root").join(links, "id", "left").select("id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    of_vec = settle(distinct.join(named, "id").select(F.col("vec").alias("__vec"), "component_id", "n_links"))
    remove(found)
    out = rows.join(of_vec, F.col("vec") == F.col("__vec"), "left")
    component = F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def oracle_sql(threshold: float = 0.95) -> str:
    """All pairs, and the smallest id that links lead to."""
    return f"""
    WITH RECURSIVE v AS (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
    u AS (
      SELECT r, x FROM v
      WHERE len(list_filter(x, lambda c: c IS NOT NULL AND isfinite(c))) = len(x) AND list_sum(list_transform(x, lambda c: c * c)) > 0),
    e AS (
      SELECT a.r AS a, b.r AS b FROM u a JOIN u b
      ON a.r != b.r AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {threshold}),
    w AS (SELECT r AS a, r AS b FROM v UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a),
    c AS (SELECT w.a AS r, min(v.vec_id) AS component_id FROM w JOIN v ON w.b = v.r GROUP BY w.a),
    n AS (SELECT a AS r, count(*) AS n FROM e GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM v JOIN c USING (r) LEFT JOIN n USING (r)"""
