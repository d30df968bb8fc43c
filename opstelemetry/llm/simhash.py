"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints at most ``max_bits`` apart have one in the middle, at most half as far from both. Every
distinct fingerprint emits all variants within half the radius and is shuffled on them; those that
share a variant are linked. All fingerprints at one variant lie within ``max_bits`` of one another,
so it is enough to link each to the smallest there: no link between components is lost and no group
is expanded into pairs. A variant has at most as many rows as a ball has points (65 for two bits),
however many documents share a fingerprint, because copies are put together first.

Null and empty texts have fingerprint zero and link like others. Null ids never name a component
unless all ids in it are null. Repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opstelemetry.functions.scale import settle
from opstelemetry.llm.graph import components
from opstelemetry.llm.textbytes import binary

SEED = 42
BITS = 64
_STEP = 1 << 16


def fingerprint(text: bytes, length: int = 3) -> int:
    """64 bits, each set where more than half of the shingles' XXH64 values have it set."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < length:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(length)), strict=False))
    n = len(words) - length + 1
    values = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, _STEP):
        part = np.unpackbits(values[i : i + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += part.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, length: int = 3, key: str = "doc_id") -> DataFrame:
    """(key, fingerprint as a signed long) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary(batch.column(1))
            values = np.fromiter((fingerprint(t.as_py(), length) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["__key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col("text"))
    out = rows.mapInArrow(hashed, f"__key {kind}, fingerprint bigint")
    return out.withColumnRenamed("__key", key)


def ball(radius: int) -> list[int]:
    """Signed masks with at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) of at most ``max_bits`` between distinct fingerprints that span all components."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: the middle of an odd distance is not unique")
    masks = F.array(*[F.lit(m) for m in ball(max_bits // 2)])
    spread = distinct.select("fingerprint", F.explode(masks).alias("__mask")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("__mask")).alias("variant")
    )
    least = F.min("fingerprint").over(W.partitionBy("variant"))
    met = spread.select(F.col("fingerprint").alias("a"), least.alias("b")).where("a != b").distinct()
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_duplicates(docs: DataFrame, length: int = 3, max_bits: int = 2, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id.

    Documents are linked if their fingerprints differ in ``max_bits`` bits or fewer; component_id is
    the smallest key that links lead to.
    """
    printed = settle(fingerprints(docs, length, key))
    classes = printed.groupBy("fingerprint").agg(F.min(key).alias("__least"))
    roots = components(links(classes.select("fingerprint"), max_bits))
    rooted = classes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "__least", F.coalesce("root", "fingerprint").alias("__root")
    )
    least = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"))
    named = rooted.join(least, "__root").select("fingerprint", "component_id")
    return printed.join(named, "fingerprint").select(
        key, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
