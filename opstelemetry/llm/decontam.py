"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

Items are short and documents long, so Jaccard estimates between them say nothing. What is sketched is
the item: its distinct shingles in hash order. A document that holds a share t of an item's n shingles
lacks at most floor((1 - t) n) of them, so it holds at least one of the floor((1 - t) n) + 1 smallest.
Items are partitioned by shingle count, and each partition's sketch has the size that its largest item
needs; no item is missed. A document probes all its shingles against the sketches; candidates are
verified on the words themselves.

Sketches are broadcast in blocks of at most ``BLOCK_SHINGLES`` item shingles, a proven size; a larger
benchmark takes more passes over the documents. Items of fewer than five words are searched as one run
of their words. Items without words, and null or empty texts, match nothing. Words are runs of letters
and digits (and any byte above 127), in lower case. Repeated documents or items each get their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import settle
from opstelemetry.llm import textbytes as B

SHINGLE = 5
SHARE = 0.8
BLOCK_SHINGLES = 1 << 20
_SIEVE_BITS = 22


def _words(text: bytes) -> list[bytes]:
    data = B.LOWER[np.frombuffer(text, np.uint8)]
    raw = data.tobytes()
    starts, ends, _ = B.words(data, np.array([0, len(data)]), B.LOWER_ALNUM)
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _shingles(words: list[bytes], length: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[i:] for i in range(length)), strict=False))


def _names(text: bytes, length: int) -> np.ndarray:
    """Distinct names of an item's shingles, smallest first."""
    data = B.LOWER[np.frombuffer(text, np.uint8)]
    starts, ends, _ = B.words(data, np.array([0, len(data)]), B.LOWER_ALNUM)
    return np.unique(B.shingle_hash(B.span_hash(B.prefix_hash(data), starts, ends), length))


def size_class(n: int) -> int:
    """Upper bound of the shingle counts in an item's partition: the next power of two."""
    return 1 << max(0, n - 1).bit_length()


def sketch_size(n: int, share: float) -> int:
    """Smallest names to keep for an item of n shingles, by the bound of its partition."""
    return min(n, int((1 - share) * size_class(n) + 1e-9) + 1)


class Index:
    """Sketches of one block of items, with what verification needs."""

    def __init__(self, items: list[tuple[int, bytes]], share: float):
        self.share, self.items = share, []
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item, text in items:
            words = _words(text)
            length = min(SHINGLE, len(words))
            if not length:
                continue
            names = _names(text, length)
            by_length.setdefault(length, []).append((names[: sketch_size(len(names), share)], len(self.items)))
            self.items.append((item, length, _shingles(words, length)))
        self.sketches = {}
        for length, kept in by_length.items():
            names = np.concatenate([n for n, _ in kept])
            own = np.concatenate([np.full(len(n), i) for n, i in kept])
            order = np.argsort(names, kind="stable")
            names, own = names[order], own[order]
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[(names >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True
            self.sketches[length] = (sieve, names, own)

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(text of the block, item) pairs that share a sketched shingle."""
        data = B.LOWER[data]
        starts, ends, first = B.words(data, offsets, B.LOWER_ALNUM)
        names = B.span_hash(B.prefix_hash(data), starts, ends)
        found: set[tuple[int, int]] = set()
        for length, (sieve, keys, own) in self.sketches.items():
            runs = B.shingle_hash(names, length)
            at = np.flatnonzero(sieve[(runs >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
            low = np.searchsorted(keys, runs[at], "left")
            high = np.searchsorted(keys, runs[at], "right")
            at, low, high = (x[high > low] for x in (at, low, high))
            text = np.searchsorted(first, at, "right") - 1
            inside = at + length <= first[np.minimum(text + 1, len(first) - 1)]
            for t, a, b in zip(text[inside].tolist(), low[inside].tolist(), high[inside].tolist(), strict=True):
                found.update((t, i) for i in own[a:b].tolist())
        return found

    def verified(self, text: bytes, candidates: list[int]) -> Iterator[tuple[int, int, int]]:
        """(item, its shingles, those that the text holds) where the share is reached."""
        words = _words(text)
        sets: dict[int, set] = {}
        for i in candidates:
            item, length, wanted = self.items[i]
            if length not in sets:
                sets[length] = _shingles(words, length)
            held = len(wanted & sets[length])
            if held >= self.share * len(wanted) - 1e-9:
                yield item, len(wanted), held


def _search(docs: DataFrame, index: Index, key: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema[key].dataType.simpleString()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Index = shared.value
        for batch in batches:
            rows, found = [], []
            for first, _, data, offsets in B.blocks(batch.column(1)):
                by_text: dict[int, list[int]] = {}
                for t, i in sorted(own.candidates(data, offsets)):
                    by_text.setdefault(t, []).append(i)
                for t, items in by_text.items():
                    for hit in own.verified(data[offsets[t] : offsets[t + 1]].tobytes(), items):
                        rows.append(first + t)
                        found.append(hit)
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)],
                ["__key", "item_id", "n_shingles", "n_held"],
            )

    rows = docs.select(F.col(key).alias("__key"), F.col("text"))
    return rows.mapInArrow(probe, f"__key {kind}, item_id bigint, n_shingles bigint, n_held bigint")


def blocks_of_items(benchmark: DataFrame, most: int = BLOCK_SHINGLES) -> Iterator[list[tuple[int, bytes]]]:
    """Items in runs whose texts have at most ``most`` bytes (so fewer shingles), one run on the driver at a time."""
    block: list[tuple[int, bytes]] = []
    size = 0
    for row in benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        raw = row["text"].encode()
        if block and size + len(raw) > most:
            yield block
            block, size = [], 0
        block.append((row["item_id"], raw))
        size += len(raw)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, key: str = "doc_id") -> DataFrame:
    """(key, item_id, n_shingles, n_held, containment) of every document and item that it holds.

    A document holds an item if it has at least ``share`` of the item's distinct five-word shingles.
    """
    found = None
    for block in blocks_of_items(benchmark):
        hits = _search(docs, Index(block, share), key)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = _search(docs, Index([], share), key)
    return found.withColumnRenamed("__key", key).withColumn("containment", F.col("n_held") / F.col("n_shingles"))


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows whose text holds no item; all columns stay. Rows are judged one by one, whatever their ids."""
    keyed = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    hit = settle(contaminated(keyed, benchmark, share, "__row").select("__row").distinct())
    return keyed.join(hit, "__row", "left_anti").select(*docs.columns)


def oracle_sql(share: float = SHARE) -> str:
    """Exact containment by a join on all shingles."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    WITH i AS (
      SELECT item_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
             lambda k: array_to_string(w[k:k + 4], ' ')))) AS s
      FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) >= 1),
    n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id),
    d AS (
      SELECT r, doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))) AS s
      FROM (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents) WHERE len(w) >= 5)
    SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_held, CAST(count(*) AS DOUBLE) / n AS containment
    FROM d JOIN i USING (s) JOIN n USING (item_id)
    GROUP BY r, doc_id, item_id, n HAVING count(*) >= {share} * n - 1e-9"""
