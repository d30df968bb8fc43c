"""Suffix-array dedup: bytes under a long string that occurs again, by sampled prefix doubling.

Prefix doubling names every position by the string that starts there, sorts the names, drops positions
whose name is unique and goes on with longer strings until the threshold. A row for every position and
round would be many times the input, so the first rounds see sampled positions only:

* Each window of ``length`` bytes picks one position in it, the leftmost least hash of its ``CORE``-byte
  strings. The choice depends on the window's bytes alone, so equal windows pick the same place.
  Neighbouring windows with the same pick form a cell.
* Round 1 sorts picks by the name of their core. If it is unique, so are all windows of the cell.
* Round 2 sorts the rest by core and the name of the whole cell (``length`` bytes and more). Cells with
  an equal are repeats throughout.
* Round 3 cuts the distinct cells left under one core into pieces of ``PIECE`` windows, at fixed distances
  from the pick. A piece whose inner string, which all its windows share, is unique has no repeat; one
  whose outer string, which covers all of them, has an equal is a repeat throughout.
* Round 4 sorts the windows of the pieces in doubt, at the very ends of a repeat, by the name of their
  ``length`` bytes.

Names are 64-bit polynomial fingerprints, equal for equal strings; ranks from a sort would be as many
and need a look-up for every offset. Rows are spans, never texts; a name's copies are counted by
aggregation and found again by joins whose partitions can be split.

Null text counts as empty. Repeated rows, also with one id, are places of their own: equal rows make
each other repeats. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.llm import textbytes as B
from opstelemetry.llm.rounds import finished

LENGTH = 200
CORE = 32
PIECE = 16
#: Bytes of a text that are looked at together; cells end there, which round 3 makes good.
STRIDE = 1 << 21
_PLACE = np.uint64((1 << 24) - 1)
_PICKS = "__a bigint, __b int, first bigint, last bigint, pick bigint, core bigint, cell bigint"


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """(id, text, two hashes that stand for the row in joins); equal rows share them."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col(key).alias("__key"), text.alias("text"), F.xxhash64(text, key).alias("__a"), F.hash(key, text).alias("__b")
    )


def _picks(data: np.ndarray, prefix: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window and picked position of every cell of one stretch of a text."""
    n = len(data) - length + 1
    starts = np.arange(len(data) - CORE + 1)
    names = B.span_hash(prefix, starts, starts + CORE)
    span = length - CORE + 1
    # order by the name's high bits, then by place: equal strings are told apart by who comes first
    ranked = (names & ~_PLACE) | starts.astype(np.uint64)
    span = length - CORE + 1
    # least of each window, from the least so far to both sides in blocks of the window's size
    pad = -len(ranked) % span
    rows = np.concatenate([ranked, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]) & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    return first, last, at[first]


def _stretches(size: int, length: int) -> Iterator[tuple[int, int]]:
    """Parts of a text so that each window lies in exactly one."""
    for start in range(0, max(0, size - length + 1), STRIDE):
        yield start, min(size, start + STRIDE + length - 1)


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, _, data, offsets in B.blocks(column):
        for i in range(len(offsets) - 1):
            yield first + i, data[offsets[i] : offsets[i + 1]]


def _cells(length: int):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = [], []
            for i, data in _texts(batch.column(0)):
                for start, stop in _stretches(len(data), length):
                    part = data[start:stop]
                    prefix = B.prefix_hash(part)
                    first, last, at = _picks(part, prefix, length)
                    core = B.span_hash(prefix, at, at + CORE)
                    cell = B.span_hash(prefix, first, last + length)
                    found.append(np.stack([first + start, last + start, at + start, core.view(np.int64), cell.view(np.int64)]))
                    row.append(np.full(len(first), i))
            rows = np.concatenate(row) if row else np.zeros(0, np.int64)
            values = np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)
            ids = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(ids), batch.column(2).take(ids), *(pa.array(v, pa.int64()) for v in values)],
                ["__a", "__b", "first", "last", "pick", "core", "cell"],
            )

    return cells


def _places(batch: pa.RecordBatch, length: int, fields: tuple[str, ...]):
    """(row, start, prefix hash, the wanted fields) of every stretch of a text that has wanted places."""
    lists = batch.column(3)
    flat = lists.flatten()
    values = [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]
    at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    for i, data in _texts(batch.column(0)):
        own = [v[at[i] : at[i + 1]] for v in values]
        for start, stop in _stretches(len(data), length):
            inside = (own[0] >= start) & (own[0] < start + STRIDE)
            if inside.any():
                yield i, start, B.prefix_hash(data[start:stop]), [v[inside] for v in own]


def _steps(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` runs: the run's number and 0, 1, ... inside it."""
    run = np.repeat(np.arange(len(counts)), counts)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)


def _pieces(length: int):
    """Pieces of the wanted cells, with the names of their inner and outer strings.

    The outer name is null for a piece that the cell cuts off; ``open`` tells that the cell has no equal.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [np.zeros(0, np.int64)], [np.zeros((6, 0), np.int64)]
            for i, start, prefix, (first, last, pick, free) in _places(batch, length, ("first", "last", "pick", "open")):
                first, last, pick = first - start, last - start, pick - start
                # piece k holds the windows from pick - 16 k - 15 to pick - 16 k
                low_k = (pick - last) // PIECE
                cell, step = _steps((pick - first) // PIECE - low_k + 1)
                high = pick[cell] - PIECE * (low_k[cell] + step)
                low = high - PIECE + 1
                inner = B.span_hash(prefix, high, low + length)
                whole = (low >= first[cell]) & (high <= last[cell])
                outer = np.zeros(len(low), np.int64)
                outer[whole] = B.span_hash(prefix, low[whole], high[whole] + length).view(np.int64)
                low, high = np.maximum(low, first[cell]), np.minimum(high, last[cell])
                out.append(np.stack([low + start, high + start, inner.view(np.int64), outer, whole, free[cell]]))
                row.append(np.full(len(low), i))
            ids = pa.array(np.concatenate(row))
            low, high, inner, outer, whole, free = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(ids),
                    batch.column(2).take(ids),
                    pa.array(low),
                    pa.array(high),
                    pa.array(inner),
                    pa.array(outer, mask=whole == 0),
                    pa.array(free != 0),
                ],
                ["__a", "__b", "first", "last", "inner", "outer", "open"],
            )

    return pieces


def _windows(length: int):
    """Names of the windows of the wanted pieces."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [np.zeros(0, np.int64)], [np.zeros((3, 0), np.int64)]
            for i, start, prefix, (first, last, free) in _places(batch, length, ("first", "last", "open")):
                piece, step = _steps(last - first + 1)
                at = first[piece] + step
                name = B.span_hash(prefix, at - start, at - start + length).view(np.int64)
                out.append(np.stack([at, name, free[piece]]))
                row.append(np.full(len(at), i))
            ids = pa.array(np.concatenate(row))
            at, name, free = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(ids), batch.column(2).take(ids), pa.array(at), pa.array(name), pa.array(free != 0)],
                ["__a", "__b", "first", "name", "open"],
            )

    return windows


def _place() -> Column:
    return F.xxhash64("__a", "__b", "first")


def _met(rows: DataFrame, name: str) -> DataFrame:
    """Names that stand at two places or more; equal rows of ``docs`` name one place several times."""
    found = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(_place()).alias("low"), F.max(_place()).alias("high"))
    return found.where("low != high").select(name, "low")


def _looked_up(rows: DataFrame, wanted: DataFrame, fields: list[str]) -> DataFrame:
    """(text, __a, __b, wanted): the texts that have wanted places, with the list of these."""
    lists = wanted.groupBy("__a", "__b").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    return rows.select("__a", "__b", "text").join(lists, ["__a", "__b"]).select("text", "__a", "__b", "wanted")


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: str = "doc_id") -> DataFrame:
    """(__a, __b, first, stop): overlapping stretches that cover all repeated bytes, of rows by ``_keyed``."""
    if length < 2 * CORE:
        raise ValueError(f"length must be at least {2 * CORE}")
    rows = _keyed(docs, key)
    kinds = "__a bigint, __b int, first bigint"
    picks = finished(rows.select("text", "__a", "__b").mapInArrow(_cells(length), _PICKS))
    known = picks.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    left = finished(picks.join(known, "core"), picks)

    one = F.min(F.struct("__a", "__b", "first", "last", "pick")).alias("one")
    cells = finished(left.groupBy("core", "cell").agg(F.count("*").alias("n"), one))
    twice = cells.where("n > 1").select("core", "cell")
    whole = left.join(twice, ["core", "cell"]).select("__a", "__b", "first", (F.col("last") + length).alias("stop"))
    whole = finished(whole, left)

    mixed = cells.groupBy("core").agg(F.count("*").alias("m")).where("m > 1").select("core")
    rest = cells.join(mixed, "core").select("one.*", (F.col("n") == 1).cast("bigint").alias("open"))
    found = _looked_up(rows, rest, ["first", "last", "pick", "open"])
    pieces = finished(found.mapInArrow(_pieces(length), f"{kinds}, last bigint, inner bigint, outer bigint, open boolean"), cells)
    doubt = pieces.join(_met(pieces, "inner").drop("low"), "inner")
    doubt = finished(doubt.join(_met(pieces, "outer"), "outer", "left").drop("inner", "outer"), pieces)
    piece = doubt.where("low is not null and open").select("__a", "__b", "first", (F.col("last") + length).alias("stop"))

    # of equal whole pieces one stands for all beside those in doubt
    rest = doubt.where(F.col("low").isNull() | (F.col("low") == _place())).withColumn("open", F.col("open").cast("bigint"))
    found = _looked_up(rows, rest, ["first", "last", "open"])
    single = finished(found.mapInArrow(_windows(length), f"{kinds}, name bigint, open boolean"))
    window = single.where("open").join(_met(single, "name").drop("low"), "name")
    window = window.select("__a", "__b", "first", (F.col("first") + length).alias("stop"))
    return finished(whole.unionByName(piece).unionByName(window), whole, doubt, single)


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["first"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = B.binary(batch.column(1))
        sizes, removed, counts, kept, spans = [], [], [], [], []
        for i in range(len(texts)):
            text, own = texts[i].as_py(), batch.column(2)[i].as_py()
            own = _merged(own) if own else []
            parts = [text[a:b] for a, b in zip([0, *(s[1] for s in own)], [*(s[0] for s in own), len(text)], strict=True)]
            rest = b"".join(parts)
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            counts.append(len(own))
            kept.append(hashlib.sha256(rest).hexdigest())
            spans.append([{"first": a, "stop": b} for a, b in own])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(v, pa.int64()) for v in (sizes, removed, counts)), pa.array(kept, pa.string()), pa.array(spans, kind)],
            ["__key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256 and the removed ``spans``.

    A byte is removed if some string of ``length`` bytes over it starts anywhere else too.
    """
    kind = docs.schema[key].dataType.simpleString()
    spans = repeated_spans(docs, length, key).groupBy("__a", "__b").agg(F.collect_set(F.struct("first", "stop")).alias("spans"))
    rows = _keyed(docs, key).join(spans, ["__a", "__b"], "left").select("__key", "text", "spans")
    out = rows.mapInArrow(
        _without,
        f"__key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<first:bigint,stop:bigint>>",
    )
    return out.withColumnRenamed("__key", key)
