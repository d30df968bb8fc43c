"""LM scoring with a probabilistic suffix tree over bytes, and the unigram base beside it.

A text is a sequence of tokens: lower-cased words and one end. It is written as its words, each with a
space after it, and an end byte. The tree predicts that byte by byte, so the bytes of a token multiply to
the probability of that token. Contexts are suffixes of up to ``depth`` bytes, padded before a text's
start.

Learning. Chunks of texts count their distinct (depth + 1)-grams, Spark sums them and derives the shorter
contexts. A context is kept if it was met ``LEAST`` times and its next-byte distribution diverges from
that of its suffix: the likelihood gain count x KL exceeds ``gain`` for each byte value seen in it. Every
context that passes is kept, however many there are.

Smoothing. A context's distribution is its counts plus ``prior`` times its suffix's distribution; at the
root every byte value counts once more. The
probabilities of all token sequences add up to one. Smoothing whole tokens with their counts as well was
tried; it scored held-out texts worse than the tree alone.

Where the tree is. The probability of a byte depends on its (depth + 1)-gram alone, so the tree is a Spark
table of the probabilities of all grams that texts hold, made from the root outwards: a level joins the
one before on the gram without its first byte, which at most 256 grams share. Chunks get the rows of their
own grams by a join, packed into lists before they are dealt to chunks. Nothing of it is on the driver or broadcast. ``Tree`` holds the same model as an
automaton, for corpora that fit the driver.

Base. The words of a chunk of texts are counted together, the counts of equal words summed over chunks,
and every chunk gets the sums of its own words back. Chunks are hash-dealt, of bounded bytes; no task
holds the vocabulary. Words meet by 64-bit names.

Null and empty texts have the end only. Null ids count as the empty string for the split. Repeated rows
each get a row. Without training texts N and V are 0 and the root is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opstelemetry.llm import textbytes as B
from opstelemetry.llm.rounds import finished

DEPTH = 5
END = 10
CHUNK_BYTES = 8 << 20
FOLDS, HELD_OUT = 7, 2
LEAST = 2
_SEGMENT = 512
_WORD = B.byte_class(" \n")
_END_NAME = -1


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _normal(text: bytes) -> bytes:
    words = text.lower().split()
    return b" ".join(words) + b" " if words else b""


def _stream(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each after ``depth`` end bytes and closed by one; where each text's first byte is."""
    pad = bytes([END]) * depth
    parts = [_normal(t) for t in texts]
    data = np.frombuffer(b"".join(x for p in parts for x in (pad, p, pad[:1])), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes + depth + 1) - sizes - 1
    return data, starts


def _blocks_of(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for first, _, data, offsets in B.blocks(texts):
        raw = data.tobytes()
        yield first, [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


# -- learning ------------------------------------------------------------------------------


def _codes(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every predicted byte of a stream, and each text's number of them."""
    # eight bytes are read at every place, of which the first are the gram
    wide = np.ndarray(len(data) - depth, ">u8", np.append(data, np.zeros(7, np.uint8)), strides=(1,))
    code = wide.astype(np.uint64) >> np.uint64(64 - 8 * (depth + 1))
    ends = np.concatenate([starts[1:] - depth, [len(data)]])
    inside = np.ones(len(code), bool)
    for e in range(depth):  # the paddings themselves are given, not predicted
        past = ends[:-1] + e - depth
        inside[past[past >= 0]] = False
    return code[inside].view(np.int64), ends - starts


def _grams(depth: int, step: int = 3 << 20):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, texts in _blocks_of(batch.column(0)):
                held.append(_codes(*_stream(texts, depth), depth)[0])
                size += len(held[-1])
                if size >= step:
                    yield _counted(held)
                    held, size = [], 0
        if held:
            yield _counted(held)

    return grams


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    codes, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["gram", "n"])


def counts(training: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n): the bytes of a context and its next byte in one number, over all training texts."""
    rows = training.select("text").mapInArrow(_grams(depth), "gram bigint, n bigint")
    return finished(rows.groupBy("gram").agg(F.sum("n").alias("n")))


def by_context(grams: DataFrame, depth: int) -> DataFrame:
    """(size, context, symbol, n) for all context lengths: shorter ones sum over the bytes before."""
    sizes = F.explode(F.array(*map(F.lit, range(depth + 1)))).alias("size")
    spread = grams.select("gram", "n", sizes)
    context = F.expr("shiftright(gram, 8) & (shiftleft(1L, 8 * size) - 1)")
    return spread.groupBy("size", context.alias("context"), F.col("gram").bitwiseAND(255).alias("symbol")).agg(F.sum("n").alias("n"))


def tested_contexts(table: DataFrame, least: int) -> DataFrame:
    """(size, context, total, gained, seen): likelihood gain over the suffix, and the byte values seen."""
    totals = table.groupBy("size", "context").agg(F.sum("n").alias("total")).where(F.col("total") >= least)
    rows = table.join(totals, ["size", "context"])
    suffix = rows.select(
        (F.col("size") + 1).alias("size"), F.col("context").alias("suffix"), "symbol", F.col("n").alias("sn"), F.col("total").alias("st")
    )
    cut = rows.where("size > 0").withColumn("suffix", F.expr("context & (shiftleft(1L, 8 * (size - 1)) - 1)"))
    share = F.log((F.col("n") / F.col("total")) / (F.col("sn") / F.col("st")))
    return (
        cut.join(suffix, ["size", "suffix", "symbol"])
        .groupBy("size", "context", "total")
        .agg(F.sum(F.col("n") * share).alias("gained"), F.count("*").alias("seen"))
    )


class Tree:
    """States, their transitions and the log10 probabilities of each next byte, as arrays."""

    def __init__(self, root: dict[int, int], kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], depth: int, prior: float):
        """``root`` counts byte values; ``kept`` has the byte values and counts of each (size, context)."""
        seen = sorted(root)
        width = len(seen) + 1  # the last column is any byte value that was never seen
        self.column = np.full(256, len(seen), np.int64)
        self.column[seen] = np.arange(len(seen))
        order = sorted({(0, 0)} | {(s - cut, c >> (8 * cut)) for s, c in kept for cut in range(s)})
        at = {state: i for i, state in enumerate(order)}
        move = np.zeros((len(order), width), np.int32)
        share = np.zeros((len(order), width), np.float32)
        total = sum(root.values()) + 256
        share[0, :-1] = [(root[s] + 1) / total for s in seen]
        share[0, -1] = 1 / total
        longer: dict[int, list[tuple[int, int]]] = {}
        for state in order[1:]:
            longer.setdefault(at[state[0] - 1, state[1] >> 8], []).append(state)
        for i, (length, code) in enumerate(order):  # shorter states come first
            if i:
                parent = next(at[x] for k in range(length - 1, -1, -1) if (x := (k, code & ((1 << (8 * k)) - 1))) in at)
                move[i] = move[parent]
                share[i] = share[parent]
                if own := kept.get((length, code)):
                    symbols, n = own
                    share[i] *= prior / (n.sum() + prior)
                    share[i, self.column[symbols]] += (n / (n.sum() + prior)).astype(np.float32)
            # where the state is itself lengthened by the next byte, that is where the byte leads
            for state in longer.get(i, ()):
                move[i, self.column[state[1] & 255]] = at[state]
        self.log, self.move, self.depth = np.log10(share, out=share), move, depth

    def token_scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of every token of all texts in a row, and the number of each text's tokens.

        Long texts are cut into parts; each part's first state comes from the bytes before it.
        """
        data, starts = _stream(texts, self.depth)
        columns = self.column[data].astype(np.int32)
        ends = np.concatenate([starts[1:] - self.depth, [len(data)]])
        parts = -(-(ends - starts) // _SEGMENT)
        text = np.repeat(np.arange(len(texts)), parts)
        part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        low = starts[text] + part * _SEGMENT
        size = np.minimum(low + _SEGMENT, ends[text]) - low
        order = np.argsort(-size, kind="stable")
        low, size = low[order], size[order]
        state = np.zeros(len(low), np.int32)
        for j in range(self.depth):
            state = self.move[state, columns[low - self.depth + j]]
        log = np.zeros(len(data))
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, "left"))
            here, symbols = state[:live], columns[low[:live] + t]
            log[low[:live] + t] = self.log[here, symbols]
            state[:live] = self.move[here, symbols]
        stops = data == 32
        stops[ends - 1] = True  # the end itself; paddings are no tokens
        stops = np.flatnonzero(stops)
        before = np.concatenate([[0], np.cumsum(log)])
        sums = np.diff(before[np.concatenate([[0], stops + 1])])
        return sums, np.diff(np.searchsorted(stops, np.concatenate([starts, [len(data)]])))


def learn(grams: DataFrame, depth: int = DEPTH, gain: float = 2.0, prior: float = 4.0) -> Tree:
    """Fit the tree on the driver, which all kept contexts come to; ``tree_table`` is the form without that."""
    table = finished(by_context(grams, depth))
    root = {r["symbol"]: r["n"] for r in table.where("size = 0").collect()}
    tested = tested_contexts(table, LEAST).where(F.col("gained") > gain * F.col("seen"))
    own = table.join(tested.select("size", "context"), ["size", "context"])
    rows = own.groupBy("size", "context").agg(F.collect_list("symbol").alias("symbols"), F.collect_list("n").alias("counts")).toArrow()
    kept = {}
    for batch in rows.to_batches():
        for size, context, symbols, n in zip(*(batch.column(i) for i in range(4)), strict=True):
            kept[size.as_py(), context.as_py()] = (symbols.values.to_numpy(), n.values.to_numpy())
    return Tree(root, kept, depth, prior)


def tree_table(grams: DataFrame, depth: int = DEPTH, gain: float = 2.0, prior: float = 4.0) -> DataFrame:
    """(gram, n, total, kept, p) of distinct (gram, n), where n counts training texts and may be 0.

    ``total`` counts the gram's context, ``kept`` tells whether the context passed the test, and ``p`` is
    the probability of the gram's last byte after the others.
    """

    def of(size: int) -> DataFrame:
        gram = F.col("gram").bitwiseAND((1 << (8 * (size + 1))) - 1).alias("gram")
        return grams.groupBy(gram).agg(F.sum("n").alias("n"))

    total = int(grams.agg(F.sum("n")).first()[0] or 0)
    level = of(0).select("gram", "n", F.lit(total).cast("bigint").alias("total"), F.lit(False).alias("kept"), ((F.col("n") + 1) / F.lit(total + 256.0)).alias("p"))
    for size in range(1, depth + 1):
        shorter = level.select(F.col("gram").alias("suffix"), F.col("n").alias("sn"), F.col("total").alias("st"), F.col("p").alias("sp"))
        rows = of(size) if size < depth else grams
        rows = rows.withColumns({"context": F.shiftright("gram", 8), "suffix": F.col("gram").bitwiseAND((1 << (8 * size)) - 1)})
        context = W.partitionBy("context")
        rows = rows.join(shorter, "suffix").withColumn("total", F.sum("n").over(context))
        # the logarithm of 0 is null, which sums leave out
        share = F.log("n") - F.log("total") - F.log("sn") + F.log("st")
        gained = F.sum(F.col("n") * share).over(context)
        seen = F.count(F.when(F.col("n") > 0, 1)).over(context)
        kept = (F.col("total") >= LEAST) & F.coalesce(gained > gain * seen, F.lit(False))
        smoothed = (F.col("sp") * prior + F.col("n")) / (F.col("total") + prior)
        level = rows.withColumn("kept", kept).select("gram", "n", "total", "kept", F.when(F.col("kept"), smoothed).otherwise(F.col("sp")).alias("p"))
    return level


# -- scoring -------------------------------------------------------------------------------


def _word_names(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words of a stream, and each text's number of words."""
    low, high, _ = B.words(data, np.array([0, len(data)]), _WORD)
    n = np.diff(np.searchsorted(low, np.concatenate([starts, [len(data)]])))
    names = B.span_hash(B.prefix_hash(data), low, high).view(np.int64)
    return np.where(names == _END_NAME, 0, names), n


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names in order and the sums of their numbers; each part is in order."""
    names, numbers = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(names, kind="stable")
    names = names[order]
    first = np.ones(len(names), bool)
    first[1:] = names[1:] != names[:-1]
    return names[first], np.add.reduceat(numbers[order], np.flatnonzero(first)) if len(names) else numbers


class _Sums:
    """Distinct names with their number of places in training texts, summed step by step.

    Places are sorted as bare names, those of training texts and others apart. Sums of like size are merged, so
    little is held twice.
    """

    STEP = 1 << 21

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        self.size = 0

    def add(self, names: np.ndarray, training: bool) -> None:
        self.held[training].append(names)
        self.size += len(names)
        if self.size >= self.STEP:
            self._count()

    def _count(self) -> None:
        both = []
        for training, held in self.held.items():
            if held:
                names, n = np.unique(np.concatenate(held), return_counts=True)
                both.append((names, n * training))
                held.clear()
        self.size = 0
        self.parts.append(_summed(both))
        while len(self.parts) > 1 and 2 * len(self.parts[-1][0]) > len(self.parts[-2][0]):
            self._merge()

    def _merge(self) -> None:
        self.parts[-2:] = [_summed(self.parts[-2:])]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.size:
            self._count()
        while len(self.parts) > 1:
            self._merge()
        return self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _chunk_parts(depth: int):
    def parts(table: pa.Table) -> pa.Table:
        """Distinct words and grams of a chunk with their number of places in training texts."""
        words, grams, ends = _Sums(), _Sums(), 0
        use = np.invert(table.column("held_out").to_numpy()).tolist()
        for row, chunk in _even(table):
            for first, texts in _blocks_of(chunk):
                split: dict[bool, list[bytes]] = {True: [], False: []}
                for i, text in enumerate(texts, row + first):
                    split[use[i]].append(text)
                ends += len(split[True])
                for training, own in split.items():
                    if own:
                        data, starts = _stream(own, depth)
                        words.add(_word_names(data, starts)[0], training)
                        grams.add(_codes(data, starts, depth)[0], training)
        end = (np.array([_END_NAME]), np.array([ends]))
        tables = []
        for is_gram, (name, n) in ((False, _summed([words.all(), end])), (True, grams.all())):
            both = [pa.array(np.full(len(name), is_gram)), pa.array(name), pa.array(np.full(len(name), table.column("chunk")[0].as_py(), np.int64)), pa.array(n)]
            tables.append(pa.Table.from_arrays(both, ["is_gram", "name", "chunk", "n"]))
        return pa.concat_tables(tables)

    return parts


def _even(table: pa.Table) -> Iterator[tuple[int, pa.Array]]:
    first = 0
    for text in table.column("text").chunks:
        yield first, text
        first += len(text)


def _packed(column: str, step: int = 1 << 20):
    """Rows (name, chunks, value) as lists of names and values by chunk, so that a chunk gets few, long rows."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("chunks").flatten())
            if size >= step:
                yield _by_chunk(held, column)
                held, size = [], 0
        if held:
            yield _by_chunk(held, column)

    return packed


def _by_chunk(held: list[pa.RecordBatch], column: str) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    lists = table.column("chunks").combine_chunks()
    chunk = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = pc.list_parent_indices(lists).to_numpy()
    order = np.argsort(chunk, kind="stable")
    chunk, row = chunk[order], row[order]
    cuts = np.flatnonzero(np.diff(chunk, prepend=chunk[:1] - 1))
    offsets = pa.array(np.append(cuts, len(chunk)), pa.int32())
    names, values = (table.column(c).combine_chunks().take(pa.array(row)) for c in ("name", column))
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk[cuts]), pa.ListArray.from_arrays(offsets, names), pa.ListArray.from_arrays(offsets, values)], ["chunk", "names", column]
    )


def _sorted(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    names, values = (np.concatenate([x.flatten().to_numpy() for x in table.column(c).chunks] or [np.zeros(0)]) for c in ("names", column))
    order = np.argsort(names)
    return names[order], values[order]


def _places_in(names: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where each of ``own`` is in the sorted ``names``; searched in order, so that neighbours are near in memory."""
    order = np.argsort(own)
    out = np.empty(len(own), np.int64)
    out[order] = np.searchsorted(names, own[order])
    return out


def _text_sums(codes: np.ndarray, places: np.ndarray, grams: np.ndarray, logs: np.ndarray, depth: int) -> np.ndarray:
    """The sum of the logarithms of each text's grams.

    A sum needs no order of places: grams are sorted with their text's number in the bits they leave free, for as many
    texts at a time as these bits can tell apart, and each gram of a text is looked up once.
    """
    free = np.uint64(64 - 8 * (depth + 1))
    most = 1 << int(free)
    ends = np.concatenate([[0], np.cumsum(places)])
    out = [np.zeros(0)]
    for first in range(0, len(places), most):
        n = places[first : first + most]
        text = np.repeat(np.arange(len(n), dtype=np.uint64), n)
        own = codes[ends[first] : ends[first + len(n)]].view(np.uint64)
        pairs, times = np.unique(own << free | text, return_counts=True)
        log = logs[np.searchsorted(grams, (pairs >> free).view(np.int64))]
        out.append(np.bincount((pairs & np.uint64(most - 1)).view(np.int64), times * log, len(n)))
    return np.concatenate(out)


def _scorer(depth: int):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names, seen = _sorted(right.filter(pc.is_valid(right.column("n"))), "n")
        grams, logs = _sorted(right.filter(pc.is_valid(right.column("log"))), "log")
        end = seen[np.searchsorted(names, _END_NAME)]
        known, weight = seen > 0, np.log10(seen + 1.0)
        out = [[], [], [], []]
        for _, chunk in _even(left):
            for _, texts in _blocks_of(chunk):
                data, starts = _stream(texts, depth)
                own, n = _word_names(data, starts)
                at = _places_in(names, own)
                text = np.repeat(np.arange(len(texts)), n)
                out[0].append(n + 1)
                out[1].append(np.bincount(text, known[at], len(texts)).astype(np.int64) + int(end > 0))
                out[2].append(np.bincount(text, weight[at], len(texts)) + np.log10(end + 1.0))
                out[3].append(_text_sums(*_codes(data, starts, depth), grams, logs, depth))
        n, n_known, base, tree_score = (np.concatenate(x) for x in out)
        return pa.table({"key": left.column("key"), "held_out": left.column("held_out"), "n_tokens": n, "n_known": n_known, "logs": base, "score": tree_score})

    return score


def scored(docs: DataFrame, key: str = "doc_id", depth: int = DEPTH, gain: float = 2.0, prior: float = 4.0) -> DataFrame:
    """One row per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"), held_out(key).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = 1 + int(size) // CHUNK_BYTES
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(chunks)))
    parts = finished(dealt.groupBy("chunk").applyInArrow(_chunk_parts(depth), "is_gram boolean, name bigint, chunk bigint, n bigint"), compression="zstd")
    whole = W.partitionBy("name")
    summed = parts.where("not is_gram").select(
        "name",
        "chunk",
        F.sum("n").over(whole).alias("total"),
        F.min("chunk").over(whole).alias("least"),
    )
    fresh = (F.col("chunk") == F.col("least")) & (F.col("total") > 0)
    chunk = F.array(F.col("chunk").cast("int")).alias("chunks")
    words = finished(summed.select("name", chunk, F.col("total").alias("n"), fresh.alias("fresh")), compression="zstd")
    v = words.where("fresh").count()
    # a gram's chunks in lists of bounded length, so that its probability meets the lists instead of a row for each chunk
    places = parts.where("is_gram").groupBy(F.col("name").alias("gram"), F.shiftright("chunk", 8).alias("block"))
    lists = finished(places.agg(F.sum("n").alias("n"), F.collect_list(F.col("chunk").cast("int")).alias("chunks")), parts, compression="zstd")
    grams = finished(lists.groupBy("gram").agg(F.sum("n").alias("n")), compression="zstd")
    logs = finished(tree_table(grams, depth, gain, prior).select("gram", F.log10("p").alias("log")), grams, compression="zstd")
    met = lists.join(logs, "gram").select(F.col("gram").alias("name"), "chunks", "log")
    met = met.mapInArrow(_packed("log"), "chunk bigint, names array<bigint>, log array<double>")
    known = words.select("name", "chunks", "n").mapInArrow(_packed("n"), "chunk bigint, names array<bigint>, n array<bigint>")
    known = known.unionByName(met, allowMissingColumns=True)
    kind = rows.schema["key"].dataType.simpleString()
    found = finished(
        dealt.groupBy("chunk")
        .cogroup(known.groupBy("chunk"))
        .applyInArrow(
            _scorer(depth),
            f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, logs double, score double",
        ),
        words,
        lists,
        logs,
    )
    n = int(found.where(~F.col("held_out")).agg(F.sum("n_tokens")).first()[0] or 0)
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return found.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score"
    )
