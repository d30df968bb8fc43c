"""Token counts: lengths of tokenised texts, without the tokens.

Arrow batches are cut into blocks of equal bytes. Texts are split at safe boundaries, the places
where white space follows a non-space: the byte-level pre-tokeniser never joins across them, nor does
a special token contain one, so the counts of the pieces add up to the count of the whole text. Each
distinct piece is encoded once per worker; only its length is kept. Texts that hold other Unicode
white space, where the boundary is not certain, are encoded whole.

Null text counts as empty; empty tables give empty results; repeated rows each get a row.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.llm.textbytes import blocks

PIECE = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: White space, to any definition, beyond the ASCII one that the pieces are cut at.
UNCERTAIN = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
CALL_BYTES = 1 << 20
MEMO_ENTRIES = 1 << 19
MEMO_LENGTH = 48

_state: dict = {}


def pieces(text: str) -> list[str]:
    """Stretches of a text whose token counts add up to the text's own."""
    return [text] if UNCERTAIN.search(text) else PIECE.findall(text)


def _count(missing: list[str], tokenizer) -> Iterator[tuple[str, int]]:
    """Encode in calls of about CALL_BYTES."""
    batch: list[str] = []
    size = 0
    for piece in missing:
        batch.append(piece)
        size += len(piece) + 16
        if size >= CALL_BYTES:
            yield from zip(batch, map(len, tokenizer.encode_batch_fast(batch, add_special_tokens=False)), strict=True)
            batch, size = [], 0
    if batch:
        yield from zip(batch, map(len, tokenizer.encode_batch_fast(batch, add_special_tokens=False)), strict=True)


def _tokenizer(definition: str):
    key = hash(definition)
    if _state.get("key") != key:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _state.update(key=key, tokenizer=Tokenizer.from_str(definition), memo={})
    return _state["tokenizer"]


def _lengths(texts: list[str], tokenizer) -> list[int]:
    memo: dict[str, int] = _state["memo"]
    if len(memo) > MEMO_ENTRIES:
        memo.clear()
    cut = [pieces(text) for text in texts]
    missing = {p for own in cut for p in own if p not in memo}
    rare = {}
    for piece, n in _count(sorted(missing), tokenizer):
        (memo if len(piece) <= MEMO_LENGTH else rare)[piece] = n
    if not rare:
        return [sum(map(memo.__getitem__, own)) for own in cut]
    return [sum(memo[p] if p in memo else rare[p] for p in own) for own in cut]


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 1024, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: the key, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``).

    ``tokenizer_file`` is a definition of the ``tokenizers`` library with a byte-level pre-tokeniser
    and no normaliser; its text goes to the executors with the function. Special tokens inside a
    text count as the library does by default; none are added.
    """
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)
        for batch in batches:
            text = batch.column(1)
            for first, last, data, offsets in blocks(text):
                raw = data.tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(offsets[1:] - offsets[:-1], pa.int64()),
                        pa.array(_lengths(texts, tokenizer), pa.int64()),
                    ],
                    ["__key", "n_bytes", "n_tokens"],
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col("text"))
    out = rows.mapInArrow(count, f"__key {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("__key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
