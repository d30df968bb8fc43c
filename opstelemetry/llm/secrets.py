"""Secret scans: base patterns, and a battery of randomness tests under false-discovery control.

Candidates of the battery are runs of 16 or more base64 characters. A token's encoding is inferred as
the smallest alphabet that holds it, and three tests ask whether it could be a random string over that
alphabet: chi-squared uniformity, runs above and below the alphabet's middle, and serial correlation of
neighbours. The least of the three p-values, corrected for their number (Sidak), is uniform for random
tokens and close to zero for words.

How many words come near uniform depends on length, so distinct tokens are counted by encoding, length class
and p-value over the whole corpus (a table of bounded size); copies of a token count once, however many
there are. Random tokens have p-values spread evenly, so those above one half give the number to
expect in any stretch below it. A class's threshold is the least p-value above which the tokens beyond that
expectation are at most ``rate`` of all. A class with fewer than ``LEAST_TOKENS`` tokens above one half cannot tell
words from keys: such classes of one encoding are judged together, and where even that is too little
evidence the threshold is one half. Thresholds
lie between one hundredth, below which the battery rejects a token whatever its class, and one half.

Spans count code points, end exclusive. Null and empty texts have none. Rows stay one to one. All is
column expressions: there is no shuffle but those of the distinct tokens and their counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.llm.quality import let

#: Fixed values of the query's contract: kind, pattern, group that is measured, its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))
#: Kinds in the order of equal starts; "random" is the battery's.
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Encodings from the smallest alphabet on.
LOWER_LETTERS, UPPER_LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+$", UPPER_LETTERS + "234567"),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER_LETTERS),
    ("base64", "^.*$", UPPER_LETTERS + LOWER_LETTERS + DIGITS + "+/"),
)
BINS = 100
LEAST_TOKENS = 20
_BLOCK = 256


def _sums(values: Column) -> Column:
    """(total, sums before each entry) of a short array."""
    start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(
        values,
        start,
        lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["before"], F.array(a["total"])).alias("before")),
    )


def sums_before(values: Column) -> Column:
    """Sums before each entry; blocks of entries keep the work near linear for long arrays."""

    def joined(parts: Column) -> Column:
        return let(
            _sums(F.transform(parts, lambda p: p["total"]))["before"],
            lambda starts: F.flatten(
                F.transform(parts, lambda p, i: F.transform(p["before"], lambda x: x + F.get(starts, i)))
            ),
        )

    def blocks(v: Column) -> Column:
        steps = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int"))
        return let(F.transform(steps, lambda b: _sums(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))), joined)

    return let(values, blocks)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, stop, measured group) of the leftmost non-overlapping matches, in order."""

    def spans(whole: Column) -> Column:
        lengths = F.transform(whole, lambda m: F.char_length(m))
        gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
        steps = F.zip_with(F.slice(gaps, 1, F.size(whole)), lengths, lambda g, n: g + n)
        ends = F.zip_with(sums_before(steps), steps, lambda b, s: b + s)
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
        with_end = F.arrays_zip(ends.alias("stop"), lengths.alias("n"), parts.alias("part"))
        return F.transform(
            with_end,
            lambda x: F.struct((x["stop"] - x["n"]).alias("start"), x["stop"].alias("stop"), x["part"].alias("part")),
        )

    none = F.array().cast("array<struct<start:int,stop:int,part:string>>")
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_spans(text: Column, kind: int) -> Column:
    """Spans of a base kind whose measured group is long enough."""
    _, pattern, group, least = BASE[kind]
    loose = pattern if kind == 0 else pattern[:-1] + "{%d,}" % (least - 4 * (kind == 1))
    kept = F.filter(matches(text, loose, group), lambda m: F.char_length(m["part"]) >= least)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop")))


def _upper_tail(z: Column) -> Column:
    """Normal upper tail, to about 1e-4, by a cubic logistic."""
    return 1 / (1 + F.exp(F.least(F.greatest(1.5976 * z + 0.07056 * z * z * z, F.lit(-700.0)), F.lit(700.0))))


def _battery(codes: Column, size: int) -> Column:
    """Corrected p-value that the symbols are independent and uniform over ``size`` values."""
    n = F.size(codes).cast("double")
    df = float(size - 1)
    counts = F.transform(F.array_distinct(codes), lambda c: F.size(F.filter(codes, lambda x: x == c)).cast("double"))
    squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
    chi = squares * size / n - n
    uniform = _upper_tail((F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5)

    pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    half = size // 2
    low = F.size(F.filter(codes, lambda x: x < half)).cast("double")
    high = n - low
    changes = F.size(F.filter(pairs, lambda p: (p["a"] < half) != (p["b"] < half))).cast("double")
    mean = 2 * low * high / n + 1
    spread = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9))
    z_runs = F.when((low == 0) | (high == 0), F.sqrt(n)).otherwise(F.abs(changes + 1 - mean) / F.sqrt(spread))

    middle = (size - 1) / 2
    products = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - middle) * (p["b"] - middle))
    z_serial = F.abs(products) / (F.sqrt(n - 1) * ((size * size - 1) / 12))
    least = F.least(uniform, 2 * _upper_tail(z_runs), 2 * _upper_tail(z_serial))
    return 1 - F.pow(1 - least, 3)


def encoding(token: Column) -> Column:
    """Index of the smallest alphabet that holds the token."""
    chain = F
    for i, (_, pattern, _) in enumerate(ALPHABETS):
        chain = chain.when(token.rlike(pattern), F.lit(i))
    return chain


def _tested(characters: Column, alphabet: str) -> Column:
    codes = F.transform(characters, lambda c: F.position(c, F.lit(alphabet)) - 1)
    return let(codes, lambda v: _battery(v, len(alphabet)))


def randomness(token: Column) -> Column:
    """p-value of the battery; zero for digits alone and for padding alone."""
    bare = F.rtrim(F.translate(token, "-_", "+/"), F.lit("="))

    def tested(t: Column) -> Column:
        chain = F.when(t.rlike("^[0-9]*$") | (F.char_length(t) < 12), F.lit(0.0))
        for name, pattern, alphabet in ALPHABETS:
            symbols = F.lower(t) if name == "base36" else t
            characters = F.filter(F.split(symbols, ""), lambda c: c != "")
            chain = chain.when(t.rlike(pattern), _tested(characters, alphabet))
        return chain.otherwise(F.lit(0.0))

    return let(bare, tested)


def length_class(token: Column) -> Column:
    """Two classes to each doubling of the length, open at 1024."""
    return F.least(F.floor(2 * F.log2(F.char_length(token).cast("double"))).cast("int"), F.lit(20))


def class_of(token: Column) -> Column:
    return encoding(token) * 100 + length_class(token)


def least_bin(own: Sequence[int], rate: float) -> int | None:
    """The first bin above which at most ``rate`` of the tokens are beyond an even spread; None without enough evidence.

    The spread is taken from the upper half, the tokens beyond it from the bins below: the two never overlap.
    Their difference may be off by the standard error of such counts, which is allowed for.
    """
    half = BINS // 2
    upper = sum(own[half:])
    if upper < LEAST_TOKENS:
        return None
    for low in range(1, half):
        below = sum(own[low:half])
        if below - upper * (half - low) / half <= rate * (below + upper) + (below + upper) ** 0.5:
            return low
    return half


def distinct_tokens(docs: DataFrame) -> DataFrame:
    """Distinct candidates of the corpus, spread over all shuffle partitions.

    They are few bytes but much work: adaptive execution, which looks at bytes, would test them all in one task.
    The key is a hash, since a second exchange on the tokens themselves would be optimised away.
    """
    text = F.coalesce("text", F.lit(""))
    tokens = docs.where(text.rlike(CANDIDATE)).select(
        F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))).alias("token")
    )
    return tokens.distinct().repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("token"))


def thresholds(docs: DataFrame, rate: float = 0.05) -> dict[int, float]:
    """Least p-value of a discovery by class, from all distinct candidates of the corpus."""
    bins = distinct_tokens(docs).select(
        class_of(F.col("token")).alias("class"),
        F.least(F.floor(randomness(F.col("token")) * BINS).cast("int"), F.lit(BINS - 1)).alias("bin"),
    )
    counts: dict[int, list[int]] = {}
    for row in bins.groupBy("class", "bin").count().collect():  # at most 4 x 21 classes of BINS bins
        counts.setdefault(row["class"], [0] * BINS)[row["bin"]] = row["count"]
    found = {c: least_bin(own, rate) for c, own in counts.items()}
    pooled: dict[int, list[int]] = {}
    for c in (c for c, low in found.items() if low is None):
        pooled[c // 100] = [x + y for x, y in zip(pooled.get(c // 100, [0] * BINS), counts[c], strict=True)]
    together = {e: least_bin(own, rate) for e, own in pooled.items()}
    lows = {c: together[c // 100] if low is None else low for c, low in found.items()}
    return {c: (BINS // 2 if low is None else low) / BINS for c, low in lows.items()}


def random_spans(text: Column, least: dict[int, float]) -> Column:
    """Spans of candidates at or above their class's threshold."""
    if not least:
        return F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    table = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
    kept = F.filter(
        matches(text, CANDIDATE),
        lambda m: F.coalesce(randomness(m["part"]) >= F.element_at(table, class_of(m["part"])), F.lit(False)),
    )
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["stop"].alias("stop")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ","
    )


def scanned(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (start, kind, stop), base spans and all spans."""
    least = thresholds(docs, rate)
    text = F.coalesce("text", F.lit(""))
    kinds = [base_spans(text, k).alias(f"__k{k}") for k in range(len(BASE))]
    rows = docs.select("*", *kinds, random_spans(text, least).alias("__k3"))
    return rows.select(
        *docs.columns, F.concat("__k0", "__k1", "__k2").alias("base"), F.concat("__k0", "__k1", "__k2", "__k3").alias("found")
    )


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def digest(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts by base kind, hash of the base spans, all spans."""
    counts = [_of_kind(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)]
    return scanned(docs.select("doc_id", "text"), rate).select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", rate: float = 0.05) -> DataFrame:
    """``docs`` with every found span replaced in ``text``; overlapping spans become one mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["at"]
        before = F.substr(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        out = F.when(new, F.concat(a["out"], F.array(before, F.lit(mark)))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), out.alias("out"))

    cut = F.aggregate(
        F.array_sort("found"),
        start,
        step,
        lambda a: F.concat(F.array_join(a["out"], ""), F.substr(F.col("text"), a["at"] + 1)),
    )
    text = F.when(F.size("found") == 0, F.col("text")).otherwise(cut)
    own = scanned(docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in ("base", "found")}), rate)
    return own.select(*[text.alias(c) if c == "text" else F.col(f"__own_{c}" if c in ("base", "found") else c).alias(c) for c in docs.columns])
