"""Quality rules: a short-circuit cascade, ordered by rejection per cost.

Every rule is a column that is true where a document fails. On a sample each rule's rejection and cost
(passes over characters) are counted; the cascade asks the rules in the order of rejection per cost
and stops at the first that fails. The order changes the work, never the verdict, and is the same in
every run on the same input.

Null text counts as empty, which fails ``too_few_words``. Everything is column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t-\r]+"


@dataclass(frozen=True)
class Rule:
    """``failed`` is null-free."""

    name: str
    failed: Column


def let(value: Column, body) -> Column:
    """Compute ``value`` once and use it several times inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("bigint")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def window_names(words: Column) -> Column:
    """A 64-bit name of every window of eight words."""
    named = F.transform(words, lambda w: F.xxhash64(w))
    steps = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    return let(named, lambda h: F.transform(steps, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)])))


def covered_words(windows: Column) -> Column:
    """Words under windows whose name occurs again in the text; equal names are sorted side by side."""

    def marked(pairs: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            before, after = F.get(pairs, i - 1)["h"], F.get(pairs, i + 1)["h"]
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

        places = F.array_sort(F.transform(F.filter(pairs, again), lambda x: x["i"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("bigint"),
                lambda a, x: a + x,
            ),
        )

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, let(pairs, marked)).otherwise(F.lit(0).cast("bigint"))


def n_repeat_words(words: Column) -> Column:
    return let(window_names(words), covered_words)


def with_measures(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_marks and n_repeat_words."""
    kept = [c for c in docs.columns if c != "text"]
    read = docs.select(*kept, F.coalesce("text", F.lit("")).alias("__t"))
    cut = read.select(
        *kept,
        n_symbols(F.col("__t")).alias("n_symbols"),
        marks(F.col("__t")).alias("n_marks"),
        lines_of(F.col("__t")).alias("__lines"),
        words_of(F.col("__t")).alias("__words"),
    )
    named = cut.select("*", window_names(F.col("__words")).alias("__windows"))
    return named.select(
        *kept,
        F.size("__words").cast("bigint").alias("n_words"),
        word_chars(F.col("__words")).alias("word_chars"),
        "n_symbols",
        "n_marks",
        F.size("__lines").cast("bigint").alias("n_lines"),
        n_dup_lines(F.col("__lines")).alias("n_dup_lines"),
        covered_words(F.col("__windows")).alias("n_repeat_words"),
    )


def marks(text: Column) -> Column:
    """Exclamation marks."""
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit("")))).cast("bigint")


def rules_on(n_words, chars, symbols, lines, dup_lines, n_marks, repeat_words) -> list[Rule]:
    """The rules, over columns or expressions that hold the measures."""
    return [
        Rule("too_few_words", n_words < 20),
        Rule("repeated_words", repeat_words * 100 > n_words * 30),
        Rule("symbols", symbols * 4 > n_words),
        Rule("exclamations", n_marks * 4 > n_words),
        Rule("duplicate_lines", dup_lines * 2 > lines),
        Rule("word_length", (chars < n_words * 2) | (chars > n_words * 20)),
    ]


def measured_rules() -> list[Rule]:
    """Over the columns of ``with_measures``."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_marks", "n_repeat_words")
    return rules_on(*map(F.col, names))


#: Passes over a text's characters that a rule makes beside the split into words, which counts as one more.
WORK = {"too_few_words": 0, "repeated_words": 8, "symbols": 1, "exclamations": 1, "duplicate_lines": 2, "word_length": 1}
_WITHOUT_WORDS = ("duplicate_lines",)


def _fails(name: str, text: Column, words: Column | None) -> Column:
    """Whether the rule of that name fails, with only its own measures computed."""
    measures = [F.lit(0)] * 7
    if words is not None:
        measures[0] = F.size(words)

    def rule() -> Column:
        return next(r.failed for r in rules_on(*measures) if r.name == name)

    def by_lines(lines: Column) -> Column:
        measures[3], measures[4] = F.size(lines), n_dup_lines(lines)
        return rule()

    if name == "duplicate_lines":
        return let(lines_of(text), by_lines)
    if name == "repeated_words":
        measures[6] = n_repeat_words(words)
    elif name == "symbols":
        measures[2] = n_symbols(text)
    elif name == "exclamations":
        measures[5] = marks(text)
    elif name == "word_length":
        measures[1] = word_chars(words)
    return rule()


def text_verdict(names: Sequence[str], text: str = "text") -> Column:
    """The first rule of ``names`` that fails on a text, null where none does.

    A rule's work is done only where those before it pass, and the words are split once, when the first
    rule that needs them is asked.
    """
    t = F.coalesce(F.col(text), F.lit(""))

    def chain(rest: Sequence[str], words: Column | None) -> Column:
        if not rest:
            return F.lit(None).cast("string")
        if words is None and rest[0] not in _WITHOUT_WORDS:
            return let(words_of(t), lambda w: chain(rest, w))
        return F.when(_fails(rest[0], t, words), F.lit(rest[0])).otherwise(chain(rest[1:], words))

    return chain(names, None)


def ordered(docs: DataFrame, sample_rows: int = 2000, seed: int = 7) -> list[str]:
    """The rules by rejection per cost, each measured on what those before it leave of about ``sample_rows`` documents.

    Cost counts passes over characters (``WORK``), not time, so the same input gives the same order. The
    sample comes back as a row for each combination of failed rules. Ties go to the cheaper rule, then to
    the one listed first.
    """
    names = [r.name for r in measured_rules()]
    total = docs.count()
    if not total:
        return names
    texts = docs.select("text", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("__c"))
    sample = with_measures(texts.sample(min(1.0, sample_rows / total), seed))
    failed = [r.failed.alias(f"__f{i}") for i, r in enumerate(measured_rules())]
    sizes = sample.select(*failed, "__c")
    left = sizes.groupBy(*[f"__f{i}" for i in range(len(names))]).agg(F.count("*").alias("n"), F.sum("__c").alias("c")).collect()
    out: list[str] = []
    while len(out) < len(names):
        split = any(x not in _WITHOUT_WORDS for x in out)
        documents, characters = sum(r["n"] for r in left), sum(r["c"] for r in left)

        def worth(i: int, split=split, documents=documents, characters=characters) -> tuple:
            passes = WORK[names[i]] + (not split and names[i] not in _WITHOUT_WORDS)
            cost = documents + passes * characters
            rejected = sum(r["n"] for r in left if r[f"__f{i}"])
            return (-rejected / cost if cost else 0.0, cost, i)

        best = min((i for i in range(len(names)) if names[i] not in out), key=worth)
        out.append(names[best])
        left = [r for r in left if not r[f"__f{best}"]]
    return out


def verdict(rules: Sequence[Rule]) -> Column:
    """The name of the first rule that fails, in the given order; null where none does."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.failed, F.lit(rule.name))
    return chain.otherwise(F.lit(None).cast("string"))


def cascade(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """Keep the documents that pass every rule; all columns stay."""
    return docs.where(text_verdict(ordered(docs, sample_rows)).isNull())


def judged(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed, kept and the first failed rule of the cascade's order."""
    own = docs.select("doc_id", "text")
    order = ordered(own, sample_rows)
    rules = sorted(measured_rules(), key=lambda r: order.index(r.name))
    base = [r.failed for r in rules if r.name in ("too_few_words", "repeated_words")]
    rows = with_measures(own).withColumns({"failed_rule": verdict(rules), "base_failed": base[0] | base[1]})
    return rows.withColumn("kept", F.col("failed_rule").isNull())
