"""Mix sources to target weights by hash-random order and distributed prefix sums.

Every document gets a hash-random key. Rows (without texts) are range-sorted by source and key; the
sums of the partitions give each one's offset, so running totals need no task that holds a source.
Each source is cut where its running total meets its budget exactly; budgets above the source's size
take whole epochs first.

Null text has size 0. The null source comes last. Repeated rows are documents of their own. A source
whose size is 0 has target 0. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import settle
from opstelemetry.llm.ordering import numbered, running
from opstelemetry.llm.quality import words_of

WEIGHTS = (3, 1, 2)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size, target): ``share`` of all words by weight, at most ``most`` times a source.

    Sources that the common rate would fill beyond the limit stop there; the excess raises the rate
    of the others, until none is above. Each step reads five sums, whatever the number of sources.
    """
    ranks = numbered(sizes, "source").withColumnRenamed("source", "__s")
    choice = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1)
    table = settle(
        sizes.join(ranks, F.col("source").eqNullSafe(F.col("__s"))).select("source", "source_size", choice.alias("weight"))
    )
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    full, n_full = F.lit(False), 0
    while True:
        left = table.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)).alias("fixed"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        over, free = budget - (left["fixed"] or 0), left["free"] or 0
        full = F.col("source_size") * (most * free) < F.lit(over) * F.col("weight")
        above = table.where(full).count() if free else n_full
        if above == n_full:
            break
        n_full = above
    rate = F.lit(over) * F.col("weight") / (free or 1)
    stopped = full if free else F.lit(True)
    return table.select("source", "source_size", F.when(stopped, F.col("source_size") * float(most)).otherwise(rate).alias("target"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken.

    ``taken`` counts words: whole epochs of the source, then the documents in hash-random order up to
    the rest of the budget; the document at the cut gives only its first words.
    """
    size = F.size(words_of(F.coalesce("text", F.lit("")))).cast("bigint")
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), key.alias("__key"))
    rows, totals = running(rows, "source", [F.col("__key"), F.col("size")], F.col("size"), "__start")
    goal = settle(targets(totals.withColumnRenamed("total", "source_size"), weights, share, most))
    rows = rows.join(goal.withColumnRenamed("source", "__g"), F.col("source").eqNullSafe(F.col("__g")))
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.floor(F.col("target")) - whole * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__start")))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + cut).cast("bigint").alias("taken")
    )


def oracle_sql(seed: str = "mix") -> str:
    """The same in SQL: the rate is found among the sources sorted by the rate that fills them."""
    return rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('{seed}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
      FROM d GROUP BY source),
    r AS (
      SELECT *, row_number() OVER (ORDER BY source_size * 1.0 / w, w) AS i,
             1.5 * sum(source_size) OVER () AS budget,
             coalesce(sum(source_size * 2) OVER (ORDER BY source_size * 1.0 / w, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
             sum(w) OVER (ORDER BY source_size * 1.0 / w, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
      FROM s),
    c AS (
      SELECT min(i) AS i FROM r WHERE source_size * 2 * free >= (budget - fixed) * w),
    t AS (
      SELECT source, source_size,
             CASE WHEN r.i < c.i THEN source_size * 2.0
                  ELSE CAST((SELECT budget - fixed FROM r x, c y WHERE x.i = y.i) AS DOUBLE) * w
                       / (SELECT free FROM r x, c y WHERE x.i = y.i) END AS target
      FROM r, c),
    o AS (
      SELECT d.doc_id, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(floor(target / greatest(source_size, 1)) * size
                + greatest(0, least(size, floor(target) - floor(target / greatest(source_size, 1)) * source_size - start)) AS BIGINT) AS taken
    FROM o"""
