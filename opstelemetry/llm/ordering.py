"""Orders over all rows without one task that sees them all: range sort, settle, offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opstelemetry.functions.scale import settle


def placed(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-sort and settle, with ``__part`` and ``__at``: the partition and the place inside it.

    The settled rows fix the borders, which sampling may set otherwise on another run.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    spot = F.monotonically_increasing_id()
    return settle(ranged.withColumns({"__part": F.shiftrightunsigned(spot, 33), "__at": spot.bitwiseAND(2**33 - 1)}))


def running(df: DataFrame, group: str, order: Sequence[str | Column], value: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``name``, the sum of ``value`` over the rows before in the group; and the groups' sums.

    The rows are range-sorted by group (nulls last) and ``order``, which splits a hot group over
    partitions; the sums of the partitions, a row each, give the offsets. Groups are null-safe.
    """
    rows = placed(df.withColumn("__value", value), [F.col(group).asc_nulls_last(), *order])
    parts = settle(rows.groupBy(group, "__part").agg(F.sum("__value").alias("__sum")))
    before = W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offset = parts.select(
        F.col(group).alias("__g"),
        F.col("__part").alias("__p"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"),
    )
    inside = W.partitionBy("__part", group).orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumn("__in", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    same = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g"))
    summed = local.join(offset, same).withColumn(name, F.col("__before") + F.col("__in"))
    totals = parts.groupBy(group).agg(F.sum("__sum").alias("total"))
    return summed.drop("__part", "__at", "__value", "__in", "__g", "__p", "__before"), totals


def numbered(df: DataFrame, column: str) -> DataFrame:
    """(column, place from 0 by code point, nulls last) of a table of distinct values."""
    rows = placed(df.select(column), [F.col(column).asc_nulls_last()])
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    joined = rows.join(first, F.col("__part") == F.col("__p"))
    return joined.select(column, (F.col("__first") + F.col("__at")).alias("place"))
