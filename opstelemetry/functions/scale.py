"""Building blocks that keep joins and running totals even when one key dominates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A session on one machine may leave it unset and gets a temporary folder; on a cluster that
    would be another disk for each executor, so there an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="opstelemetry-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that no other call gets; ``scratch`` removes it at the end of a run."""
    path = f"{scratch_root(spark)}/opstelemetry/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def settle(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """K7: write an intermediate to the shared folder as Parquet and read it back.

    It is computed once, survives lost executors, and later reads take only the columns they need.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled = path
    return out


def remove(settled: DataFrame) -> None:
    """Remove the files of a table that ``settle`` returned; nothing may read it any more."""
    _delete(settled.sparkSession, settled._settled)
    _written.remove(settled._settled)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was settled inside; results must have been written by then."""
    before = len(_written)
    try:
        yield
    finally:
        for path in _written[before:]:
            _delete(spark, path)
        del _written[before:]


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values, from one distributed aggregate that returns a single row."""
    width: Column = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        elif isinstance(field.dataType, T.AtomicType):
            width = width + 8
        else:
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    total = df.agg(F.sum(width.cast("bigint")).alias("bytes")).first()
    return int(total["bytes"] or 0)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Join a fact table to a lookup table on ``{fact column: lookup column}``.

    The lookup is broadcast only when its measured size is within ``broadcast_bytes``, so a
    hot key never moves. Beyond that it is a sort-merge join, in which adaptive execution
    splits the partitions of hot fact keys. ``dim_bytes`` is an upper bound of the lookup's
    size where the caller has measured one. The lookup's key columns are not returned.
    """
    key_of = {d: f"__key_{i}" for i, d in enumerate(on.values())}
    payload = [c for c in dim.columns if c not in key_of]
    side = dim.select(*[F.col(d).alias(k) for d, k in key_of.items()], *payload)
    size = measured_bytes(side) if dim_bytes is None else dim_bytes
    if size <= broadcast_bytes:
        side = F.broadcast(side)
    else:
        side = side.hint("merge")
    condition: Column = F.lit(True)
    for f, d in on.items():
        left, right = F.col(f), F.col(key_of[d])
        match = left.eqNullSafe(right) if null_safe else left == right
        condition = condition & match
    return fact.join(side, condition, how).drop(*key_of.values())


def in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-sort and settle, with ``__part`` and ``__at``: the partition and the place inside it.

    The settled rows fix the partitions' borders, which sampling may set otherwise on another run. The
    borders are sampled from ``df``, which is evaluated once up to its last shuffle and twice from there:
    settle a costly table without a shuffle first.
    """
    spot = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(ranged.withColumns({"__part": F.shiftrightunsigned(spot, 33), "__at": spot.bitwiseAND(2**33 - 1)}))


def running_totals(
    df: DataFrame,
    totals: Mapping[str, Column],
    order: Sequence[Column],
    group: Sequence[str] = (),
    part: str | None = None,
) -> DataFrame:
    """Add running totals over a long ordering without sorting it in one task.

    Rows are range-sorted by group and ``order``, so a hot group spreads over partitions; Spark's total
    order holds for every value, NULL and NaN included, and a NULL group is a group. Totals are
    accumulated inside partitions. Only a group that crosses a border needs an offset: two rows a
    partition at most, which are broadcast. ``<name>_all`` carries the group's grand total, and
    ``part`` names a column for the partition.
    """
    group, values = list(group), {name: f"__v_{name}" for name in totals}
    rows = df.withColumns({values[n]: c for n, c in totals.items()})
    rows = in_order(rows, [*[F.col(g).asc_nulls_first() for g in group], *order])
    sums = rows.groupBy("__part", *group).agg(*[F.sum(v).alias(v) for v in values.values()])
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    spans = sums.select(
        F.col("__part").alias("__o_part"),
        *[F.col(g).alias(f"__o_{g}") for g in group],
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__before_{n}") for n, v in values.items()],
        *[F.sum(v).over(whole).alias(f"__all_{n}") for n, v in values.items()],
        F.count(F.lit(1)).over(whole).alias("__parts"),
    ).where("__parts > 1")
    inside = W.partitionBy("__part", *group)
    upto = inside.orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns(
        {f"__in_{n}": F.sum(v).over(upto) for n, v in values.items()}
        | {f"__sum_{n}": F.sum(v).over(inside) for n, v in values.items()}
    )
    same: Column = F.col("__part") == F.col("__o_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__o_{g}"))
    joined = local.join(F.broadcast(spans), same, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"__in_{n}") + F.coalesce(f"__before_{n}", F.lit(0))).alias(n) for n in totals],
        *[F.coalesce(f"__all_{n}", f"__sum_{n}").alias(f"{n}_all") for n in totals],
        *([F.col("__part").alias(part)] if part else []),
    )
