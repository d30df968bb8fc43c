"""Rounds of a longer computation."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from opstelemetry.functions.scale import remove, settle


def finished(df: DataFrame, *spent: DataFrame, compression: str = "snappy") -> DataFrame:
    """Settle the result of a round, remove the ``spent`` ones, and let go of its shuffle files.

    Spark removes a shuffle's files when the driver's garbage collector finds that nothing refers to it
    any more, by default within half an hour. Rounds that shuffle much ask for it when they end.
    """
    out = settle(df, compression)
    for table in spent:
        remove(table)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out
