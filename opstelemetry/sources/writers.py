"""Sinks (K1–K6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _spark_type(sql_type: str) -> str:
    name = sql_type.upper()
    return "string" if name.startswith("VARCHAR") else name.lower()


def apply_column_types(df: DataFrame, column_types: Mapping[str, str]) -> DataFrame:
    """Give the listed columns the table's types; unreadable values become NULL."""
    return df.select(
        *[
            F.col(c).try_cast(_spark_type(column_types[c])).alias(c) if c in column_types else F.col(c)
            for c in df.columns
        ]
    )


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    column_types: Mapping[str, str] | None = None,
) -> None:
    """K1–K3: append to or overwrite a Parquet table, typed like the SQL table where asked."""
    typed = apply_column_types(df, column_types) if column_types else df
    typed.write.mode(mode).parquet(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "append",
    column_types: Mapping[str, str] | None = None,
    batch_size: int = 10000,
) -> None:
    """K1–K3 against a database. Address and credentials come from the caller only."""
    writer = df.write.mode(mode).option("batchsize", batch_size)
    if column_types:
        listed = ", ".join(f"{name} {kind}" for name, kind in column_types.items() if name in df.columns)
        writer = writer.option("createTableColumnTypes", listed)
    writer.jdbc(url, table, properties=dict(properties))


def write_profiles(profiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: metric profiles as CSV, one folder per metric and grouping level."""
    profiles.write.mode(mode).partitionBy("METRIC_NAME", "level").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: a folder of CSV part files with headers."""
    df.write.mode(mode).option("header", True).csv(path)


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("METRIC_NAME",),
    sort_by: Sequence[str] = ("CORE_TIME_NUM", "RECON_ID", "EVENT_CODE"),
    mode: str = "overwrite",
    partitions: int | None = None,
) -> None:
    """K6: lay a table out for lookups by its partition and sort columns.

    Range partitioning gives each file a narrow slice of the sort columns, so a filter on
    them skips files by their min/max statistics, and a large metric spreads over many files.
    """
    keys = [F.col(c) for c in (*partition_by, *sort_by)]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
