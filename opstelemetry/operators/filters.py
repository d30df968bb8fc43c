"""Projections, filters and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scalar import clean_site, epoch_col, missing_as_null
from opstelemetry.functions.scale import settle


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep and rename columns, ``{source: new name}``."""
    return df.select(*[F.col(source).alias(name) for source, name in mapping.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name; a name carried by both join sides goes twice."""
    return df.drop(*names)


def with_clean_site(df: DataFrame) -> DataFrame:
    """SITE_DESC keeps the raw name, SITE only its letters and digits."""
    return df.withColumns({"SITE": clean_site("SITE"), "SITE_DESC": F.col("SITE")})


def policy_filter(df: DataFrame) -> DataFrame:
    """Threshold policies only, without start notices (and without header lines read as data)."""
    return df.where((F.col("policy_type") == "T") & (F.col("metric_name") != "Started"))


def alarms(df: DataFrame) -> DataFrame:
    """P5: events of which either severity is not '0'."""
    return df.where((F.col("DETECTED_SEVERITY") != "0") | (F.col("PROPAGATED_SEVERITY") != "0"))


def flag_source(df: DataFrame) -> DataFrame:
    """0 for submitter 'Other', else 1 (an unknown submitter counts as a monitor)."""
    return df.withColumn("Is_Source_Monitor", F.when(F.col("submitter") == "Other", 0).otherwise(1))


def incidents_in(df: DataFrame, start: int, end: int) -> DataFrame:
    """Incidents raised by monitors in ``[start, end)``."""
    submitted = epoch_col("SUBMIT_DATE_MS")
    return df.where((F.col("Is_Source_Monitor") == 1) & (submitted >= start) & (submitted < end))


def time_diff(submit: str = "SUBMIT_DATE_NUM", core: str = "CORE_TIME_NUM") -> Column:
    """Seconds from event to incident."""
    return F.col(submit) - F.col(core)


def with_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    """P10: the same value on every row."""
    return df.withColumn(name, F.lit(value))


def canonical_site(df: DataFrame, spellings: Mapping[str, str], column: str = "SITE") -> DataFrame:
    """One spelling per site."""
    return df.replace(dict(spellings), subset=[column])


def valid_values(df: DataFrame, ceiling: float = 105.0, column: str = "MEASURED_VALUE") -> DataFrame:
    """Values as doubles, only up to the ceiling; unreadable values are dropped."""
    return df.withColumn(column, missing_as_null(column)).where(F.col(column) <= ceiling)


def only(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose column is one of the values."""
    return df.where(F.col(column).isin(*values))


def between_open(column: Column | str, low: object, high: object) -> Column:
    """Strictly between two bounds."""
    c = F.col(column) if isinstance(column, str) else column
    return (c > low) & (c < high)


def is_neighbour(diff: Column | str, radius: int = 3600) -> Column:
    """Closer than the radius; an unknown distance is no neighbour."""
    c = F.col(diff) if isinstance(diff, str) else diff
    return F.coalesce(F.abs(c) < radius, F.lit(False))


def all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every listed column is missing."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns]))


def has_value(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is present."""
    return df.where(F.col(column).isNotNull())


def zero_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zeros become missing (true zeros are lost as well)."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in columns})


def feature_names(df: DataFrame, label: str) -> list[str]:
    """All columns but the label, sorted by name."""
    return sorted(set(df.columns) - {label})


def drop_null_columns(df: DataFrame, how: str = "all") -> DataFrame:
    """Drop the columns that are NULL in all rows, or in any row.

    One aggregate over the data returns one row of counts.
    """
    if how not in ("all", "any"):
        raise ValueError("how must be 'all' or 'any'")
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(c)).alias(f"__n_{i}") for i, c in enumerate(df.columns)],
    ).first()
    present = {c: counts[f"__n_{i}"] for i, c in enumerate(df.columns)}
    if how == "all":
        gone = [c for c, n in present.items() if n == 0]
    else:
        gone = [c for c, n in present.items() if n < counts["__rows"]]
    return df.drop(*gone)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A unique row number, written once so that later reads see the same numbers."""
    return settle(df.withColumn(name, F.monotonically_increasing_id()))


def matched(df: DataFrame) -> DataFrame:
    """Alarm rows that met an incident."""
    return df.where(F.col("SUBMIT_DATE_NUM") != 0)


def mapped(df: DataFrame) -> DataFrame:
    """Alarm rows that are the nearest of their incident."""
    return df.where(F.col("HAS_MAPPED_INCIDENT") == 1)


def append_frames(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
