"""Scans (S1–S9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opstelemetry.schemas import EVENT_LOG_SCHEMA, SERIES_SCHEMA, DimensionSpec


def _header_csv(spark: SparkSession) -> DataFrameReader:
    # Without a schema every column is a string, found by its header name.
    return spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)


def read_dimension(spark: SparkSession, path: str | Sequence[str], spec: DimensionSpec) -> DataFrame:
    """Header CSV of strings, reduced to the columns of ``spec`` under their new names."""
    raw = _header_csv(spark).csv(path)
    return raw.select(*[F.col(source).alias(name) for source, name in spec.columns])


def scan_event_log(
    spark: SparkSession, paths: str | Sequence[str], header: bool = False, partitions: int | None = None
) -> DataFrame:
    """Every line of the event logs: the fixed schema, ``_malformed`` and ``_file``.

    ``_malformed`` holds the text of a line with too few or too many fields and is NULL for good ones.
    Column pruning is off in the parser: with it, a line counts as malformed or not depending on which
    columns a query happens to read. A gzip log is decoded by one task; ``partitions`` spreads its rows
    directly after, before anything is computed on them.
    """
    # Spark refuses to read the text of malformed lines alone, as a count does; so it depends on a field.
    with_field = F.octet_length(F.coalesce("destination", F.lit(""))) >= 0
    schema = T.StructType([*EVENT_LOG_SCHEMA.fields, T.StructField("_malformed", T.StringType())])
    lines = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("ignoreLeadingWhiteSpace", True)
        .option("columnPruning", False)
        .csv(paths)
        .select(*EVENT_LOG_SCHEMA.names, F.when(with_field, F.col("_malformed")).alias("_malformed"), F.col("_metadata.file_path").alias("_file"))
    )
    return lines.repartition(partitions) if partitions else lines


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("lines"), F.count("_malformed").alias("malformed")]


def line_counts(lines: DataFrame) -> dict[str, int]:
    """``lines`` and how many of them are ``malformed``."""
    return lines.agg(*_counts()).first().asDict()


def good_lines(lines: DataFrame, counts: Observation | None = None) -> DataFrame:
    """The well-formed events. ``counts`` receives the counts of lines from the same pass."""
    if counts is not None:
        lines = lines.observe(counts, *_counts())
    return lines.where(F.col("_malformed").isNull()).drop("_malformed", "_file")


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Per file, how many lines are malformed, and the first of their texts and of their first fields."""
    bad = lines.where(F.col("_malformed").isNotNull())
    return bad.groupBy("_file").agg(
        F.count("_malformed").alias("malformed"), F.min("_malformed").alias("example"), F.min("destination").alias("first_field")
    )


def read_event_log(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: bool = False,
    partitions: int | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """Event logs with the fixed schema; malformed lines are left out, and counted where asked."""
    return good_lines(scan_event_log(spark, paths, header, partitions), counts)


def read_series(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S3: headerless series with positional names, without its device column."""
    return spark.read.schema(SERIES_SCHEMA).csv(path).drop("DeviceID")


def read_header_series(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Series with a header, without the column ``unknown``."""
    raw = _header_csv(spark).csv(path).drop("unknown")
    time, device, value, *rest = raw.columns
    return raw.select(
        F.col(time).try_cast("bigint").alias("poller_time"),
        F.col(device).alias("target_id"),
        F.col(value).try_cast("double").alias("measured_value"),
        *rest,
    )


def extract_devices(
    spark: SparkSession,
    paths: str | Sequence[str],
    device_ids: Sequence[str],
    header: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Four columns of the event logs, for the listed devices only."""
    log = read_event_log(spark, paths, header=header, partitions=partitions)
    return log.where(F.col("target_id").isin(*[str(d) for d in device_ids])).select(
        "poller_time", "target_id", "measured_value", "metric_name"
    )


def metric_samples(df: DataFrame, metric: str) -> DataFrame:
    """Readings of one metric with the columns that profiles need."""
    return df.where(F.col("METRIC_NAME") == F.lit(metric)).select(
        "RECON_ID", "NEW_BUS_ID", "SITE", "MEASURED_VALUE"
    )


def metric_subset(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Rows of the listed metrics."""
    return df.where(F.col("METRIC_NAME").isin(*metrics))


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_clustered(
    spark: SparkSession,
    path: str,
    metrics: Sequence[str] | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
    day: str = "CORE_DAY",
) -> DataFrame:
    """A table laid out by metric and day; only the folders asked for are listed and read."""
    table = spark.read.parquet(path)
    if metrics is not None:
        table = table.where(F.col("METRIC_NAME").isin(*metrics))
    if first_day is not None:
        table = table.where(F.col(day) >= F.lit(first_day))
    if last_day is not None:
        table = table.where(F.col(day) <= F.lit(last_day))
    return table


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; give a numeric column and its range to read it in parallel."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties),
    )


def read_features(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    index_column: str | None = None,
) -> DataFrame:
    """A feature-set CSV with a header, without its index column."""
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return raw.drop(index_column) if index_column else raw
