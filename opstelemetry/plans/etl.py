"""Batch ETL: logs and dimensions in, enriched events, mapping and incidents out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opstelemetry import schemas
from opstelemetry.config import Config, configure
from opstelemetry.functions.scale import scratch, settle
from opstelemetry.operators.correlate import correlate, with_core_number
from opstelemetry.operators.enrich import Dimensions, enrich_events, prepare_incidents
from opstelemetry.operators.filters import alarms
from opstelemetry.sources.readers import good_lines, line_counts, read_dimension, scan_event_log
from opstelemetry.sources.writers import apply_column_types, write_clustered, write_jdbc, write_table


@dataclass(frozen=True)
class EtlInputs:
    """Paths of the input files."""

    event_logs: list[str]
    device: str
    customer: str
    bus_parent: str
    top_clients: str
    device_location: str
    parent_monitor: str
    monitor_type: str
    incidents: str
    incident_device: str


@dataclass(frozen=True)
class Layout:
    """K6: how a table's files lie: folders by the first columns, sorted by the others."""

    partition_by: tuple[str, ...]
    sort_by: tuple[str, ...]


# Lookups by metric and day read their folders only; inside, statistics of the sorted columns skip row groups.
LAYOUTS = {
    "events": Layout(("METRIC_NAME", "CORE_DAY"), ("CORE_TIME", "RECON_ID", "EVENT_CODE")),
    "event_incident_mapping": Layout(("METRIC_NAME", "CORE_DAY"), ("CORE_TIME_NUM", "RECON_ID", "EVENT_CODE")),
    "incidents": Layout((), ("SUBMIT_DATE_NUM", "RECON_ID_INC", "EVENT_CODE_INC")),
}


class Sink(Protocol):
    def put(self, df: DataFrame, table: str, mode: str, types: Mapping[str, str] | None) -> None: ...


@dataclass(frozen=True)
class ParquetSink:
    """Tables as Parquet folders under one root, laid out as ``LAYOUTS`` says; others as they come.

    CORE_DAY is added to a table that lies by day, from its CORE_TIMESTAMP.
    """

    root: str

    def put(self, df: DataFrame, table: str, mode: str, types: Mapping[str, str] | None) -> None:
        layout = LAYOUTS.get(table)
        if layout is None:
            write_table(df, f"{self.root}/{table}", mode, types)
            return
        typed = apply_column_types(df, types) if types else df
        if "CORE_DAY" in layout.partition_by:
            typed = typed.withColumn("CORE_DAY", F.date_format("CORE_TIMESTAMP", "yyyy-MM-dd"))
        write_clustered(typed, f"{self.root}/{table}", layout.partition_by, layout.sort_by, mode)


@dataclass(frozen=True)
class JdbcSink:
    """Tables of a database; address and credentials are the caller's."""

    url: str
    properties: Mapping[str, str]

    def put(self, df: DataFrame, table: str, mode: str, types: Mapping[str, str] | None) -> None:
        write_jdbc(df, self.url, table, self.properties, mode, types)


def load_dimensions(spark: SparkSession, inputs: EtlInputs) -> Dimensions:
    return Dimensions(
        device=read_dimension(spark, inputs.device, schemas.DEVICE),
        customer=read_dimension(spark, inputs.customer, schemas.CUSTOMER),
        bus_parent=read_dimension(spark, inputs.bus_parent, schemas.BUS_PARENT),
        top_clients=read_dimension(spark, inputs.top_clients, schemas.TOP_CLIENTS),
        device_location=read_dimension(spark, inputs.device_location, schemas.DEVICE_LOCATION),
        parent_monitor=read_dimension(spark, inputs.parent_monitor, schemas.PARENT_MONITOR),
        monitor_type=read_dimension(spark, inputs.monitor_type, schemas.MONITOR_TYPE),
    )


def mapping_of(
    enriched: DataFrame, incidents: DataFrame, seconds: int = Config.match_seconds
) -> DataFrame:
    """Alarms of the enriched events, matched to incidents and flagged."""
    return correlate(with_core_number(alarms(enriched)), incidents, seconds)


@dataclass(frozen=True)
class EtlReport:
    """Lines of the event logs, and how many of them were malformed and left out."""

    lines: int
    malformed: int


def log_partitions(spark: SparkSession, paths: list[str], config: Config) -> int | None:
    """How many partitions a log is spread to after decoding: as set, or the shuffle's number for gzip files."""
    if config.log_partitions:
        return config.log_partitions
    return int(spark.conf.get("spark.sql.shuffle.partitions")) if any(p.endswith(".gz") for p in paths) else None


def run_etl(spark: SparkSession, inputs: EtlInputs, sink: Sink, config: Config | None = None) -> EtlReport:
    """Append events and mapping, replace incidents.

    The logs are parsed and enriched once, into the shared folder; the events table, the alarms and their
    mapping are made from that. What was settled on the way is removed at the end.
    """
    config = config or Config()
    configure(spark)
    counts = Observation()
    with scratch(spark):
        lines = scan_event_log(spark, inputs.event_logs, partitions=log_partitions(spark, inputs.event_logs, config))
        enriched = settle(enrich_events(good_lines(lines, counts), load_dimensions(spark, inputs)))
        incidents = settle(
            prepare_incidents(
                read_dimension(spark, inputs.incidents, schemas.INCIDENT),
                read_dimension(spark, inputs.incident_device, schemas.INCIDENT_DEVICE),
                config.incident_start,
                config.incident_end,
            )
        )
        sink.put(enriched, "events", "append", None)
        mapping = correlate(with_core_number(alarms(enriched)), incidents, config.match_seconds)
        sink.put(mapping, "event_incident_mapping", "append", schemas.MAPPING_COLUMN_TYPES)
        sink.put(incidents, "incidents", "overwrite", schemas.INCIDENT_COLUMN_TYPES)
        # with an empty dimension Spark skips the logs, and only then are they read for the counts
        found = line_counts(lines) if enriched.isEmpty() else counts.get
    return EtlReport(**found)
