"""Enrichment of events and incidents with their dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scalar import epoch_col, to_ts
from opstelemetry.functions.scale import BROADCAST_BYTES, lookup_join, settle
from opstelemetry.operators.filters import flag_source, incidents_in, policy_filter, with_clean_site
from opstelemetry.schemas import EVENT_COLUMNS


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables of the enrichment, under their renamed columns."""

    device: DataFrame
    customer: DataFrame
    bus_parent: DataFrame
    top_clients: DataFrame
    device_location: DataFrame
    parent_monitor: DataFrame
    monitor_type: DataFrame


def join_device(rows: DataFrame, device: DataFrame, **options) -> DataFrame:
    """Inner on the monitor target."""
    return lookup_join(rows, device, {"TARGET_ID": "DEVICE_TARGET_ID"}, "inner", **options)


def join_customer(rows: DataFrame, customer: DataFrame, **options) -> DataFrame:
    """Inner on the device's reconciliation id."""
    return lookup_join(rows, customer, {"RECON_ID": "RECONCILIATION_ID"}, "inner", **options)


def join_bus_parent(rows: DataFrame, bus_parent: DataFrame, **options) -> DataFrame:
    """Left on the business id."""
    return lookup_join(rows, bus_parent, {"BUS_ID": "HIER_BUS_ID"}, "left", **options)


def _client_columns(top_clients: DataFrame) -> DataFrame:
    return top_clients.drop("PERCENT", "CUMULATIVE_PERCENT", "RANK")


def _either_client(rows: DataFrame) -> DataFrame:
    ids = F.array_distinct(F.array_compact(F.array("BUS_ID", "PARENT_BUS_ID")))
    return rows.withColumn("__client", F.explode(ids))


def join_top_clients(rows: DataFrame, top_clients: DataFrame, **options) -> DataFrame:
    """Keep rows whose own or parent business id is a top client.

    The OR of two equalities becomes one equality: each row lists its one or two different
    ids, so it meets each matching client once. Rows matching two clients come out twice.
    """
    clients = _client_columns(top_clients).withColumn("__client_id", F.col("NEW_BUS_ID"))
    joined = lookup_join(_either_client(rows), clients, {"__client": "__client_id"}, "inner", **options)
    return joined.drop("__client")


def join_location(rows: DataFrame, device_location: DataFrame, **options) -> DataFrame:
    """Left on the device's reconciliation id."""
    location = device_location.drop("BUS_ID_DEV")
    return lookup_join(rows, location, {"RECON_ID": "RECONCILIATION_ID"}, "left", **options)


def join_parent_monitor(rows: DataFrame, parent_monitor: DataFrame, **options) -> DataFrame:
    """Left on the monitor target; several parents give several rows."""
    return lookup_join(rows, parent_monitor, {"TARGET_ID": "CHILD_TARGET_ID"}, "left", **options)


def join_monitor_type(rows: DataFrame, monitor_type: DataFrame, **options) -> DataFrame:
    """Left on the monitor target."""
    return lookup_join(rows, monitor_type, {"TARGET_ID": "MONITOR_ID"}, "left", **options)


def target_dimension(dims: Dimensions) -> DataFrame:
    """J1–J7 among the dimensions alone: every attribute an event takes from its target.

    All seven joins of the enrichment hang on the event's target only, so they can be made
    between dimensions first; events then need a single join.
    """
    def left(rows: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
        return rows.join(dim, F.col(key) == F.col(dim_key), "left").drop(dim_key)

    location = with_clean_site(dims.device_location).drop("BUS_ID_DEV")
    targets = dims.device.join(
        dims.customer, F.col("RECON_ID") == F.col("RECONCILIATION_ID"), "inner"
    ).drop("RECONCILIATION_ID")
    targets = left(targets, dims.bus_parent, "BUS_ID", "HIER_BUS_ID")
    targets = _either_client(targets).join(
        _client_columns(dims.top_clients), F.col("__client") == F.col("NEW_BUS_ID"), "inner"
    ).drop("__client")
    targets = left(targets, location, "RECON_ID", "RECONCILIATION_ID")
    targets = left(targets, dims.parent_monitor, "DEVICE_TARGET_ID", "CHILD_TARGET_ID")
    return left(targets, dims.monitor_type, "DEVICE_TARGET_ID", "MONITOR_ID")


def enrich_events(
    event_log: DataFrame, dims: Dimensions, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Threshold events of top clients with the 27 published columns.

    The joined dimensions are written once: every later use of the events reads them back
    instead of joining them again, and their size is known before the events meet them.
    """
    rows = join_device(
        policy_filter(event_log), settle(target_dimension(dims)), broadcast_bytes=broadcast_bytes
    )
    rows = rows.withColumns(
        {"CORE_TIMESTAMP": to_ts("core_time"), "POLLER_TIMESTAMP": to_ts("poller_time")}
    )
    return rows.select(*[F.col(c).alias(c) for c in EVENT_COLUMNS])


def join_incident_device(incidents: DataFrame, incident_device: DataFrame) -> DataFrame:
    """One row per incident and affected device."""
    return incidents.join(
        incident_device, F.col("INCIDENT_ID") == F.col("INCIDENT_DEV_ID"), "inner"
    ).drop("INCIDENT_DEV_ID")


def prepare_incidents(
    incidents: DataFrame, incident_device: DataFrame, start: int, end: int
) -> DataFrame:
    """Monitor-raised incidents of the window with their devices."""
    rows = join_incident_device(flag_source(incidents), incident_device).select(
        "INCIDENT_ID",
        F.col("SUBMIT_DATE").alias("SUBMIT_DATE_MS"),
        to_ts("SUBMIT_DATE").alias("SUBMIT_DATE"),
        "BUS_ID",
        F.col("EVENT_CODE").alias("EVENT_CODE_INC"),
        F.col("RECON_ID").alias("RECON_ID_INC"),
        "Is_Source_Monitor",
    )
    return (
        incidents_in(rows, start, end)
        .withColumn("SUBMIT_DATE_NUM", epoch_col("SUBMIT_DATE_MS"))
        .drop("SUBMIT_DATE_MS")
    )
