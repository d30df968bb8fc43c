
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    """A schema in which every column is a nullable string."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The column order of the event log files.
EVENT_LOG_SCHEMA = strings(
    "destination",
    "core_time",
    "poller_time",
    "target_id",
    "policy_id",
    "policy_type",
    "detected_severity",
    "propagated_severity",
    "low_threshold",
    "measured_value",
    "high_threshold",
    "propagated_flag",
    "event_code",
    "metric_name",
)
SERIES_SCHEMA = T.StructType(
    [
        T.StructField("DeviceID", T.StringType()),
        T.StructField("poller_time", T.LongType()),
        T.StructField("target_id", T.StringType()),
        T.StructField("measured_value", T.DoubleType()),
        T.StructField("metric_name", T.StringType()),
    ]
)


@dataclass(frozen=True)
class DimensionSpec:
    """How a header CSV becomes a dimension: (source column, output column) pairs."""

    columns: tuple[tuple[str, str], ...]

    @property
    def source_names(self) -> list[str]:
        return list(dict.fromkeys(source for source, _ in self.columns))


# Source and output column names of the dimension files.
BUS_PARENT = DimensionSpec((("PARENT_ID", "PARENT_BUS_ID"), ("BUS_ID", "HIER_BUS_ID")))
CUSTOMER = DimensionSpec((("RECONCILIATION_ID", "RECONCILIATION_ID"), ("BUS_ID", "BUS_ID")))
DEVICE = DimensionSpec((("TARGET_ID", "DEVICE_TARGET_ID"), ("RECON_ID", "RECON_ID")))
DEVICE_LOCATION = DimensionSpec(
    (
        ("BUS_ID", "BUS_ID_DEV"),
        ("DEVICE_TYPE", "DEVICE_TYPE"),
        ("OPERATING_SYSTEM", "OPERATING_SYSTEM"),
        ("RECONCILIATION_ID", "RECONCILIATION_ID"),
        ("SITE", "SITE"),
        ("SITE", "SITE_DESC"),
        ("IS_VIRTUAL", "IS_VIRTUAL"),
    )
)
PARENT_MONITOR = DimensionSpec((("PARENT_ID", "PARENT_TARGET_ID"), ("TARGET_ID", "CHILD_TARGET_ID")))
MONITOR_TYPE = DimensionSpec((("TARGET_ID", "MONITOR_ID"), ("TYPE", "MONITOR_DESC")))
TOP_CLIENTS = DimensionSpec(
    (
        ("NEW_BUS_ID", "NEW_BUS_ID"),
        ("RECONCILIATION_NUM", "NUM_CUST_DEVICES"),
        ("PERCENT", "PERCENT"),
        ("CUMULATIVE_PERCENT", "CUMULATIVE_PERCENT"),
        ("RANK", "RANK"),
    )
)
INCIDENT = DimensionSpec(
    (
        ("incident_id", "INCIDENT_ID"),
        ("submit_date", "SUBMIT_DATE"),
        ("bus_id", "BUS_ID"),
        ("event_code", "EVENT_CODE"),
        ("submitter", "submitter"),
    )
)
INCIDENT_DEVICE = DimensionSpec((("incident_id", "INCIDENT_DEV_ID"), ("recon_id", "RECON_ID")))

# The published column order of the enriched event table.
EVENT_COLUMNS = (
    "DESTINATION",
    "CORE_TIME",
    "CORE_TIMESTAMP",
    "POLLER_TIME",
    "POLLER_TIMESTAMP",
    "TARGET_ID",
    "POLICY_ID",
    "DETECTED_SEVERITY",
    "PROPAGATED_SEVERITY",
    "LOW_THRESHOLD",
    "MEASURED_VALUE",
    "HIGH_THRESHOLD",
    "PROPAGATED_FLAG",
    "EVENT_CODE",
    "METRIC_NAME",
    "RECON_ID",
    "BUS_ID",
    "PARENT_BUS_ID",
    "NEW_BUS_ID",
    "NUM_CUST_DEVICES",
    "DEVICE_TYPE",
    "OPERATING_SYSTEM",
    "SITE",
    "SITE_DESC",
    "IS_VIRTUAL",
    "PARENT_TARGET_ID",
    "MONITOR_DESC",
)

# SQL column types of the two typed output tables.
MAPPING_COLUMN_TYPES = {
    "DESTINATION": "VARCHAR(10)",
    "CORE_TIMESTAMP": "TIMESTAMP",
    "POLLER_TIME": "BIGINT",
    "POLLER_TIMESTAMP": "TIMESTAMP",
    "TARGET_ID": "VARCHAR(20)",
    "POLICY_ID": "VARCHAR(20)",
    "DETECTED_SEVERITY": "INT",
    "PROPAGATED_SEVERITY": "INT",
    "LOW_THRESHOLD": "VARCHAR(200)",
    "MEASURED_VALUE": "VARCHAR(200)",
    "HIGH_THRESHOLD": "VARCHAR(200)",
    "PROPAGATED_FLAG": "VARCHAR(20)",
    "EVENT_CODE": "VARCHAR(20)",
    "METRIC_NAME": "VARCHAR(100)",
    "RECON_ID": "VARCHAR(50)",
    "PARENT_BUS_ID": "VARCHAR(20)",
    "NEW_BUS_ID": "VARCHAR(20)",
    "NUM_CUST_DEVICES": "INT",
    "DEVICE_TYPE": "VARCHAR(200)",
    "OPERATING_SYSTEM": "VARCHAR(200)",
    "SITE": "VARCHAR(200)",
    "SITE_DESC": "VARCHAR(200)",
    "IS_VIRTUAL": "VARCHAR(20)",
    "PARENT_TARGET_ID": "VARCHAR(20)",
    "MONITOR_DESC": "VARCHAR(200)",
    "CORE_TIME_NUM": "BIGINT",
    "INCIDENT_ID": "VARCHAR(50)",
    "SUBMIT_DATE": "TIMESTAMP",
    "SUBMIT_DATE_NUM": "BIGINT",
    "INC_EVENT_TIME_DIFF": "INT",
    "MIN_DIFF": "INT",
    "HAS_MAPPED_INCIDENT": "INT",
}
INCIDENT_COLUMN_TYPES = {
    "INCIDENT_ID": "VARCHAR(20)",
    "SUBMIT_DATE": "TIMESTAMP",
    "BUS_ID": "VARCHAR(20)",
    "EVENT_CODE_INC": "VARCHAR(20)",
    "RECON_ID_INC": "VARCHAR(50)",
    "Is_Source_Monitor": "INTEGER",
    "SUBMIT_DATE_NUM": "BIGINT",
}
