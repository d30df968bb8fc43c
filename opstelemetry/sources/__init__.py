from opstelemetry.sources.readers import (
    extract_devices,
    metric_samples,
    good_lines,
    malformed_lines,
    metric_subset,
    read_clustered,
    read_dimension,
    read_event_log,
    read_features,
    read_header_series,
    read_jdbc_table,
    read_series,
    read_table,
    scan_event_log,
)
from opstelemetry.sources.writers import (
    write_clustered,
    write_csv,
    write_jdbc,
    write_profiles,
    write_table,
)

__all__ = [
    "extract_devices",
    "metric_samples",
    "good_lines",
    "malformed_lines",
    "metric_subset",
    "read_clustered",
    "read_dimension",
    "read_event_log",
    "read_features",
    "read_header_series",
    "read_jdbc_table",
    "read_series",
    "read_table",
    "scan_event_log",
    "write_clustered",
    "write_csv",
    "write_jdbc",
    "write_profiles",
    "write_table",
]
