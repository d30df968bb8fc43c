from opstelemetry.functions.scalar import (
    clean_site,
    epoch_col,
    fmt_time,
    hour_bucket,
    hour_of,
    missing_as_null,
    push_window,
    to_ts,
    try_num,
    weekday_of,
)
from opstelemetry.functions.scale import (
    in_order,
    lookup_join,
    measured_bytes,
    running_totals,
    settle,
)

__all__ = [
    "clean_site",
    "epoch_col",
    "fmt_time",
    "hour_bucket",
    "hour_of",
    "in_order",
    "lookup_join",
    "measured_bytes",
    "missing_as_null",
    "push_window",
    "running_totals",
    "settle",
    "to_ts",
    "try_num",
    "weekday_of",
]
