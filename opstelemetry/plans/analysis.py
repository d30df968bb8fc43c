"""Runs on the ETL's tables: metric profiles, classifiers, thresholds and forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opstelemetry.config import PROFILED_METRICS, SERIES_DEVICES
from opstelemetry.functions.scale import scratch, settle
from opstelemetry.operators.classify import (
    FULL_FEATURES,
    HOURLY,
    SINGLE_METRIC,
    Classifier,
    ClassifierConfig,
    evaluate_week,
    train_and_test,
)
from opstelemetry.operators.clients import client_rank, client_rollup, device_count, top_clients, top_talkers
from opstelemetry.operators.distribution import iqr_threshold, metric_profiles, seasonal_profile
from opstelemetry.operators.features import (
    clean_full,
    clean_single,
    hourly_training_set,
    neighbour_training_set,
    site_index,
    with_draw,
)
from opstelemetry.operators.filters import only
from opstelemetry.operators.forecast import (
    Forecaster,
    complete,
    forecast_recursive,
    select_forecaster,
)
from opstelemetry.operators.series import carry_forward, chrono_split, forecast_windows, number_steps, pivot_series
from opstelemetry.sources.readers import extract_devices
from opstelemetry.sources.writers import write_csv, write_profiles


def run_profiles(events: DataFrame, path: str, metrics: Sequence[str] = PROFILED_METRICS) -> None:
    """Profiles of all metrics by site, client and device, from one scan of the events."""
    with scratch(events.sparkSession):
        write_profiles(metric_profiles(events, metrics), path)


def run_client_selection(customer: DataFrame, bus_parent: DataFrame, path: str, n: int = 150) -> None:
    """The clients with most devices, as the file that the ETL reads as its top clients."""
    with scratch(customer.sparkSession):
        chosen = top_clients(client_rank(device_count(client_rollup(customer, bus_parent))), n)
        write_csv(chosen, path)


def run_device_extract(spark: SparkSession, logs: Sequence[str], devices: Sequence[str], path: str, partitions: int | None = None) -> None:
    """The four-column readings of some devices from whole event logs, as one CSV folder."""
    write_csv(extract_devices(spark, logs, devices, partitions=partitions), path)


def run_top_talkers(incidents: DataFrame, start: int, end: int, path: str, n: int = 20) -> None:
    """Devices with most incidents in a window, from the ETL's incidents table."""
    write_csv(top_talkers(incidents, start, end, n), path)


def run_training_set(mapping: DataFrame, path: str) -> None:
    """One feature week from an event-incident mapping."""
    with scratch(mapping.sparkSession):
        write_csv(neighbour_training_set(mapping), path)


def train_full(
    week: DataFrame, other_week: DataFrame | None = None, config: ClassifierConfig = FULL_FEATURES
) -> tuple[Classifier, DataFrame, DataFrame | None]:
    """All-metric classifier: model, scored hold-out and the other week's confusion table.

    A row's side of the split follows from its time, client and site.
    """
    sites = site_index(week)
    drawn = with_draw(week, ["POLLER_TIME", "NEW_BUS_ID", "SITE"], config.seed)
    model, scored = train_and_test(clean_full(drawn, sites), config, sites)
    if other_week is None:
        return model, scored, None
    return model, scored, score_other_week(model, other_week)


def score_other_week(model: Classifier, week: DataFrame) -> DataFrame:
    """Confusion table of another week, its features aligned with the model's."""
    return evaluate_week(model, clean_full(week, model.sites, drop_empty=False))


def train_single(
    weeks: Sequence[DataFrame], metric: str = "PctFree", config: ClassifierConfig = SINGLE_METRIC
) -> tuple[Classifier, DataFrame]:
    """Classifier on the values of one metric."""
    drawn = [with_draw(week, ["POLLER_TIME", "NEW_BUS_ID", "SITE"], config.seed) for week in weeks]
    return train_and_test(clean_single(drawn, metric), config)


def train_hourly(
    mapping: DataFrame, incidents: DataFrame, config: ClassifierConfig = HOURLY
) -> tuple[Classifier, DataFrame]:
    """Classifier on hourly aggregates."""
    # training and scoring read the aggregates several times
    return train_and_test(settle(hourly_training_set(mapping, incidents, draw_seed=config.seed)), config)


def run_thresholds(series: DataFrame, path: str) -> None:
    """Outlier thresholds per target and metric."""
    with scratch(series.sparkSession):
        write_csv(iqr_threshold(seasonal_profile(series)), path)


@dataclass(frozen=True)
class ForecastResult:
    model: Forecaster
    metrics: DataFrame
    forecasts: DataFrame


def forecast_devices(
    series: DataFrame,
    devices: Sequence[str] = SERIES_DEVICES,
    metric: str = "utilization",
    group: Sequence[str] = (),
    lookback: int = 10,
    horizons: int = 3,
    train_fraction: float = 0.99,
    gaps: str = "drop",
) -> ForecastResult:
    """Pivot, split by time, fit on the past and forecast the held-out windows step by step."""
    rows = only(series, "metric_name", [metric])
    wide = pivot_series(rows, devices, group=group)
    return forecast_wide(wide, len(devices), group, lookback, horizons, train_fraction, gaps)


def forecast_wide(
    wide: DataFrame,
    n_devices: int,
    group: Sequence[str] = (),
    lookback: int = 10,
    horizons: int = 3,
    train_fraction: float = 0.99,
    gaps: str = "drop",
) -> ForecastResult:
    """The same from an already pivoted series. Each half is numbered again for its own windows.

    ``gaps``: ``drop`` leaves out windows with a missing reading, ``carry`` fills it with the device's last
    one before. A test half too short for a window gives no forecasts.
    """
    if gaps not in ("drop", "carry"):
        raise ValueError("gaps must be 'drop' or 'carry'")
    if gaps == "carry":
        wide = carry_forward(settle(wide), n_devices, group)
    past, future = chrono_split(number_steps(wide, group), train_fraction)

    def windows(part: DataFrame) -> DataFrame:
        steps = number_steps(part.drop("step", "n_steps"), group)
        return complete(forecast_windows(steps, group, lookback, horizons), horizons)

    train, test = settle(windows(past)), settle(windows(future))
    model, metrics = select_forecaster(train, test, n_devices, lookback)
    return ForecastResult(model, metrics, forecast_recursive(model, test, horizons))


def series_from_extract(extract: DataFrame) -> DataFrame:
    """The four-column device extract (strings) as a typed series."""
    return extract.select(
        F.col("poller_time").try_cast("bigint").alias("poller_time"),
        "target_id",
        F.col("measured_value").try_cast("double").alias("measured_value"),
        "metric_name",
    )
