"""Labels and features for the incident classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.config import SPARSE_FEATURES, TARGET_METRICS, TRAINING_SITE_SPELLINGS
from opstelemetry.functions.scalar import hour_bucket, hour_of, missing_as_null, weekday_of
from opstelemetry.functions.scale import lookup_join, running_totals, settle
from opstelemetry.operators.correlate import neighbour_label
from opstelemetry.operators.filters import (
    all_null,
    append_frames,
    canonical_site,
    drop_null_columns,
    has_value,
    only,
    valid_values,
    zero_to_null,
)

_HOURLY_KEYS = ["RECON_ID", "METRIC_NAME", "POLLER_TIME_PERIOD_60_MIN"]


# -- hourly aggregates ---------------------------------------------------------------------


def hourly_match(mapping: DataFrame, incidents: DataFrame, seconds: int = 3600) -> DataFrame:
    """Each event with every incident of its device, code and hour; event rows repeat."""
    events = mapping.drop("INCIDENT_ID").withColumn(
        "POLLER_TIME_PERIOD_60_MIN", hour_bucket("POLLER_TIME", seconds)
    )
    right = incidents.select(
        F.col("INCIDENT_ID").alias("INCIDENT_ID_y"),
        F.col("RECON_ID_INC").alias("__recon"),
        F.col("EVENT_CODE_INC").alias("__code"),
        hour_bucket("SUBMIT_DATE_NUM", seconds).alias("__bucket"),
    )
    return events.join(
        right,
        (F.col("RECON_ID") == F.col("__recon"))
        & (F.col("POLLER_TIME_PERIOD_60_MIN") == F.col("__bucket"))
        & F.col("EVENT_CODE").eqNullSafe(F.col("__code")),
        "left",
    ).drop("__recon", "__code", "__bucket")


def incident_coverage(hourly: DataFrame, column: str = "INCIDENT_ID_y") -> DataFrame:
    """Number of different incidents met, where "no incident" counts as one more."""
    return hourly.agg(
        (F.countDistinct(column) + F.max(F.col(column).isNull().cast("bigint"))).alias("incidents")
    )


def group_transform(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates of each row's group on every row.

    The groups are aggregated first, with partial sums on the map side, and joined back, so a
    large group is never held in a window's buffer.
    """
    side = df.groupBy(*[F.col(k).alias(f"__g_{k}") for k in keys]).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    on: Column = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    return df.join(side, on, "left").drop(*[f"__g_{k}" for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A10: the first row of each key in the given order.

    The order must tell rows apart. Uses a min over (order, row), which combines before the
    shuffle.
    """
    ranks = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(ranks)], F.struct(*rest).alias("row"))
    firsts = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return firsts.select(*keys, "__first.row.*").select(*df.columns)


def hourly_features(mapping: DataFrame, incidents: DataFrame, seconds: int = 3600) -> DataFrame:
    """J12 + A9 + A10: one row per (device, metric, hour) with its value statistics.

    An event counts once per incident of its device, code and hour, as in the joined rows.
    Events and incidents are aggregated before they meet, and the number of incidents enters
    as a weight, so the repeated rows are never made.
    """
    bucket = hour_bucket("POLLER_TIME", seconds)
    value = missing_as_null("MEASURED_VALUE")
    events = (
        mapping.select(
            "RECON_ID",
            "METRIC_NAME",
            bucket.alias("POLLER_TIME_PERIOD_60_MIN"),
            "EVENT_CODE",
            value.alias("v"),
            F.coalesce(F.col("HAS_MAPPED_INCIDENT") == 1, F.lit(False)).alias("hit"),
        )
        .where(F.col("RECON_ID").isNotNull() & F.col("METRIC_NAME").isNotNull())
        .where(F.col("POLLER_TIME_PERIOD_60_MIN").isNotNull())
        .groupBy(*_HOURLY_KEYS, "EVENT_CODE")
        .agg(
            F.sum("v").alias("s"),
            F.count("v").alias("n"),
            F.max("v").alias("hi"),
            F.min("v").alias("lo"),
            F.bool_or("hit").alias("hit"),
        )
    )
    met = (
        incidents.groupBy(
            F.col("RECON_ID_INC").alias("__recon"),
            F.col("EVENT_CODE_INC").alias("__code"),
            hour_bucket("SUBMIT_DATE_NUM", seconds).alias("__bucket"),
        )
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    weighted = events.join(
        met,
        (F.col("RECON_ID") == F.col("__recon"))
        & (F.col("POLLER_TIME_PERIOD_60_MIN") == F.col("__bucket"))
        & F.col("EVENT_CODE").eqNullSafe(F.col("__code")),
        "left",
    ).withColumn("w", F.coalesce("__times", F.lit(1)))
    total = F.sum(F.col("n") * F.col("w"))
    return weighted.groupBy(*_HOURLY_KEYS).agg(
        F.try_divide(F.sum(F.col("s") * F.col("w")), total).alias("MEAN"),
        F.max("hi").alias("MAX"),
        F.min("lo").alias("MIN"),
        total.alias("COUNT"),
        F.bool_or("hit").alias("HAS_MAPPED_INCIDENT_MERGED"),
    )


def spread_stats(
    df: DataFrame,
    metrics: Sequence[str] = TARGET_METRICS,
    stats: Sequence[str] = ("MEAN", "MIN", "MAX", "COUNT"),
) -> DataFrame:
    """One column per metric and statistic, filled on the rows of that metric."""
    return df.withColumns(
        {f"{m}_{s}": F.when(F.col("METRIC_NAME") == m, F.col(s)) for m in metrics for s in stats}
    )


def hourly_training_set(
    mapping: DataFrame,
    incidents: DataFrame,
    metrics: Sequence[str] = TARGET_METRICS,
    seconds: int = 3600,
    draw_seed: int | None = None,
) -> DataFrame:
    """M2: labelled hourly aggregates with their hour and weekday; with a seed, a draw by device, metric and hour."""
    wide = spread_stats(hourly_features(only(mapping, "METRIC_NAME", list(metrics)), incidents, seconds), metrics)
    start = F.col("POLLER_TIME_PERIOD_60_MIN") * F.lit(seconds)
    if draw_seed is not None:
        wide = with_draw(wide, _HOURLY_KEYS, draw_seed)
    return wide.withColumns({"WEEKDAY": weekday_of(start), "HOUR": hour_of(start)}).drop(
        *_HOURLY_KEYS, "MEAN", "MIN", "MAX"
    )


# -- single events -------------------------------------------------------------------------


def metric_one_hot(df: DataFrame, metrics: Sequence[str] = TARGET_METRICS) -> DataFrame:
    """A 0/1 column per metric, beside the metric's name."""
    return df.withColumns(
        {f"METRIC_NAME_{m}": F.coalesce((F.col("METRIC_NAME") == m).cast("int"), F.lit(0)) for m in metrics}
    )


def spread_values(
    df: DataFrame, metrics: Sequence[str] = TARGET_METRICS, zero_as_null: bool = True
) -> DataFrame:
    """The value in the column of its metric; a value of 0 is lost unless asked for."""
    wide = df.withColumns(
        {f"{m}_VALUE": F.when(F.col("METRIC_NAME") == m, F.col("MEASURED_VALUE")) for m in metrics}
    )
    return zero_to_null(wide, [f"{m}_VALUE" for m in metrics]) if zero_as_null else wide


def neighbour_training_set(
    mapping: DataFrame,
    metrics: Sequence[str] = TARGET_METRICS,
    radius: int = 3600,
    ceiling: float = 105.0,
    label_mode: str = "faithful",
    spellings: Mapping[str, str] = TRAINING_SITE_SPELLINGS,
    zero_as_null: bool = True,
) -> DataFrame:
    """M1: events labelled by mapped neighbours, with values spread by metric."""
    rows = only(mapping, "METRIC_NAME", list(metrics)).select(
        "POLLER_TIME", "METRIC_NAME", "MEASURED_VALUE", "RECON_ID", "NEW_BUS_ID", "SITE", "HAS_MAPPED_INCIDENT"
    )
    labelled = valid_values(neighbour_label(rows, radius, label_mode), ceiling)
    wide = canonical_site(spread_values(labelled, metrics, zero_as_null), spellings)
    return wide.select(
        "POLLER_TIME",
        "MEASURED_VALUE",
        "NEW_BUS_ID",
        "SITE",
        "HAS_NEIGHBOR_INCIDENT",
        *[f"{m}_VALUE" for m in metrics],
        hour_of("POLLER_TIME").alias("HOUR"),
        weekday_of("POLLER_TIME").alias("WEEKDAY"),
    )


def site_index(df: DataFrame, column: str = "SITE") -> DataFrame:
    """(site, index) of the different sites in order, from 0; a table of any length."""
    names = settle(df.where(F.col(column).isNotNull()).select(F.col(column).alias("site")).distinct())
    ranked = running_totals(names, {"__n": F.lit(1)}, [F.col("site")])
    return settle(ranked.select("site", (F.col("__n") - 1).cast("int").alias("index")))


def site_one_hot(df: DataFrame, sites: DataFrame, column: str = "SITE") -> DataFrame:
    """A sparse 0/1 vector ``<column>_HOT`` in place of the site, with a slot for each known one.

    A site that is not in the index, or NULL, has no 1. Without any site there is no vector.
    """
    count = sites.count()
    if not count:
        return df.drop(column)
    rows = lookup_join(df, sites.select(F.col("site").alias("__site"), F.col("index").alias("__slot")), {column: "__site"})
    rows = rows.withColumn("__slot", F.coalesce("__slot", F.lit(count)).cast("double")).drop(column)
    # the slot after the last stands for "none" and is dropped from the vector
    encoder = OneHotEncoder(inputCol="__slot", outputCol=f"{column}_HOT", dropLast=True, handleInvalid="keep")
    model = encoder.fit(sites.select(F.col("index").cast("double").alias("__slot")))
    return model.transform(rows).drop("__slot")


def clean_full(df: DataFrame, sites: DataFrame | None = None, drop_empty: bool = True) -> DataFrame:
    """M3: all-metric training rows. Pass the first week's site index to encode another week alike."""
    sites = site_index(df) if sites is None else sites
    rows = all_null(df, SPARSE_FEATURES).drop("POLLER_TIME", "MEASURED_VALUE", "NEW_BUS_ID")
    rows = site_one_hot(rows, sites)
    return drop_null_columns(rows, "all") if drop_empty else rows


def clean_single(frames: Sequence[DataFrame], metric: str = "PctFree") -> DataFrame:
    """M4: training rows of one metric from several weeks."""
    rows = append_frames(*frames).drop(
        "POLLER_TIME", "MEASURED_VALUE", "NEW_BUS_ID", "SITE", "HOUR", "WEEKDAY"
    )
    return drop_null_columns(has_value(rows, f"{metric}_VALUE"), "any")


# -- labels --------------------------------------------------------------------------------


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Noise rows, incident rows and noise per incident."""
    positive = F.col(label).cast("int") == 1
    counts = df.agg(F.count_if(~positive).alias("noise"), F.count_if(positive).alias("incident"))
    return counts.withColumn("ratio", F.try_divide(F.col("noise"), F.col("incident")))


def with_draw(df: DataFrame, keys: Sequence[str], seed: int = 7) -> DataFrame:
    """Add ``__draw``, a number in [0, 1) that follows from the keys alone, the same in every run and layout."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.withColumn("__draw", F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32))


def split(
    df: DataFrame, fraction: float = 0.67, seed: int = 7, keys: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """M5: random train/test split.

    With ``keys``, or a ``__draw`` made of them earlier, the side of a row follows from a hash: rows
    with equal keys go together and every run gives the same sides. Without, each row draws its own
    side, so equal rows spread over both; the draw is written once, and both sides read it back.
    """
    if keys:
        drawn = with_draw(df, keys, seed)
    elif "__draw" in df.columns:
        drawn = df
    else:
        drawn = settle(df.withColumn("__draw", F.rand(seed)))
    train, test = F.col("__draw") < fraction, F.col("__draw") >= fraction
    return drawn.where(train).drop("__draw"), drawn.where(test).drop("__draw")
