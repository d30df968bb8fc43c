"""Metric profiles, seasonal profiles and thresholds with exact percentiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.config import PROFILE_SITE_SPELLINGS, PROFILED_METRICS
from opstelemetry.functions.scale import running_totals
from opstelemetry.functions.scalar import hour_of, missing_as_null, weekday_of
from opstelemetry.operators.filters import canonical_site, only, valid_values

PERCENTILES = (10, 20, 30, 40, 50, 60, 70, 80, 90, 99)
LEVELS = {"site": "SITE", "client": "NEW_BUS_ID", "device": "RECON_ID"}


def distribution(df: DataFrame, keys: Sequence[str], value: str, percentiles: Mapping[str, float]) -> DataFrame:
    """Mean, count, sample standard deviation, min, max and exact percentiles per key.

    ``percentiles`` maps output names to fractions; values between two ranks are interpolated
    linearly. Rows with a NULL key take no part, nor do NULL values; a key without any value
    keeps its row, with a count of 0.

    The input is read once, to count rows per (key, value), which combines repeats before the
    shuffle. The counts are range-sorted by key and value, so a hot key spreads over partitions, and
    their running totals are ranks. Each (key, partition) then gives one row with its moments about
    its own mean and the values at the wanted ranks; a key merges as many as it has partitions.

    NaN is the greatest value, as in Spark's order: it can be a maximum or a percentile, and makes
    mean and deviation NaN. Infinities make the deviation NaN, and the mean infinite or, with both
    signs, NaN. A percentile between a finite and an infinite rank is infinite.
    """
    keys = list(keys)
    present = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) if keys else df
    counts = present.groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__rows"))
    counts = counts.selectExpr(*[f"`{k}`" for k in keys], "__v", "if(__v IS NULL, 0L, __rows) AS __n")
    ranked = running_totals(counts, {"__upto": F.col("__n")}, [F.col("__v").asc_nulls_first()], keys, part="__part")
    local = f"PARTITION BY __part{''.join(f', `{k}`' for k in keys)}"
    rows = ranked.selectExpr("*", f"__v - min(__v) OVER ({local}) AS __d")
    rows = rows.selectExpr("*", f"try_divide(sum(__d * __n) OVER ({local}), sum(__n) OVER ({local})) AS __m")

    def on_rank(rank: str) -> str:
        """The value at a rank, on the one row that holds it."""
        return f"max(if({rank} >= __upto - __n AND {rank} < __upto, __v, NULL))"

    fractions = [f"{float(p)!r}D" for p in percentiles.values()]
    sides = [(f"__{side}{i}", f"{side}({p} * (__upto_all - 1))") for i, p in enumerate(fractions) for side in ("floor", "ceil")]
    # moments about the partition's own mean, and that mean as a distance from its least value: large values lose no digits
    parts = rows.groupBy("__part", *keys).agg(
        F.expr("sum(__n) AS n"), F.expr("sum(__v * __n) AS s"), F.expr("max(__m) AS m"),
        F.expr("sum((__d - __m) * (__d - __m) * __n) AS q"), F.expr("min(__v) AS low"), F.expr("max(__v) AS high"),
        *[F.expr(f"{on_rank(rank)} AS {name}") for name, rank in sides],
    )
    # as many structs as a key has partitions
    whole = parts.groupBy(*keys).agg(
        F.expr("sum(n) AS count"), F.expr("try_divide(sum(s), sum(n)) AS mean"), F.expr("min(low) AS min"), F.expr("max(high) AS max"),
        F.expr("collect_list(if(n > 0, struct(n, q, low, m), NULL)) AS __parts"), *[F.expr(f"max({name}) AS {name}") for name, _ in sides],
    )
    whole = whole.selectExpr("*", "try_divide(aggregate(__parts, 0D, (t, x) -> t + x.n * (x.low - min + x.m)), count) AS __away")
    squares = "aggregate(__parts, 0D, (t, x) -> t + x.q + x.n * pow(x.low - min + x.m - __away, 2))"

    def interpolated(i: int, p: str) -> str:
        low, high, share = f"__floor{i}", f"__ceil{i}", f"({p} * (count - 1) - floor({p} * (count - 1)))"
        finite = f"abs({high} - {low}) < double('infinity')"
        return (
            f"CASE WHEN {share} = 0 OR {low} = {high} THEN {low} WHEN {finite} THEN {low} + ({high} - {low}) * {share} "
            f"ELSE {low} * (1 - {share}) + {high} * {share} END"
        )

    return whole.selectExpr(
        *[f"`{k}`" for k in keys], "mean", "count", f"if(count > 1, sqrt({squares} / (count - 1)), NULL) AS std", "min", "max",
        *[f"{interpolated(i, fractions[i])} AS `{name}`" for i, name in enumerate(percentiles)],
    )


def _percentile_columns(percentiles: Sequence[int]) -> dict[str, float]:
    return {f"percentile_{p}": p / 100 for p in percentiles}


def metric_profile(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "MEASURED_VALUE",
    percentiles: Sequence[int] = PERCENTILES,
) -> DataFrame:
    """A3: mean, count, standard deviation and percentiles of the value per key."""
    return distribution(df, keys, value, _percentile_columns(percentiles)).drop("min", "max")


def at_levels(df: DataFrame, levels: Mapping[str, str] = LEVELS, value: str = "MEASURED_VALUE") -> DataFrame:
    """Each reading once per grouping level: METRIC_NAME, level, group_key and the value."""
    entries = [F.struct(F.lit(n).alias("level"), F.col(c).alias("group_key")) for n, c in levels.items()]
    return df.select("METRIC_NAME", value, F.inline(F.array(*entries)))


def metric_profile_levels(
    df: DataFrame,
    levels: Mapping[str, str] = LEVELS,
    value: str = "MEASURED_VALUE",
    percentiles: Sequence[int] = PERCENTILES,
) -> DataFrame:
    """A4: profiles by site, by client and by device in one pass."""
    return metric_profile(
        at_levels(df, levels, value), ["METRIC_NAME", "level", "group_key"], value, percentiles
    )


def metric_profiles(
    df: DataFrame,
    metrics: Sequence[str] = PROFILED_METRICS,
    ceiling: float = 105.0,
    spellings: Mapping[str, str] = PROFILE_SITE_SPELLINGS,
) -> DataFrame:
    """A5: profiles of all metrics at all levels from one scan of the events."""
    rows = only(df, "METRIC_NAME", list(metrics)).select(
        "METRIC_NAME", "RECON_ID", "NEW_BUS_ID", "SITE", "MEASURED_VALUE"
    )
    return metric_profile_levels(valid_values(canonical_site(rows, spellings), ceiling))


def seasonal_profile(df: DataFrame) -> DataFrame:
    """Value statistics per target, metric, UTC hour and weekday. ``q2`` is the 75th percentile."""
    timed = df.select(
        "target_id",
        "metric_name",
        hour_of("poller_time").alias("hour"),
        weekday_of("poller_time").alias("dayofweek"),
        missing_as_null("measured_value").alias("measured_value"),
    )
    keys = ["target_id", "metric_name", "hour", "dayofweek"]
    stats = distribution(timed, keys, "measured_value", {"median": 0.5, "q1": 0.25, "q2": 0.75})
    return stats.select(*keys, "mean", "min", "max", "median", "q1", "q2")


def iqr_threshold(
    profile: DataFrame, k: float = 1.5, floor: Mapping[str, float] | None = None
) -> DataFrame:
    """Q3 + k·IQR over the hourly maxima of each (target, metric).

    A target has at most 168 hours of the week, so its maxima are a small group. An hour
    without a maximum leaves the threshold unknown. ``floor`` gives a least threshold per
    metric; without it none applies.
    """
    quartiles = F.percentile("max", F.array(F.lit(0.25), F.lit(0.75)))
    result = profile.groupBy("target_id", "metric_name").agg(
        F.when(F.count("max") == F.count(F.lit(1)), quartiles).alias("q")
    )
    q1, q3 = F.col("q")[0], F.col("q")[1]
    threshold = q3 + F.lit(k) * (q3 - q1)
    for metric, least in (floor or {}).items():
        threshold = F.when(
            F.col("metric_name") == metric, F.greatest(F.lit(float(least)), threshold)
        ).otherwise(threshold)
    return result.select("target_id", "metric_name", threshold.alias("threshold"))
