"""Device series: pivot, numbering, lag pairs, windows and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opstelemetry.functions.scale import in_order, running_totals

BLOCK_STEPS = 4096


def pivot_series(
    df: DataFrame,
    devices: Sequence[str],
    time: Column | str = "poller_time",
    device: str = "target_id",
    value: str = "measured_value",
    group: Sequence[str] = (),
) -> DataFrame:
    """One row per time with an array ``values`` of the devices' readings, in their order.

    Readings are placed by device, so a missing one is NULL and shifts nothing. Several
    readings of a device at one time are averaged.
    """
    at = F.col(time) if isinstance(time, str) else time
    cells = [F.avg(F.when(F.col(device) == d, F.col(value))) for d in devices]
    rows = df.where(F.col(device).isin(*devices) & at.isNotNull())
    return rows.groupBy(*group, at.alias("time")).agg(F.array(*cells).alias("values"))


def number_steps(series: DataFrame, group: Sequence[str] = (), time: str = "time") -> DataFrame:
    """Number the steps of each series from 0 (``step``) and add its length (``n_steps``).

    Times of one series must differ. A NULL group is a series like others.
    """
    counted = running_totals(series, {"__step": F.lit(1)}, [F.col(time)], group)
    return counted.withColumns(
        {"step": F.col("__step") - 1, "n_steps": F.col("__step_all")}
    ).drop("__step", "__step_all")


def carry_forward(series: DataFrame, n_devices: int, group: Sequence[str] = (), time: str = "time") -> DataFrame:
    """Fill each device's gaps with its last reading before; gaps before the first one stay.

    The series is range-sorted, so a long one spreads over partitions. The last readings of a partition are
    one row for each series in it; only a series that goes on in the next partition passes them on.
    """
    group, order = list(group), [*[F.col(g).asc_nulls_first() for g in group], F.col(time)]
    rows = in_order(series, order)
    reading = [F.col("values")[i] for i in range(n_devices)]
    last = [F.max_by(v, F.when(v.isNotNull(), F.col("__at"))).alias(f"__l{i}") for i, v in enumerate(reading)]
    ends = rows.groupBy("__part", *group).agg(*last)
    parts = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    parts = parts.orderBy("__part")
    before = parts.rowsBetween(W.unboundedPreceding, -1)
    passed = ends.select(
        F.col("__part").alias("__p"), *[F.col(g).alias(f"__g_{g}") for g in group], F.row_number().over(parts).alias("__nth"),
        *[F.last(f"__l{i}", ignorenulls=True).over(before).alias(f"__b{i}") for i in range(n_devices)],
    ).where("__nth > 1")
    upto = W.partitionBy("__part", *group).orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns({f"__v{i}": F.last(v, ignorenulls=True).over(upto) for i, v in enumerate(reading)})
    same = F.col("__part") == F.col("__p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    # a row a partition at most
    joined = local.join(F.broadcast(passed), same, "left")
    filled = F.array(*[F.coalesce(f"__v{i}", f"__b{i}") for i in range(n_devices)])
    return joined.withColumn("values", filled).select(*series.columns)


def _with_halo(steps: DataFrame, before: int, after: int, block: int) -> DataFrame:
    """Each step in its own block, and again in the blocks whose edge it is near."""
    if max(before, after) >= block:
        raise ValueError("a block must be longer than the window")
    own = F.floor(F.col("step") / block)
    offset = F.col("step") - own * block
    homes = F.array_compact(
        F.array(
            own,
            F.when(offset >= block - before, own + 1),
            F.when(offset < after, own - 1),
        )
    )
    return steps.withColumns({"__own": own, "__block": F.explode(homes)})


def _in_blocks(
    steps: DataFrame,
    group: Sequence[str],
    columns: dict[str, Column],
    before: int,
    after: int,
    block: int,
) -> DataFrame:
    rows = _with_halo(steps, before, after, block).withColumns(columns)
    return rows.where(F.col("__block") == F.col("__own")).drop("__own", "__block")


def lag_pairs(steps: DataFrame, group: Sequence[str] = (), block: int = BLOCK_STEPS) -> DataFrame:
    """``x`` is a step's values and ``y`` the next step's; the last two steps give no pair."""
    order = W.partitionBy(*group, "__block").orderBy("step")
    pairs = _in_blocks(steps, group, {"y": F.lead("values", 1).over(order)}, 0, 1, block)
    return pairs.where(F.col("step") < F.col("n_steps") - 2).select(
        *group, "time", "step", "n_steps", F.col("values").alias("x"), "y"
    )


def concat_pairs(pairs: DataFrame) -> DataFrame:
    """The two halves of a pair as one array."""
    return pairs.withColumn("xy", F.concat("x", "y"))


def forecast_windows(
    steps: DataFrame,
    group: Sequence[str] = (),
    lookback: int = 10,
    horizons: int = 3,
    block: int = BLOCK_STEPS,
) -> DataFrame:
    """``lookback`` past steps ``x`` and the values ``y_1`` … at each following step.

    n steps give n - lookback - horizons + 1 windows. Series are cut into blocks that carry the
    neighbouring steps of their edges, so every window is whole and no task holds a series.
    """
    order = W.partitionBy(*group, "__block").orderBy("step")
    past = order.rowsBetween(-(lookback - 1), 0)
    columns = {"x": F.collect_list("values").over(past)}
    columns |= {f"y_{h}": F.lead("values", h).over(order) for h in range(1, horizons + 1)}
    rows = _in_blocks(steps, group, columns, lookback - 1, horizons, block)
    whole = (F.col("step") >= lookback - 1) & (F.col("step") + horizons < F.col("n_steps"))
    return rows.where(whole).select(
        *group,
        "time",
        (F.col("step") - (lookback - 1)).alias("window"),
        "n_steps",
        "x",
        *[f"y_{h}" for h in range(1, horizons + 1)],
    )


def chrono_split(steps: DataFrame, fraction: float = 0.99) -> tuple[DataFrame, DataFrame]:
    """The first ``fraction`` of each series' steps, and the rest."""
    border = F.floor(F.col("n_steps") * F.lit(fraction))
    return steps.where(F.col("step") < border), steps.where(F.col("step") >= border)
