"""Utilization forecasts for several devices at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scalar import push_window


REGULARISATIONS = (0.0, 0.01, 0.1, 1.0, 10.0)


@dataclass(frozen=True)
class Forecaster:
    """A linear model per device over all devices' lagged values: intercepts, and a row of weights for each."""

    intercepts: list[float]
    weights: list[list[float]]
    regularisation: float


def complete(windows: DataFrame, horizons: int = 3) -> DataFrame:
    """Windows without a missing reading."""
    whole = ~F.exists(F.flatten("x"), lambda v: v.isNull())
    for h in range(1, horizons + 1):
        whole = whole & ~F.exists(f"y_{h}", lambda v: v.isNull())
    return windows.where(whole)


def _scatter(inputs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number, means and centred cross-products of the rows, merged batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (0, np.zeros(inputs), np.zeros((inputs, inputs)))
        for batch in batches:
            if "products" in batch.schema.names:
                size = inputs * inputs
                flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("means", "products")]
                parts = zip(batch.column("n").to_pylist(), flat[0].reshape(-1, inputs), flat[1].reshape(-1, size), strict=True)
                merged = [(n, m, p.reshape(inputs, inputs)) for n, m, p in parts]
            elif batch.num_rows:
                rows = batch.column("row").flatten().to_numpy(zero_copy_only=False).reshape(-1, inputs)
                means = rows.mean(axis=0)
                merged = [(len(rows), means, (rows - means).T @ (rows - means))]
            else:
                merged = []
            for part in merged:
                total = _merged(total, part)
        columns = [pa.array([total[0]]), pa.array([total[1].tolist()]), pa.array([total[2].reshape(-1).tolist()])]
        yield pa.RecordBatch.from_arrays(columns, ["n", "means", "products"])

    return run


def _merged(one: tuple, two: tuple) -> tuple:
    n = one[0] + two[0]
    if not n:
        return one
    away = two[1] - one[1]
    return n, one[1] + away * (two[0] / n), one[2] + two[2] + np.outer(away, away) * (one[0] * two[0] / n)


def fit_path(
    windows: DataFrame, n_devices: int, lookback: int, regularisations: Sequence[float] = REGULARISATIONS
) -> list[Forecaster]:
    """Regress each device's next value on the lagged values of all devices, for every ridge at once.

    One pass over the windows: each partition returns the means and cross-products of inputs and targets
    about its own means, which do not grow with the rows, and one task merges them. All devices and
    all ridges are then solved from the same small matrix. Ridges weigh inputs of unit variance.
    """
    p = n_devices * lookback
    rows = windows.select(F.concat(F.flatten("x"), "y_1").cast("array<double>").alias("row"))
    kind = "n bigint, means array<double>, products array<double>"
    parts = rows.mapInArrow(_scatter(p + n_devices), kind)
    whole = parts.repartition(1).mapInArrow(_scatter(p + n_devices), kind).first()
    if not whole["n"]:
        raise ValueError("no complete window to learn from")
    means = np.array(whole["means"])
    products = np.array(whole["products"]).reshape(p + n_devices, -1) / whole["n"]
    spread = np.sqrt(np.diag(products)[:p])
    used = spread > 0
    inner = products[:p, :p][np.ix_(used, used)] / np.outer(spread[used], spread[used])
    outer = products[:p, p:][used] / spread[used][:, None]
    out = []
    for ridge in regularisations:
        weights = np.zeros((p, n_devices))
        weights[used] = np.linalg.lstsq(inner + ridge * np.eye(used.sum()), outer, rcond=None)[0] / spread[used][:, None]
        out.append(Forecaster((means[p:] - means[:p] @ weights).tolist(), weights.T.tolist(), ridge))
    return out


def _predicted(model: Forecaster, x: str = "x") -> Column:
    """The next step's values of all devices, as an array."""
    flat = F.flatten(x)

    def one(intercept: float, weights: list[float]) -> Column:
        terms = F.zip_with(flat, F.array(*map(F.lit, weights)), lambda a, b: a * b)
        return F.aggregate(terms, F.lit(intercept), lambda t, v: t + v)

    return F.array(*[one(i, w) for i, w in zip(model.intercepts, model.weights, strict=True)])


def predict_next(model: Forecaster, windows: DataFrame, name: str) -> DataFrame:
    """The next step's values of all devices, as an array column."""
    return windows.withColumn(name, _predicted(model))


def forecast_recursive(model: Forecaster, windows: DataFrame, steps: int = 3) -> DataFrame:
    """Predict a step, push it into the window in place of the oldest, and go on."""
    rows = windows.withColumn("__x", F.col("x"))
    for h in range(1, steps + 1):
        rows = predict_next(model, rows.withColumns({"__keep": F.col("x"), "x": F.col("__x")}), f"pred_{h}")
        rows = rows.withColumns({"__x": push_window("__x", f"pred_{h}"), "x": F.col("__keep")}).drop("__keep")
    return rows.drop("__x")


def compare_table(forecasts: DataFrame, device: int, steps: int = 3, group: Sequence[str] = ()) -> DataFrame:
    """Predicted and actual value of one device per window and horizon."""
    cells = [
        F.struct(
            F.lit(h).alias("horizon"),
            F.col(f"pred_{h}")[device].alias("predicted"),
            F.col(f"y_{h}")[device].alias("actual"),
        )
        for h in range(1, steps + 1)
    ]
    return forecasts.select(*group, "window", F.inline(F.array(*cells)))


def tolerance_accuracy(table: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """Share of forecasts within the tolerance, per horizon."""
    close = (F.abs(F.col("predicted") - F.col("actual")) <= tolerance).cast("double")
    return table.groupBy("horizon").agg(F.avg(close).alias("accuracy"))


def mse(table: DataFrame) -> DataFrame:
    """Mean squared error per horizon."""
    return table.groupBy("horizon").agg(F.avg(F.pow(F.col("predicted") - F.col("actual"), 2)).alias("mse"))


def validation_errors(models: Sequence[Forecaster], windows: DataFrame) -> list[float | None]:
    """Mean squared error of the next step over all devices, of every model in one pass."""

    def squares(model: Forecaster) -> Column:
        away = F.zip_with(_predicted(model), "y_1", lambda a, b: (a - b) * (a - b))
        return F.aggregate(away, F.lit(0.0), lambda t, v: t + v) / F.size("y_1")

    return list(windows.agg(*[F.avg(squares(m)).alias(f"e{i}") for i, m in enumerate(models)]).first())


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the least validation error."""
    return metrics.agg(F.min_by("model_id", "mse").alias("model_id"), F.min("mse").alias("mse"))


def select_forecaster(
    train: DataFrame,
    test: DataFrame,
    n_devices: int,
    lookback: int = 10,
    regularisations: Sequence[float] = REGULARISATIONS,
) -> tuple[Forecaster, DataFrame]:
    """Fit a path of ridges, keep the one with the least error on the held-out windows.

    Without a held-out window the first one is kept.
    """
    candidates = fit_path(train, n_devices, lookback, regularisations)
    errors = list(enumerate(validation_errors(candidates, test)))
    metrics = train.sparkSession.createDataFrame(errors, "model_id int, mse double")
    best = best_model(metrics).first()["model_id"]
    return candidates[best or 0], metrics
