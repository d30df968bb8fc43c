import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.operators import forecast as T
from opstelemetry.operators import series as S
from opstelemetry.plans.analysis import forecast_devices


@pytest.fixture(scope="module")
def readings(spark):
    data = [
        (60 * i, d, 50 + 20 * math.sin(i / 5 + k) + 0.1 * k * i, "utilization")
        for i in range(200) for k, d in enumerate("abcd")
    ]
    return spark.createDataFrame(data, "poller_time long, target_id string, measured_value double, metric_name string")


def test_forecast_devices(readings):
    noise = readings.withColumn("metric_name", F.lit("used"))
    result = forecast_devices(readings.unionByName(noise), list("abcd"), train_fraction=0.8)
    table = T.compare_table(result.forecasts, 3)
    assert table.count() == 3 * (40 - 12)
    accuracy = T.tolerance_accuracy(table).collect()
    assert len(accuracy) == 3 and all(r.accuracy == 1.0 for r in accuracy)
    assert all(r.mse < 1 for r in T.mse(table).collect())
    best = T.best_model(result.metrics).first()
    assert best.mse == min(r.mse for r in result.metrics.collect())


def test_recursion_feeds_predictions_back(spark):
    # the newest value of each device plus one, and plus two
    model = T.Forecaster([1.0, 2.0], [[0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 1.0]], 0.0)
    windows = spark.createDataFrame([(0, [[1.0, 2.0], [3.0, 4.0]])], "window int, x array<array<double>>")
    got = T.forecast_recursive(model, windows).first()
    assert (got.pred_1, got.pred_2, got.pred_3) == ([4.0, 6.0], [5.0, 8.0], [6.0, 10.0])
    assert got.x == [[1.0, 2.0], [3.0, 4.0]]


def test_path_against_numpy(spark, many_parts):
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((500, 3, 2)) * [1.0, 1e-3] + [0.0, 2e6]
    y = x.reshape(500, 6) @ rnd.standard_normal((6, 2)) + rnd.standard_normal((500, 2)) * 0.01
    data = [(a.tolist(), b.tolist()) for a, b in zip(x, y)]
    windows = spark.createDataFrame(data, "x array<array<double>>, y_1 array<double>").repartition(7)
    flat = x.reshape(500, 6)
    centred, targets = flat - flat.mean(axis=0), y - y.mean(axis=0)
    scale = centred.std(axis=0)
    for model in T.fit_path(windows, 2, 3):
        z = centred / scale
        want = np.linalg.solve(z.T @ z / 500 + model.regularisation * np.eye(6), z.T @ targets / 500) / scale[:, None]
        assert np.allclose(model.weights, want.T, rtol=1e-5)
        predicted = np.array([r[0] for r in T.predict_next(model, windows, "p").select("p").collect()])
        assert predicted.shape == (500, 2)
    best = T.fit_path(windows, 2, 3)
    errors = T.validation_errors(best, windows)
    assert errors == sorted(errors) and errors[0] < 1e-3
    with pytest.raises(ValueError):
        T.fit_path(windows.limit(0), 2, 3)


def test_constant_and_repeated_inputs(spark):
    data = [([[5.0, float(i), float(i)]], [5.0, i + 1.0, i + 1.0]) for i in range(50)]
    (model,) = T.fit_path(spark.createDataFrame(data, "x array<array<double>>, y_1 array<double>"), 3, 1, [0.0])
    got = T.predict_next(model, spark.createDataFrame([([[5.0, 60.0, 60.0]],)], "x array<array<double>>"), "p").first()["p"]
    assert got == pytest.approx([5.0, 61.0, 61.0])


def test_tolerance_and_selection(spark):
    table = spark.createDataFrame(
        [(1, 10.0, 15.0), (1, 10.0, 15.1), (2, 1.0, 1.0)], "horizon int, predicted double, actual double"
    )
    assert rows(T.tolerance_accuracy(table), "horizon", "accuracy") == [(1, 0.5), (2, 1.0)]
    metrics = spark.createDataFrame([(0, 3.0), (1, 1.5), (2, 2.0)], "model_id int, mse double")
    assert tuple(T.best_model(metrics).first()) == (1, 1.5)


def test_incomplete_windows_are_left_out(spark):
    data = [(i, [1.0, None if i == 3 else 2.0]) for i in range(16)]
    wide = spark.createDataFrame(data, "time long, values array<double>")
    steps = S.number_steps(wide)
    filled = S.number_steps(S.carry_forward(wide, 2))
    assert T.complete(S.forecast_windows(filled)).count() == 4
    assert rows(T.complete(S.forecast_windows(steps)), "window") == []
    assert S.forecast_windows(steps).count() == 4
