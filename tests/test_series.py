import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.operators import series as S


def make(spark, n, groups=("g",)):
    data = [(g, 10 * i, [float(i), float(-i)]) for g in groups for i in range(n)]
    return S.number_steps(spark.createDataFrame(data, "g string, time long, values array<double>"), ["g"])


def test_pivot_stays_aligned(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 2.0), (2, "b", 3.0), (3, "a", 4.0), (3, "b", 5.0), (3, "a", 6.0), (3, "z", 9.0)],
        "poller_time long, target_id string, measured_value double",
    )
    got = rows(S.pivot_series(df, ["a", "b"]), "time", "values")
    assert got == [(1, [1.0, 2.0]), (2, [None, 3.0]), (3, [5.0, 5.0])]


@pytest.mark.parametrize("n,windows", [(12, 0), (13, 1), (30, 18)])
def test_window_counts(spark, n, windows):
    assert S.forecast_windows(make(spark, n), ["g"]).count() == windows


@pytest.mark.parametrize("block", [13, 17, 4096])
def test_windows_across_blocks(spark, many_parts, block):
    steps = make(spark, 60, ("g", "h", None))
    got = S.forecast_windows(steps, ["g"], block=block).where("g = 'h'").orderBy("window").collect()
    assert [r.window for r in got] == list(range(48))
    for r in got:
        assert [x[0] for x in r.x] == [float(r.window + j) for j in range(10)]
        assert [r.y_1[1], r.y_2[1], r.y_3[1]] == [-(r.window + 10.0), -(r.window + 11.0), -(r.window + 12.0)]


@pytest.mark.parametrize("block", [2, 4096])
def test_lag_pairs(spark, block):
    pairs = S.concat_pairs(S.lag_pairs(make(spark, 20), ["g"], block=block))
    got = rows(pairs, "step", "xy")
    assert got == sorted([(i, [float(i), -float(i), float(i + 1), -float(i + 1)]) for i in range(18)], key=repr)


def test_pairs_then_windows(spark):
    pairs = S.lag_pairs(make(spark, 30), ["g"]).select("g", "time", F.col("x").alias("values"))
    assert S.forecast_windows(S.number_steps(pairs, ["g"]), ["g"]).count() == 30 - 14


def test_steps_without_group_and_split(spark):
    data = spark.range(250).select((F.col("id") * 1000).alias("time"), F.array(F.lit(1.0)).alias("values"))
    steps = S.number_steps(data)
    assert rows(steps, "time", "step", "n_steps") == sorted([(i * 1000, i, 250) for i in range(250)], key=repr)
    train, test = S.chrono_split(steps, 0.99)
    assert train.count() == 247 and rows(test, "step") == [(247,), (248,), (249,)]


def test_no_window_sorts_a_whole_series(spark):
    steps = make(spark, 60)
    text = S.forecast_windows(steps, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(g#" in text
    specs = [w.split("specifiedwindowframe")[0] for w in text.split("windowspecdefinition(")[1:]]
    # a window that puts rows in order does so inside a block, a partition, or over a row a partition
    assert all("__block" in w or "__part" in w for w in specs if "ASC" in w)


def test_carry_forward(spark, many_parts):
    rng = random.Random(3)
    data = [(g, t, [rng.choice([None, None, float(t)]), None if t < 3900 else 1.0]) for g in ("a", None) for t in range(4000)]
    df = spark.createDataFrame(data, "g string, time long, values array<double>").repartition(5)
    want = []
    for g in ("a", None):
        last = [None, None]
        for _, t, v in (d for d in data if d[0] == g):
            last = [x if x is not None else y for x, y in zip(v, last)]
            want.append((g, t, last))
    assert rows(S.carry_forward(df, 2, ["g"]), "g", "time", "values") == sorted(want, key=repr)
    assert S.carry_forward(df.limit(0), 2, ["g"]).collect() == []
