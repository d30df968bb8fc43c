import random
from datetime import datetime, timezone

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.operators import distribution as D

PS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def numpy_stats(values):
    std = np.std(values, ddof=1) if len(values) > 1 else None
    return [np.mean(values), len(values), std, min(values), max(values), *[np.percentile(values, p * 100) for p in PS.values()]]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_numpy(spark, many_parts, seed):
    rng = random.Random(seed)
    makers = {
        "one": lambda: 3.5,
        "small": lambda: round(rng.uniform(0, 100), 1),
        "signed": lambda: rng.gauss(0, 1e4),
        "far": lambda: 2e9 + rng.random(),
        "ties": lambda: float(rng.randrange(3)),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-5, 12),
    }
    data = [(k, make()) for k, make in makers.items() for _ in range(400 if k != "one" else 1)]
    rng.shuffle(data)
    df = spark.createDataFrame([*data, (None, 1.0), ("small", None)], "k string, v double").repartition(4)
    got = {r["k"]: list(r)[1:] for r in D.distribution(df, ["k"], "v", PS).collect()}
    assert set(got) == set(makers)
    for k in makers:
        want = numpy_stats([v for key, v in data if key == k])
        for i, (g, w) in enumerate(zip(got[k], want)):
            # A double near 2e9 has steps of 2e-7, which is what a deviation of 0.3 can lose.
            rel = 1e-7 if (k, i) == ("far", 2) else 1e-9
            assert (g is None) == (w is None) and (w is None or g == pytest.approx(w, rel=rel, abs=1e-9)), k


ODD = [1.0, 2.0, 3.0, float("nan"), float("nan")]
FAR = [float("-inf"), -1.0, 1.0, float("inf")]


def test_odd_values_give_the_same_in_small_and_large_groups(spark, many_parts):
    """600,000 rows, over many partitions, with the same values in the same shares."""
    times = 120_000
    small = [("odd", v) for v in ODD] + [("far", v) for v in FAR] + [("up", v) for v in (5.0, float("inf"))]
    large = spark.createDataFrame([(f"large {k}", v) for k, v in small], "k string, v double").join(spark.range(times))
    df = spark.createDataFrame(small, "k string, v double").unionByName(large.select("k", "v"))
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    got = {r["k"]: r for r in D.distribution(df, ["k"], "v", ps).collect()}
    assert [got["odd"][c] for c in ("count", "max", "p0", "p25", "p50")] == [5, pytest.approx(float("nan"), nan_ok=True), 1.0, 2.0, 3.0]
    assert [got["far"][c] for c in ("min", "max", "p0", "p50", "p100")] == [float("-inf"), float("inf"), float("-inf"), 0.0, float("inf")]
    assert got["up"]["mean"] == got["up"]["p75"] == float("inf")
    for k in ("odd", "far", "up"):
        one, many = got[k], got[f"large {k}"]
        assert many["count"] == times * one["count"]
        for c in ("mean", "std", "min", "max", "p0", "p100"):
            assert repr(one[c]) == repr(many[c]), (k, c)
    # ranks lie inside runs of equal values there, so only these can be told beforehand
    assert [got["large odd"][c] for c in ("p25", "p50")] == [2.0, 3.0] and got["large up"]["p25"] == 5.0


def test_hot_group_and_input_read_once(spark, many_parts):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.rand(1).alias("v"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    got = D.distribution(df.mapInArrow(counted, df.schema), ["k"], "v", {"p50": 0.5})
    hot = got.where("k = 'hot'").first()
    values = [r["v"] for r in df.where("k = 'hot'").select("v").collect()]
    assert hot["count"] == 200_000 and hot["p50"] == pytest.approx(np.percentile(values, 50), rel=1e-12)
    assert hot["std"] == pytest.approx(np.std(values, ddof=1), rel=1e-9)
    assert reads.value == 300_000


def test_group_of_one_and_null_key(spark):
    df = spark.createDataFrame([("a", 4.0), (None, 5.0)], "k string, MEASURED_VALUE double")
    got = D.metric_profile(df, ["k"]).collect()
    assert len(got) == 1 and got[0]["std"] is None and got[0]["percentile_99"] == 4.0
    assert D.metric_profile(df.limit(0), ["k"]).collect() == []


def test_group_without_values(spark):
    df = spark.createDataFrame([("a", 4.0), ("b", None)], "k string, MEASURED_VALUE double")
    got = rows(D.metric_profile(df, ["k"]), "k", "count", "mean", "percentile_50")
    assert got == [("a", 1, 4.0, 4.0), ("b", 0, None, None)]
    series = spark.createDataFrame(
        [(0, "t", "m", 1.0), (3600, "t", "m", None), (0, "u", "m", 2.0)],
        "poller_time long, target_id string, metric_name string, measured_value double",
    )
    assert rows(D.iqr_threshold(D.seasonal_profile(series)), "target_id", "threshold") == [("t", None), ("u", 2.0)]


def test_profiles_of_all_levels(spark):
    df = spark.createDataFrame(
        [("used", "d1", "c1", "MMSB400MinutemanRd", "10"), ("used", "d2", "c1", "MM400MinutemanRd", "20"),
         ("used", "d2", "c1", None, "105.5"), ("other", "d2", "c1", "S", "1"), ("used", "d2", "c1", None, "junk")],
        "METRIC_NAME string, RECON_ID string, NEW_BUS_ID string, SITE string, MEASURED_VALUE string",
    )
    got = rows(D.metric_profiles(df), "level", "group_key", "count", "mean")
    assert got == [("client", "c1", 2, 15.0), ("device", "d1", 1, 10.0), ("device", "d2", 1, 20.0),
                   ("site", "MM400MinutemanRd", 2, 15.0)]


def test_percentiles_rise(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.rand(3).alias("MEASURED_VALUE"))
    row = D.metric_profile(df, ["k"]).first()
    ps = [row[f"percentile_{p}"] for p in D.PERCENTILES]
    assert ps == sorted(ps)


def test_seasonal_profile_and_thresholds(spark):
    monday = int(datetime(2024, 1, 1, 5, tzinfo=timezone.utc).timestamp())
    week, hour = 7 * 86400, 3600
    data = [(monday + w * week, "t", "utilization", float(v)) for w, v in enumerate([1, 2, 4, 9])]
    data += [(monday + hour, "t", "utilization", 3.0), (monday + 2 * hour, "t", "utilization", 5.0)]
    data += [(monday, None, "utilization", 7.0), (monday, "t", "None", 0.0)]
    df = spark.createDataFrame(data, "poller_time long, target_id string, metric_name string, measured_value double")
    profile = D.seasonal_profile(df)
    assert profile.columns == ["target_id", "metric_name", "hour", "dayofweek", "mean", "min", "max", "median", "q1", "q2"]
    first = profile.where("hour = 5 and metric_name = 'utilization'").collect()
    assert [tuple(r)[2:] for r in first] == [(5, 0, 4.0, 1.0, 9.0, 3.0, 1.75, 5.25)]
    maxima = [9.0, 3.0, 5.0]
    q1, q3 = np.percentile(maxima, [25, 75])
    want = q3 + 1.5 * (q3 - q1)
    # a single hourly maximum has no spread; the floor only lifts its own metric
    assert rows(D.iqr_threshold(profile), "metric_name", "threshold") == [("None", 0.0), ("utilization", want)]
    floored = rows(D.iqr_threshold(profile, floor={"utilization": 95}), "metric_name", "threshold")
    assert floored == [("None", 0.0), ("utilization", 95.0)]
