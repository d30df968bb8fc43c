import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.operators import correlate as R

ALARM = "id int, RECON_ID string, EVENT_CODE string, CORE_TIME_NUM long, BUS_ID string"
INCIDENT = (
    "INCIDENT_ID string, SUBMIT_DATE string, BUS_ID string, EVENT_CODE_INC string, RECON_ID_INC string, "
    "Is_Source_Monitor int, SUBMIT_DATE_NUM long"
)


def incident(i, recon, code, at):
    return (i, None, "b", code, recon, 1, at)


@pytest.mark.parametrize("binned", [True, False])
def test_interval_bounds(spark, binned):
    at = 1_000_000
    alarms = spark.createDataFrame(
        [(1, "r", "c", at, "b"), (2, "r", "c", at - 14400, "b"), (3, "r", "c", at + 1, "b"),
         (4, "r", "c", at - 14401, "b"), (5, "r", "x", at, "b"), (6, None, "c", at, "b"), (7, "r", "c", None, "b")],
        ALARM,
    )
    incidents = spark.createDataFrame([incident("i", "r", "c", at)], INCIDENT)
    got = R.interval_match(alarms, incidents, binned=binned)
    assert "BUS_ID" not in got.columns
    assert rows(got, "id", "INC_EVENT_TIME_DIFF") == [
        (1, 0), (2, 14400), (3, None), (4, None), (5, None), (6, None), (7, None),
    ]


def brute_mapping(alarms, incidents, seconds):
    out = []
    for a in alarms:
        hits = [
            (i[0], i[6] - a[3])
            for i in incidents
            if a[1] == i[4] and a[2] == i[3] and a[1] is not None and 0 <= i[6] - a[3] <= seconds
        ]
        out += [(a[0], a[1], i, d) for i, d in hits] or [(a[0], a[1], None, None)]
    least = {}
    for _, r, i, d in out:
        if i is not None:
            least[i, r] = min(d, least.get((i, r), d))
    return sorted(
        [(a, i, d, d if i and least[i, r] == d else None, 1 if i and least[i, r] == d else None) for a, r, i, d in out],
        key=repr,
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mapping_against_brute_force(spark, seed):
    rng = random.Random(seed)
    alarms = [
        (i, rng.choice(["hot", "hot", "r1", "r2"]), rng.choice("ab"), rng.randrange(0, 3000), "b") for i in range(300)
    ]
    incidents = [
        incident(f"i{rng.randrange(30)}", rng.choice(["hot", "r1"]), rng.choice("ab"), rng.randrange(0, 3200))
        for _ in range(40)
    ]
    a = spark.createDataFrame(alarms, ALARM)
    i = spark.createDataFrame(incidents, INCIDENT)
    want = brute_mapping(alarms, incidents, 200)
    columns = ["id", "INCIDENT_ID", "INC_EVENT_TIME_DIFF", "MIN_DIFF", "HAS_MAPPED_INCIDENT"]
    assert rows(R.correlate(a, i, 200), *columns) == want
    assert rows(R.flag_nearest(R.interval_match(a, i, 200)), *columns) == want


def test_ties_are_all_flagged(spark):
    alarms = spark.createDataFrame([(1, "r", "c", 50, "b"), (2, "r", "c", 50, "b"), (3, "r", "c", 40, "b")], ALARM)
    incidents = spark.createDataFrame([incident("i", "r", "c", 60)], INCIDENT)
    got = rows(R.correlate(alarms, incidents), "id", "HAS_MAPPED_INCIDENT", "MIN_DIFF")
    assert got == [(1, 1, 10), (2, 1, 10), (3, None, None)]


MAPPING = "id int, RECON_ID string, METRIC_NAME string, POLLER_TIME long, HAS_MAPPED_INCIDENT int"


def test_neighbour_labels(spark):
    t = 1_000_000
    data = [
        (1, "r", "m", t, 1), (2, "r", "m", t + 3599, None), (3, "r", "m", t + 3600, None),
        (4, "r", "m", t - 3599, None), (5, "r", "m", t - 3600, None), (6, "q", "m", t, None),
        (7, "r", "m", None, None), (8, "z", "m", 10, 1), (9, "z", "m", 10_000, 1), (10, "z", "m", 3000, None),
    ]
    df = spark.createDataFrame(data, MAPPING)
    for size in (1 << 20, 0):
        got = rows(R.neighbour_label(df, broadcast_bytes=size), "id", "HAS_NEIGHBOR_INCIDENT")
        assert got == sorted(
            [(1, True), (2, True), (3, False), (4, True), (5, False), (6, False), (7, False),
             (8, True), (8, False), (9, True), (9, False), (10, True), (10, False)], key=repr,
        )
    either = rows(R.neighbour_label(df, label_mode="any"), "id", "HAS_NEIGHBOR_INCIDENT")
    assert len(either) == 10 and dict(either)[10] is True and dict(either)[3] is False


@pytest.mark.parametrize("seed", [1, 2])
def test_neighbours_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [
        (i, rng.choice(["hot", "hot", "r"]), "m", rng.randrange(0, 2000), 1 if rng.random() < 0.02 else None)
        for i in range(500)
    ]
    seen = {(r, m, t) for _, r, m, t, h in data if h}
    want = set()
    for i, r, m, t, _ in data:
        near = {abs(t - at) < 60 for r2, m2, at in seen if (r2, m2) == (r, m)} or {False}
        want |= {(i, x) for x in near}
    df = spark.createDataFrame(data, MAPPING)
    got = rows(R.neighbour_label(df, radius=60), "id", "HAS_NEIGHBOR_INCIDENT")
    assert got == sorted(want, key=repr)


def test_hot_key_is_split(spark):
    """A third of all alarms under one key in one slot: adaptive execution splits the join."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 60_000, numPartitions=8)
        hot = F.col("id") % 3 == 0
        alarms = ids.select(
            F.col("id"),
            F.when(hot, "hot").otherwise(F.concat(F.lit("r"), F.col("id").cast("string"))).alias("RECON_ID"),
            F.lit("c").alias("EVENT_CODE"),
            F.when(hot, F.lit(100)).otherwise(F.col("id")).alias("CORE_TIME_NUM"),
            F.lit("b").alias("BUS_ID"),
        )
        incidents = spark.createDataFrame([incident("i", "hot", "c", 110)], INCIDENT)
        got = R.interval_match(alarms, incidents)
        assert got.where("INCIDENT_ID = 'i'").count() == 20_000
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
