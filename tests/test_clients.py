import hashlib
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.functions.scale import running_totals
from opstelemetry.operators import clients as K


def test_rollup_and_counts(spark):
    customer = spark.createDataFrame(
        [("r1", "b1"), ("r2", "b1"), ("r3", "b2"), ("r4", None), (None, "b2")], "RECONCILIATION_ID string, BUS_ID string"
    )
    parents = spark.createDataFrame([("p2", "b1"), ("p1", "b1")], "PARENT_BUS_ID string, HIER_BUS_ID string")
    rolled = K.client_rollup(customer, parents)
    assert rolled.count() == 5
    assert rows(K.device_count(rolled), "NEW_BUS_ID", "RECONCILIATION_NUM") == [("b2", 1), ("p1", 2)]


def test_rank(spark):
    rng = random.Random(1)
    counts = [(f"c{i}", rng.choice([1, 1, 1, 2, 5, 40 + i])) for i in range(400)]
    df = spark.createDataFrame(counts, "NEW_BUS_ID string, RECONCILIATION_NUM long")
    order = sorted(counts, key=lambda c: (-c[1], hashlib.md5(c[0].encode()).hexdigest()))
    got = K.client_rank(df).orderBy("RANK").collect()
    assert [(r.NEW_BUS_ID, r.RANK) for r in got] == [(c, i + 1) for i, (c, _) in enumerate(order)]
    total, so_far = sum(n for _, n in counts), 0
    for r, (_, n) in zip(got, order):
        so_far += n
        assert r.PERCENT == pytest.approx(100 * n / total)
        assert r.CUMULATIVE_PERCENT == pytest.approx(100 * so_far / total)
    assert got[-1].CUMULATIVE_PERCENT == pytest.approx(100.0)
    assert K.top_clients(K.client_rank(df), 150).count() == 150


def test_top_talkers_bounds_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", 5), ("b", 6), ("c", 6), ("c", 7), ("d", 1), ("e", 10)], "RECON_ID_INC string, SUBMIT_DATE_NUM long"
    )
    got = [tuple(r) for r in K.top_talkers(df, 1, 10, n=2).collect()]
    assert got == [("b", 2), ("c", 2)]


def test_running_totals_per_group(spark, many_parts):
    data = [(g, x) for g in ("a", "b", None) for x in random.Random(2).sample(range(1000), 200)]
    data += [("hot", x) for x in range(20_000)]
    df = spark.createDataFrame(data, "g string, x int").repartition(5)
    got = running_totals(df, {"n": F.lit(1), "s": F.col("x")}, order=[F.col("x")], group=["g"], part="p")
    assert got.where("g = 'hot'").select("p").distinct().count() > 1
    for g in ("a", "b", None, "hot"):
        xs = sorted(x for key, x in data if key == g)
        want, upto = [], 0
        for i, x in enumerate(xs):
            upto += x
            want.append((x, i + 1, upto, len(xs), sum(xs)))
        assert rows(got.where(F.col("g").eqNullSafe(g)), "x", "n", "s", "n_all", "s_all") == sorted(want, key=repr)
    assert running_totals(df.limit(0), {"n": F.lit(1)}, [F.col("x")]).collect() == []


def test_rank_of_many_equal_counts(spark, many_parts):
    counts = spark.range(5000).select(F.col("id").cast("string").alias("NEW_BUS_ID"), (F.col("id") % 2 + 1).alias("RECONCILIATION_NUM"))
    got = K.client_rank(counts).orderBy("RANK").collect()
    assert [r["RANK"] for r in got] == list(range(1, 5001))
    assert [r["RECONCILIATION_NUM"] for r in got] == [2] * 2500 + [1] * 2500
    assert got[-1]["CUMULATIVE_PERCENT"] == 100.0
