import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.operators import classify as C
from opstelemetry.plans.analysis import train_full, train_single

CONFIG = C.ClassifierConfig(label="hit", trees=5, train_fraction=0.7)


@pytest.fixture(scope="module")
def data(spark):
    x = F.col("id") % 100
    return spark.range(1000).select(
        "id", F.when(x % 5 != 0, x.cast("double")).alias("x"), (F.col("id") % 7).cast("double").alias("z"), (x > 70).alias("hit")
    )


def test_fit_and_score(spark, data, tmp_path):
    model, scored = C.train_and_test(data.drop("id"), CONFIG)
    assert model.names == ["x", "z"]
    # x has missing values and so two fills, z is always known
    assert sorted(model.inputs) == ["x__high", "x__low", "z__low"]
    m = C.confusion_metrics(scored).first()
    assert m.recall > 0.7
    # rows whose x is missing cannot be told apart; all others can
    assert C.confusion_metrics(C.score(model, data.where("x IS NOT NULL"))).first().f1 > 0.95
    again = C.score(C.fit_classifier(C.split(data.drop("id"), 0.7, CONFIG.seed)[0], CONFIG), data)
    assert rows(again, "label", "prediction", "p_incident") == rows(C.score(model, data), "label", "prediction", "p_incident")
    model.save(str(tmp_path / "m"))
    loaded = C.load_classifier(spark, str(tmp_path / "m"), "hit")
    assert loaded.names == model.names
    assert rows(C.score(loaded, data), "prediction") == rows(C.score(model, data), "prediction")
    # another week without one of the columns, and with one the model does not know
    other = data.drop("z", "id").withColumn("new", F.lit(1))
    assert C.evaluate_week(loaded, other).agg(F.sum("n")).first()[0] == 1000
    assert rows(C.feature_report(other, loaded), "feature", "status") == [("new", "dropped"), ("x", "kept"), ("z", "filled")]
    table = {r.feature: r for r in C.importance(model, spark).collect()}
    assert table["x__low"].splits + table["x__high"].splits > 0 and sum(r.gain for r in table.values()) == pytest.approx(1.0)
    assert "Tree 0" in C.dump_trees(model)


def test_nodes_add_up(spark, data):
    train, _ = C.split(data, 0.7, keys=["id"])
    model = C.fit_classifier(train.drop("id"), CONFIG)
    nodes = C.tree_nodes(model, spark).collect()
    assert {n.tree for n in nodes} == set(range(CONFIG.trees))
    for t in range(CONFIG.trees):
        by_id = {n.node: n for n in nodes if n.tree == t}
        leaves = [n for n in by_id.values() if n.feature is None]
        assert sum(n.rows for n in leaves) == by_id[0].rows == train.count()
        for n in by_id.values():
            if n.feature is not None:
                assert n.rows == by_id[n.left].rows + by_id[n.right].rows and n.gain > 0
                assert n.feature in model.inputs


def test_missing_values_learn_their_direction(spark):
    """In one half of the feature z missing values of x go with the large ones, in the other with the small ones."""
    i = F.col("id")
    rows_ = spark.range(2000).select(
        F.when(i % 4 != 0, (i % 100).cast("double")).alias("x"), (i % 2).cast("double").alias("z"),
        F.when(i % 4 == 0, F.lit(True)).otherwise(i % 100 > 60).alias("hit"),
    )
    model = C.fit_classifier(rows_, C.ClassifierConfig(label="hit", trees=20, depth=3))
    m = C.confusion_metrics(C.score(model, rows_)).first()
    assert (m.fp, m.fn) == (0, 0)
    # missing alone decides
    only = spark.range(1000).select(F.when(i % 5 != 0, i.cast("double")).alias("x"), (i % 5 == 0).alias("hit"))
    model = C.fit_classifier(only, C.ClassifierConfig(label="hit", trees=1, depth=1))
    first = [n for n in C.tree_nodes(model, spark).collect() if n.node == 0][0]
    assert first.feature in ("x__low", "x__high") and not 0 <= first.threshold <= 999
    assert C.confusion_metrics(C.score(model, only)).first().f1 == 1.0
    # NaN is missing too
    nan = spark.createDataFrame([(float("nan"), True), (5.0, False)], "x double, hit boolean")
    assert C.confusion_metrics(C.score(model, nan)).first().f1 == 1.0


def test_both_classes_are_needed(data):
    with pytest.raises(ValueError):
        C.fit_classifier(data.where("hit").drop("id"), CONFIG)


def test_confusion(spark):
    df = spark.createDataFrame(
        [(1, 1)] * 6 + [(0, 1)] * 2 + [(1, 0)] * 3 + [(0, 0)] * 9, "label int, prediction int"
    )
    assert rows(C.confusion(df), "label", "prediction", "n") == [(0, 0, 9), (0, 1, 2), (1, 0, 3), (1, 1, 6)]
    hit = C.confusion_metrics(df).first()
    assert (hit.precision, hit.recall) == (0.75, pytest.approx(6 / 9))
    assert hit.f1 == pytest.approx(2 * 0.75 * (6 / 9) / (0.75 + 6 / 9))
    noise = C.confusion_metrics(df, positive=0).first()
    assert (noise.tp, noise.precision, noise.recall) == (9, 0.75, pytest.approx(9 / 11))
    nothing = C.confusion_metrics(df.where("label = 0 and prediction = 0")).first()
    assert nothing.precision is None and nothing.recall is None


def test_curve(spark):
    rng = random.Random(4)
    data = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(500)] + [(1, 1.0), (0, 0.0)]
    df = spark.createDataFrame(data, "label int, p_incident double")
    hits, area, before = sum(l for l, _ in data), 0.0, 0.0
    want = []
    for t in sorted({p for _, p in data}, reverse=True):
        chosen = [l for l, p in data if p >= t]
        precision, recall = sum(chosen) / len(chosen), sum(chosen) / hits
        area, before = area + (recall - before) * precision, recall
        want.append((t, pytest.approx(precision), pytest.approx(recall)))
    got = [tuple(r)[:3] for r in C.pr_curve(df).orderBy(F.desc("threshold")).collect()]
    assert got == want
    assert C.average_precision(df).first()[0] == pytest.approx(area)


def test_curve_of_any_score(spark):
    inf, nan = float("inf"), float("nan")
    schema = "label int, p_incident double"
    df = spark.createDataFrame([(1, inf), (0, nan), (1, 0.5), (1, -inf), (0, 0.5), (1, None)], schema)
    got = [tuple(r)[:3] for r in C.pr_curve(df).orderBy(F.desc("threshold")).collect()]
    want = [(nan, 0.0, 0.0), (inf, 0.5, 0.25), (0.5, 0.5, 0.5), (-inf, 0.6, 0.75)]
    assert repr(got) == repr(want)
    assert C.pr_curve(df.limit(0)).collect() == [] and C.average_precision(df.limit(0)).first()[0] is None
    none = C.pr_curve(spark.createDataFrame([(0, 0.5)], schema)).first()
    assert (none["precision"], none["recall"]) == (0.0, None)


def test_weeks(spark):
    week = spark.range(600).select(
        F.col("id").alias("POLLER_TIME"), F.lit(1.0).alias("MEASURED_VALUE"), F.lit("b").alias("NEW_BUS_ID"),
        F.when(F.col("id") % 2 == 0, "S1").otherwise("S2").alias("SITE"), (F.col("id") % 10 > 6).alias("HAS_NEIGHBOR_INCIDENT"),
        *[F.lit(None).cast("double").alias(f"{m}_VALUE") for m in ("LDldDiskTimePercent", "LDldFreeSpacePct", "UsedMBPct", "used")],
        (F.col("id") % 10).cast("double").alias("PctFree_VALUE"), (F.col("id") % 24).cast("int").alias("HOUR"),
        (F.col("id") % 7).cast("int").alias("WEEKDAY"),
    )
    other = week.withColumn("SITE", F.lit("S3"))
    config = C.ClassifierConfig(label="HAS_NEIGHBOR_INCIDENT", trees=3)
    model, _, table = train_full(week, other, config)
    assert model.vectors == ["SITE_HOT"] and "used_VALUE" not in model.names
    assert [r.site for r in model.sites.orderBy("index").collect()] == ["S1", "S2"]
    assert "SITE_S1" in [r.feature for r in C.importance(model, spark).collect()]
    assert {(r.label, r.prediction): r.n for r in table.collect()} == {(0, 0): 420, (0, 1): 0, (1, 0): 0, (1, 1): 180}
    _, scored = train_single([week, week], config=config)
    assert C.confusion_metrics(scored).first().f1 == 1.0
