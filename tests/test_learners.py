"""Rows that the registered learning queries read."""

import threading
from functools import cache
from types import SimpleNamespace

from conftest import rows

from opstelemetry.operators import classify as C
from opstelemetry.plans import analysis, catalog

TRAINING = (
    "POLLER_TIME long, MEASURED_VALUE double, NEW_BUS_ID string, SITE string, HAS_NEIGHBOR_INCIDENT boolean, "
    "PctFree_VALUE double, used_VALUE double, HOUR int, WEEKDAY int"
)


def test_single_metric_appends_the_month_to_its_periods(spark, monkeypatch):
    cut = catalog.SECOND_WEEK
    listed = [
        (cut - 1, 5.0, "b", "s", True, 5.0, None, 0, 0),
        (cut, 6.0, "b", "s", False, 6.0, None, 0, 0),
        (None, 7.0, None, None, False, 7.0, None, None, None),
        (cut, 8.0, "b", "s", False, None, 8.0, 0, 0),
    ]
    monkeypatch.setattr(catalog, "_training_rows", lambda *_: spark.createDataFrame(listed, TRAINING))
    got = rows(catalog.single_metric_rows(spark, ""), "HAS_NEIGHBOR_INCIDENT", "PctFree_VALUE")
    assert got == [(0, 6.0), (0, 6.0), (0, 7.0), (0, 7.0), (1, 5.0), (1, 5.0)]


def test_learners_share_one_mapping(spark, monkeypatch):
    asked = []

    class Tables:
        incidents = None

        @property
        def mapping(self):
            asked.append(spark.range(3).toDF("POLLER_TIME"))
            return asked[-1]

    monkeypatch.setattr(catalog, "stand_in", lambda *_: Tables())
    monkeypatch.setattr(catalog, "X", SimpleNamespace(neighbour_training_set=lambda mapping, **_: mapping))
    monkeypatch.setattr(catalog, "train_hourly", lambda mapping, _: (None, mapping))
    assert catalog._training_rows(spark, "one mapping").count() == catalog._hourly_scored(spark, "one mapping").count() == 3
    assert len(asked) == 1


def test_hourly_aggregates_are_settled_before_training(spark, monkeypatch):
    monkeypatch.setattr(analysis, "hourly_training_set", lambda *_, **__: spark.range(2))
    monkeypatch.setattr(analysis, "train_and_test", lambda df, _: df)
    assert analysis.train_hourly(None, None)._settled


def test_learners_train_side_by_side(spark, monkeypatch):
    met = threading.Barrier(3, timeout=60)
    scored = spark.createDataFrame([(0, 0), (1, 0), (1, 1)], "label int, prediction int")

    def learner(result):
        @cache
        def train(*_):
            met.wait()
            return result

        return train

    monkeypatch.setattr(catalog, "_training_rows", lambda *_: None)
    monkeypatch.setattr(catalog, "_full_model", learner((None, scored, C.confusion(scored))))
    monkeypatch.setattr(catalog, "_single_scored", learner(scored))
    monkeypatch.setattr(catalog, "_hourly_scored", learner(scored))
    got = rows(catalog.learner_totals(spark, ""), "learner", "part", "label", "n")
    parts = [("all metrics", "hold-out"), ("all metrics", "other week"), ("hourly", "hold-out"), ("one metric", "hold-out")]
    assert got == [(*p, label, label + 1) for p in parts for label in (0, 1)]
