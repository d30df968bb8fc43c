import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opstelemetry.operators import features as X

MAPPING = (
    "POLLER_TIME long, METRIC_NAME string, MEASURED_VALUE string, RECON_ID string, EVENT_CODE string, "
    "NEW_BUS_ID string, SITE string, INCIDENT_ID string, HAS_MAPPED_INCIDENT int"
)
INCIDENT = "INCIDENT_ID string, EVENT_CODE_INC string, RECON_ID_INC string, SUBMIT_DATE_NUM long"


def test_hourly_repeats_events_per_incident(spark):
    mapping = spark.createDataFrame(
        [(3600, "used", "10", "r", "c", "b", "s", None, None), (7199, "used", "40", "r", "d", "b", "s", "i9", 1),
         (7200, "used", "7", "r", "c", "b", "s", None, None), (3600, "PctFree", "junk", "r", "c", "b", "s", None, None),
         (3600, "used", "5", "q", None, "b", "s", None, None)],
        MAPPING,
    )
    incidents = spark.createDataFrame(
        [("i1", "c", "r", 4000), ("i2", "c", "r", 4001), ("i3", "x", "r", 4000), ("i4", None, "q", 3600)], INCIDENT
    )
    got = rows(
        X.hourly_features(mapping, incidents),
        "RECON_ID", "METRIC_NAME", "POLLER_TIME_PERIOD_60_MIN", "MEAN", "MAX", "MIN", "COUNT", "HAS_MAPPED_INCIDENT_MERGED",
    )
    # the first event meets two incidents: (10 + 10 + 40) / 3
    assert got == sorted(
        [("r", "used", 1, 20.0, 40.0, 10.0, 3, True), ("r", "used", 2, 7.0, 7.0, 7.0, 1, False),
         ("r", "PctFree", 1, None, None, None, 0, False), ("q", "used", 1, 5.0, 5.0, 5.0, 1, False)], key=repr,
    )
    joined = X.hourly_match(mapping, incidents)
    assert joined.count() == 7
    assert X.incident_coverage(joined).first()["incidents"] == 4
    wide = X.hourly_training_set(mapping, incidents)
    assert len(wide.columns) == 36
    row = wide.where("used_COUNT = 3").first()
    assert (row["used_MEAN"], row["PctFree_MEAN"], row["HOUR"], row["WEEKDAY"], row["COUNT"]) == (20.0, None, 1, 3, 3)


def test_hourly_labels_are_kept(spark):
    mapping = spark.range(500).select(
        (F.col("id") * 97).alias("POLLER_TIME"), F.lit("used").alias("METRIC_NAME"), F.lit("1").alias("MEASURED_VALUE"),
        (F.col("id") % 3).cast("string").alias("RECON_ID"), F.lit("c").alias("EVENT_CODE"),
        F.when(F.col("id") % 50 == 0, 1).alias("HAS_MAPPED_INCIDENT"),
    )
    incidents = spark.createDataFrame([], INCIDENT)
    hours = X.hourly_features(mapping, incidents)
    hit = mapping.where("HAS_MAPPED_INCIDENT = 1").select("RECON_ID", F.floor(F.col("POLLER_TIME") / 3600)).distinct()
    assert hours.where("HAS_MAPPED_INCIDENT_MERGED").count() == hit.count()


@pytest.fixture(scope="module")
def week(spark):
    t = 1_000_000
    mapping = spark.createDataFrame(
        [(t, "PctFree", "50", "r", "c", "b", "MM400MinutemanRoad", "i", 1), (t + 10, "PctFree", "0", "r", "c", "b", "S2", None, None),
         (t + 20, "PctFree", "105.1", "r", "c", "b", "S2", None, None), (t + 9000, "used", "3", "r", "c", "b", None, None, None),
         (t, "UsedMBPct", "3", "r", "c", "b", "S2", None, None), (t, "elsewhere", "3", "r", "c", "b", "S2", None, None)],
        MAPPING,
    )
    return X.neighbour_training_set(mapping)


def test_training_set(week):
    assert len(week.columns) == 15
    got = rows(week, "MEASURED_VALUE", "PctFree_VALUE", "used_VALUE", "SITE", "HAS_NEIGHBOR_INCIDENT")
    assert got == sorted(
        [(50.0, 50.0, None, "MM400MinutemanRd", True), (0.0, None, None, "S2", True), (3.0, None, 3.0, None, False),
         (3.0, None, None, "S2", False)], key=repr,
    )


def hot(df):
    """Of each row the sizes and places of ones of its site vector."""
    return sorted((r["SITE_HOT"].size, [int(i) for i in r["SITE_HOT"].indices]) for r in df.select("SITE_HOT").collect())


def test_cleaners(week):
    full = X.clean_full(week)
    assert full.columns == ["HAS_NEIGHBOR_INCIDENT", "PctFree_VALUE", "used_VALUE", "HOUR", "WEEKDAY", "SITE_HOT"]
    assert full.count() == 3
    assert hot(full) == [(2, []), (2, [0]), (2, [1])]
    single = X.clean_single([week, week], "PctFree")
    assert sorted(single.columns) == ["HAS_NEIGHBOR_INCIDENT", "PctFree_VALUE"] and single.count() == 2


def test_sites_of_any_number(spark):
    """20,000 sites are 20,000 slots of a sparse vector: one entry a row, and no column a site."""
    df = spark.range(60_000).select("id", F.format_string("site%05d", F.col("id") % 20_000).alias("SITE"))
    sites = X.site_index(df)
    assert sites.count() == 20_000
    encoded = X.site_one_hot(df, sites)
    assert encoded.columns == ["id", "SITE_HOT"]
    for r in encoded.where("id % 9973 = 0").collect():
        assert (r["SITE_HOT"].size, list(r["SITE_HOT"].indices), list(r["SITE_HOT"].values)) == (20_000, [r["id"] % 20_000], [1.0])
    other = spark.createDataFrame([(1, "elsewhere"), (2, None), (3, "site00007")], "id long, SITE string")
    assert [list(r["SITE_HOT"].indices) for r in X.site_one_hot(other, sites).orderBy("id").collect()] == [[], [], [7]]
    assert X.site_one_hot(other, X.site_index(other.where("SITE IS NULL"))).columns == ["id"]


def test_one_hot_and_spread(spark):
    df = spark.createDataFrame([("used", 0.0), (None, 2.0)], "METRIC_NAME string, MEASURED_VALUE double")
    assert rows(X.metric_one_hot(df, ["used"]), "METRIC_NAME_used") == [(0,), (1,)]
    assert rows(X.spread_values(df, ["used"], zero_as_null=False), "used_VALUE") == [(0.0,), (None,)]


def test_classes_and_split(spark):
    df = spark.range(3000).withColumn("label", (F.col("id") % 3 == 0))
    assert X.class_ratio(df, "label").first()["ratio"] == 2.0
    assert rows(X.class_counts(df, "label"), "label", "n") == [(False, 2000), (True, 1000)]
    train, test = X.split(df, 0.67, seed=1, keys=["id"])
    again, _ = X.split(df.repartition(7), 0.67, seed=1, keys=["id"])
    assert rows(train, "id") == rows(again, "id")
    for side, other in ((train, test), X.split(df.repartition(7), 0.67)):
        assert rows(side.unionByName(other), "id") == rows(df, "id")
        assert 0.62 < side.count() / 3000 < 0.72


def test_draw_follows_from_the_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a long, b string")
    draws = [r["__draw"] for r in X.with_draw(df, ["a", "b"]).collect()]
    assert draws[0] == draws[1] == int(hashlib.md5(b"1|7").hexdigest()[:8], 16) / 2**32 and 0 <= draws[2] < 1
    train, test = X.split(X.with_draw(df, ["a", "b"]), draws[0])
    assert "__draw" not in train.columns and test.where("a = 1").count() == 2


def test_split_spreads_equal_rows(spark):
    train, test = X.split(spark.range(1000).select(F.lit(1).alias("x")), 0.5)
    assert train.count() + test.count() == 1000 and 400 < train.count() < 600


def test_first_per_key_and_transform(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "y")], "k string, o int, v string")
    assert rows(X.first_per_key(df, ["k"], ["o"]), "k", "o", "v") == [("a", 1, "x"), ("b", 5, "y")]
    got = rows(X.group_transform(df, ["k"], {"n": F.count("v")}), "k", "o", "n")
    assert got == [("a", 1, 1), ("a", 2, 1), ("b", 5, 1)]
