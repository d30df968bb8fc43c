import pytest
from conftest import executed_plan, rows
from pyspark.sql import functions as F

from opstelemetry.operators import enrich as E
from opstelemetry.operators import filters as P


@pytest.fixture(scope="module")
def top(spark):
    return spark.createDataFrame([("B1", "5"), ("R1", "9")], "NEW_BUS_ID string, NUM_CUST_DEVICES string")


def test_top_clients_own_and_parent(spark, top):
    # own and parent in the list: two rows; equal: one; parent unknown: by own id; neither: none
    events = spark.createDataFrame(
        [(1, "B1", "R1"), (2, "B1", "B1"), (3, "B1", None), (4, "B9", "R1"), (5, "B9", None), (6, None, "R1")],
        "id int, BUS_ID string, PARENT_BUS_ID string",
    )
    for options in ({}, {"broadcast_bytes": 0}):
        got = rows(E.join_top_clients(events, top, **options), "id", "NEW_BUS_ID")
        assert got == [(1, "B1"), (1, "R1"), (2, "B1"), (3, "B1"), (4, "R1"), (6, "R1")]


def test_top_clients_plan_has_no_product(spark, top):
    events = spark.range(10).select(
        F.concat(F.lit("B"), F.col("id").cast("string")).alias("BUS_ID"),
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("PARENT_BUS_ID"),
    )
    for options in ({}, {"broadcast_bytes": 0}):
        plan = executed_plan(E.join_top_clients(events, top, **options))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lookup_beyond_the_bound_is_not_broadcast(spark, top):
    events = spark.createDataFrame([("B1", "R1")], "BUS_ID string, PARENT_BUS_ID string")
    small = E.join_top_clients(events, top)
    large = E.join_top_clients(events, top, broadcast_bytes=0)
    assert "strategy=broadcast" in small._jdf.queryExecution().analyzed().toString()
    assert "strategy=merge" in large._jdf.queryExecution().analyzed().toString()


def test_fan_out_of_dimensions(spark):
    log = spark.createDataFrame(
        [
            ("D", "10", "11", "t1", "p", "T", "1", "0", "l", "3", "h", "f", "c", "used"),
            ("D", "10", "11", "t1", "p", "S", "1", "0", "l", "3", "h", "f", "c", "used"),
            ("D", "10", "11", "t1", "p", "T", "1", "0", "l", "3", "h", "f", "c", "Started"),
            ("D", "10", "11", "t1", "p", "T", "1", "0", "l", "3", "h", "f", "c", None),
            ("D", "x", None, "t2", "p", "T", "1", "0", "l", "3", "h", "f", "c", "used"),
            ("D", "10", "11", "t9", "p", "T", "1", "0", "l", "3", "h", "f", "c", "used"),
        ],
        "destination string, core_time string, poller_time string, target_id string, policy_id string, "
        "policy_type string, detected_severity string, propagated_severity string, low_threshold string, "
        "measured_value string, high_threshold string, propagated_flag string, event_code string, metric_name string",
    )
    dims = E.Dimensions(
        device=spark.createDataFrame([("t1", "r1"), ("t2", "r2")], "DEVICE_TARGET_ID string, RECON_ID string"),
        customer=spark.createDataFrame([("r1", "b1"), ("r2", "b2")], "RECONCILIATION_ID string, BUS_ID string"),
        bus_parent=spark.createDataFrame([("q1", "b1"), ("q2", "b1")], "PARENT_BUS_ID string, HIER_BUS_ID string"),
        top_clients=spark.createDataFrame(
            [("b1", "1", "1", "1", "1"), ("q2", "2", "1", "1", "2"), ("b2", "3", "1", "1", "3")],
            "NEW_BUS_ID string, NUM_CUST_DEVICES string, PERCENT string, CUMULATIVE_PERCENT string, RANK string",
        ),
        device_location=spark.createDataFrame(
            [("b1", "srv", "os", "r1", "A-1 x", "N")],
            "BUS_ID_DEV string, DEVICE_TYPE string, OPERATING_SYSTEM string, RECONCILIATION_ID string, SITE string, IS_VIRTUAL string",
        ),
        parent_monitor=spark.createDataFrame(
            [("m1", "t1"), ("m2", "t1")], "PARENT_TARGET_ID string, CHILD_TARGET_ID string"
        ),
        monitor_type=spark.createDataFrame([("t1", "ping")], "MONITOR_ID string, MONITOR_DESC string"),
    )
    got = E.enrich_events(log, dims)
    assert len(got.columns) == 27
    # t1: (b1 with q1 -> b1), (b1 with q2 -> b1 and q2), each under two parent monitors
    assert rows(got, "TARGET_ID", "PARENT_BUS_ID", "NEW_BUS_ID", "PARENT_TARGET_ID", "SITE", "SITE_DESC") == [
        ("t1", "q1", "b1", "m1", "A1x", "A-1 x"),
        ("t1", "q1", "b1", "m2", "A1x", "A-1 x"),
        ("t1", "q2", "b1", "m1", "A1x", "A-1 x"),
        ("t1", "q2", "b1", "m2", "A1x", "A-1 x"),
        ("t1", "q2", "q2", "m1", "A1x", "A-1 x"),
        ("t1", "q2", "q2", "m2", "A1x", "A-1 x"),
        ("t2", None, "b2", None, None, None),
    ]
    times = {(r.TARGET_ID, str(r.CORE_TIMESTAMP), r.POLLER_TIMESTAMP is None) for r in got.collect()}
    assert times == {("t1", "1970-01-01 00:00:10", False), ("t2", "None", True)}


def test_alarms_are_three_valued(spark):
    df = spark.createDataFrame(
        [(1, "0", "0"), (2, "1", "0"), (3, None, "0"), (4, None, "2"), (5, "0", None)],
        "id int, DETECTED_SEVERITY string, PROPAGATED_SEVERITY string",
    )
    assert rows(P.alarms(df), "id") == [(2,), (4,)]


def test_incidents(spark):
    inc = spark.createDataFrame(
        [
            ("i1", "100", "b", "c", "Other"),
            ("i2", "100", "b", "c", None),
            ("i3", "99", "b", "c", "m"),
            ("i4", "200", "b", "c", "m"),
            ("i5", "199", "b", "c", "m"),
            ("i6", "abc", "b", "c", "m"),
        ],
        "INCIDENT_ID string, SUBMIT_DATE string, BUS_ID string, EVENT_CODE string, submitter string",
    )
    dev = spark.createDataFrame(
        [(f"i{i}", "r1") for i in range(1, 7)] + [("i2", "r2"), ("zz", "r1")],
        "INCIDENT_DEV_ID string, RECON_ID string",
    )
    got = E.prepare_incidents(inc, dev, 100, 200)
    assert got.columns == [
        "INCIDENT_ID", "SUBMIT_DATE", "BUS_ID", "EVENT_CODE_INC", "RECON_ID_INC", "Is_Source_Monitor", "SUBMIT_DATE_NUM",
    ]
    assert rows(got, "INCIDENT_ID", "RECON_ID_INC", "SUBMIT_DATE_NUM") == [
        ("i2", "r1", 100), ("i2", "r2", 100), ("i5", "r1", 199),
    ]


def test_values_and_sites(spark):
    df = spark.createDataFrame(
        [("abc", "A"), ("NaN", "A"), (None, "A"), ("105", "B"), ("105.1", "B"), ("0", "C")],
        "MEASURED_VALUE string, SITE string",
    )
    assert rows(P.valid_values(df), "MEASURED_VALUE") == [(0.0,), (105.0,)]
    assert rows(P.canonical_site(df, {"A": "B"}).select("SITE").distinct(), "SITE") == [("B",), ("C",)]


def test_neighbour_predicate_and_open_range(spark):
    df = spark.createDataFrame([(-3600,), (-3599,), (0,), (3599,), (3600,), (None,)], "d int")
    got = [tuple(r) for r in df.select("d", P.is_neighbour("d")).collect()]
    assert [d for d, near in got if near] == [-3599, 0, 3599]
    assert rows(df.where(P.between_open("d", -3600, 3600)), "d") == [(-3599,), (0,), (3599,)]


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [(1, 0.0, None), (2, 5.0, None), (3, None, None)], "id int, a double, b double"
    )
    assert rows(P.zero_to_null(df, ["a"]), "id", "a") == [(1, None), (2, 5.0), (3, None)]
    assert P.drop_null_columns(df, "all").columns == ["id", "a"]
    assert P.drop_null_columns(df, "any").columns == ["id"]
    assert P.feature_names(df, "id") == ["a", "b"]
    assert P.all_null(df, ["a", "b"]).count() == 1
    assert P.has_value(df, "a").count() == 2
    assert P.append_frames(df, df.drop("b")).count() == 6
    ids = P.with_row_id(df)
    assert ids.select("row_id").distinct().count() == 3
    assert rows(P.with_constant(df, "one", 1), "one") == [(1,)] * 3
    assert P.select_as(df, {"a": "x"}).columns == ["x"]
