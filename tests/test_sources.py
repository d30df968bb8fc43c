import glob
import gzip
from dataclasses import replace
from unittest.mock import MagicMock

import pytest
from conftest import executed_plan, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from opstelemetry import schemas
from opstelemetry.config import Config
from opstelemetry.functions import scalar
from opstelemetry.functions.scale import measured_bytes, scratch_root
from opstelemetry.plans import etl
from opstelemetry.plans.analysis import (
    run_client_selection,
    run_device_extract,
    run_profiles,
    run_thresholds,
    run_top_talkers,
    run_training_set,
    series_from_extract,
)
from opstelemetry.plans.etl import EtlInputs, JdbcSink, ParquetSink, log_partitions, run_etl
from opstelemetry.sources import readers, writers

HEADER = ",".join(f.name for f in schemas.EVENT_LOG_SCHEMA)


def event(target="t1", core="100", metric="used", value="5", code="c", policy="T", severity="1"):
    return f"D,{core}, {core},{target},p,{policy},{severity},0,l,{value},h,f,{code},{metric}"


@pytest.fixture()
def logs(tmp_path):
    lines = [HEADER, event(), "1,2,3", event(target="t2"), event() + ",extra", event(target="t3", metric="Started")]
    paths = []
    for i in (1, 2):
        path = tmp_path / f"event.log.{i}.csv.gz"
        with gzip.open(path, "wt") as out:
            out.write("\n".join(lines) + "\n")
        paths.append(str(path))
    return paths


def test_event_log_counts_agree(spark, logs):
    log = readers.read_event_log(spark, logs)
    # header and three good lines of each file, whichever columns are read
    assert log.count() == len(log.collect()) == len(log.select("target_id").collect()) == 8
    assert readers.read_event_log(spark, logs, partitions=5).rdd.getNumPartitions() == 5
    assert rows(log.where("target_id = 't1'"), "poller_time") == [("100",), ("100",)]


def test_malformed_lines_are_counted(spark, logs):
    lines = readers.scan_event_log(spark, logs, partitions=3)
    assert lines.rdd.getNumPartitions() == 3 and lines.count() == 12
    bad = readers.malformed_lines(lines).collect()
    assert [(r["malformed"], r["example"], r["first_field"]) for r in bad] == [(2, "1,2,3", "1")] * 2
    assert {r["_file"].rsplit("/", 1)[1] for r in bad} == {"event.log.1.csv.gz", "event.log.2.csv.gz"}
    counts = Observation()
    assert readers.read_event_log(spark, logs, counts=counts).count() == 8
    assert counts.get == {"lines": 12, "malformed": 4}


def test_extract_devices(spark, logs):
    got = readers.extract_devices(spark, logs, ["t2", "t3", 9])
    assert rows(got, *got.columns) == [("100", "t2", "5", "used")] * 2 + [("100", "t3", "5", "Started")] * 2
    assert series_from_extract(got).dtypes[0] == ("poller_time", "bigint")


def test_dimension(spark, tmp_path):
    (tmp_path / "d.csv").write_text("SITE,BUS_ID,DEVICE_TYPE,OPERATING_SYSTEM,RECONCILIATION_ID,IS_VIRTUAL\n  A-1,007,srv,x, r1,N\n")
    got = readers.read_dimension(spark, str(tmp_path / "d.csv"), schemas.DEVICE_LOCATION)
    assert [tuple(r) for r in got.collect()] == [("007", "srv", "x", "r1", "A-1", "A-1", "N")]
    assert set(t for _, t in got.dtypes) == {"string"}


def test_series_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("1,100,t1,2.5,used\n2,101,t1,,used\n")
    assert rows(readers.read_series(spark, str(tmp_path / "s.csv")), "poller_time", "measured_value") == [(100, 2.5), (101, None)]
    (tmp_path / "h.csv").write_text("poller_time,id,v,metric_name,unknown\n100,7,2.5,used,x\n")
    got = readers.read_header_series(spark, str(tmp_path / "h.csv"))
    assert [tuple(r) for r in got.collect()] == [(100, "7", 2.5, "used")]
    (tmp_path / "f.csv").write_text(",a,b\n0,1.5,x\n")
    features = readers.read_features(spark, str(tmp_path / "f.csv"), "i int, a double, b string", "i")
    assert [tuple(r) for r in features.collect()] == [(1.5, "x")]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame(
        [("used", "5", 3, "r1"), ("used", "x", 1, "r2"), ("PctFree", "7", 2, "r1")],
        "METRIC_NAME string, DETECTED_SEVERITY string, CORE_TIME_NUM int, RECON_ID string",
    )
    path = str(tmp_path / "t")
    for _ in range(2):
        writers.write_table(df, path, column_types={"DETECTED_SEVERITY": "INT", "METRIC_NAME": "VARCHAR(9)"})
    table = readers.read_table(spark, path)
    assert table.count() == 6 and dict(table.dtypes)["DETECTED_SEVERITY"] == "int"
    assert readers.metric_subset(table, ["used"]).count() == 4
    writers.write_table(df, path, mode="overwrite")
    assert readers.read_table(spark, path).count() == 3
    clustered = str(tmp_path / "c")
    writers.write_clustered(df, clustered, sort_by=["CORE_TIME_NUM"], partitions=2)
    one = readers.read_table(spark, clustered).where("METRIC_NAME = 'used' and CORE_TIME_NUM > 2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(METRIC_NAME" in plan and "GreaterThan(CORE_TIME_NUM,2)" in plan


def test_metric_filters(spark):
    df = spark.createDataFrame(
        [("used", "r", "b", "s", "1", "z"), ("other", "r", "b", "s", "1", "z")],
        "METRIC_NAME string, RECON_ID string, NEW_BUS_ID string, SITE string, MEASURED_VALUE string, extra string",
    )
    assert readers.metric_samples(df, "used").columns == ["RECON_ID", "NEW_BUS_ID", "SITE", "MEASURED_VALUE"]
    assert readers.metric_subset(df, ["used", "none"]).count() == 1


def test_jdbc_calls():
    """No database is started: the calls on Spark's writer are checked instead."""
    df = MagicMock(columns=["A", "B"])
    writer = df.write.mode.return_value.option.return_value
    sink = JdbcSink("jdbc:x", {"user": "u"})
    sink.put(df, "t", "overwrite", {"A": "INT", "C": "INT", "B": "VARCHAR(5)"})
    df.write.mode.assert_called_once_with("overwrite")
    writer.option.assert_called_once_with("createTableColumnTypes", "A INT, B VARCHAR(5)")
    writer.option.return_value.jdbc.assert_called_once_with("jdbc:x", "t", properties={"user": "u"})
    session = MagicMock()
    readers.read_jdbc_table(session, "jdbc:x", "t", {}, "id", 0, 9, 3)
    assert session.read.jdbc.call_args.kwargs["numPartitions"] == 3
    readers.read_jdbc_table(session, "jdbc:x", "t", {})
    assert "numPartitions" not in session.read.jdbc.call_args.kwargs


def test_time_text(spark):
    df = spark.createDataFrame([(1704067207,), (1705276800,)], "t long")
    got = [r[0] for r in df.select(scalar.fmt_time("t")).collect()]
    assert got == ["Mon Jan  1 00:00:07 2024", "Mon Jan 15 00:00:00 2024"]


def test_measured_bytes(spark):
    assert measured_bytes(spark.createDataFrame([], "a string")) == 0
    df = spark.createDataFrame([("abc", 1, ["x"]), (None, None, None)], "a string, b int, c array<string>")
    assert 60 < measured_bytes(df) < 200


def settled_files(spark):
    return glob.glob(f"{scratch_root(spark)}/opstelemetry/*")


@pytest.mark.parametrize("known", [True, False])
def test_log_is_read_once(spark, tmp_path, monkeypatch, known):
    """The enriched events are settled once, and events, alarms and mapping read that; also if no device is known."""
    counted, scans = spark.sparkContext.accumulator(0), []
    real = etl.scan_event_log

    def scan(*args, **kwargs):
        def count(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        lines = real(*args, **kwargs)
        scans.append(lines)
        return lines.mapInArrow(count, lines.schema)

    monkeypatch.setattr(etl, "scan_event_log", scan)
    paths = {}
    known_rows = {"device": "t1,r1", "customer": "r1,b1", "top_clients": "b1,5,50,50,1"}
    for name, spec in (("device", schemas.DEVICE), ("customer", schemas.CUSTOMER), ("bus_parent", schemas.BUS_PARENT),
                       ("top_clients", schemas.TOP_CLIENTS), ("device_location", schemas.DEVICE_LOCATION),
                       ("parent_monitor", schemas.PARENT_MONITOR), ("monitor_type", schemas.MONITOR_TYPE),
                       ("incidents", schemas.INCIDENT), ("incident_device", schemas.INCIDENT_DEVICE)):
        header = ",".join(dict.fromkeys(source for source, _ in spec.columns))
        row = known_rows.get(name, "") if known else ""
        (tmp_path / name).write_text(f"{header}\n{row}\n")
        paths[name] = str(tmp_path / name)
    assert (tmp_path / "device").read_text().startswith("TARGET_ID,RECON_ID")
    (tmp_path / "log").write_text("".join(event(core=str(i)) + "\n" for i in range(50)) + "1,2\n")
    report = run_etl(spark, EtlInputs(event_logs=[str(tmp_path / "log")], **paths), ParquetSink(str(tmp_path / "out")))
    assert len(scans) == 1 and counted.value == report.lines == 51 and report.malformed == 1
    if known:
        assert readers.read_table(spark, str(tmp_path / "out/events")).count() == 50


def test_client_selection_feeds_the_etl(spark, tmp_path):
    customer = spark.createDataFrame([("r1", "b1"), ("r2", "b1"), ("r3", "b2"), ("r4", "b3")], "RECONCILIATION_ID string, BUS_ID string")
    parent = spark.createDataFrame([("p", "b2"), ("p", "b3")], "PARENT_BUS_ID string, HIER_BUS_ID string")
    run_client_selection(customer, parent, str(tmp_path / "top"), 1)
    got = readers.read_dimension(spark, str(tmp_path / "top"), schemas.TOP_CLIENTS).collect()
    assert len(got) == 1 and got[0]["NUM_CUST_DEVICES"] == "2" and got[0]["NEW_BUS_ID"] in ("b1", "p")


def test_etl_and_followers(spark, tmp_path):
    def csv(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    config = Config()
    at = config.incident_start + 3600
    log = csv(
        "log.csv", HEADER, event(core=str(at)), event(core=str(at - 60)), event(core=str(at), severity="0"),
        event(target="t2", core=str(at), metric="PctFree"), event(core=str(at), policy="S"),
    )
    inputs = EtlInputs(
        event_logs=[log],
        device=csv("device.csv", "TARGET_ID,RECON_ID", "t1,r1", "t2,r2"),
        customer=csv("customer.csv", "RECONCILIATION_ID,BUS_ID", "r1,b1", "r2,b2"),
        bus_parent=csv("bus_parent.csv", "PARENT_ID,BUS_ID", "q1,b1"),
        top_clients=csv("top.csv", "NEW_BUS_ID,RECONCILIATION_NUM,PERCENT,CUMULATIVE_PERCENT,RANK", "q1,5,50,50,1", "b2,5,50,100,2"),
        device_location=csv("loc.csv", "BUS_ID,DEVICE_TYPE,OPERATING_SYSTEM,RECONCILIATION_ID,SITE,IS_VIRTUAL", "b1,s,o,r1,S 1,N"),
        parent_monitor=csv("parent.csv", "PARENT_ID,TARGET_ID", "m1,t1"),
        monitor_type=csv("type.csv", "TARGET_ID,TYPE", "t1,ping"),
        incidents=csv("inc.csv", "incident_id,submit_date,bus_id,event_code,submitter", f"i1,{at + 10},b1,c,mon", f"i2,{at + 10},b1,c,Other"),
        incident_device=csv("incdev.csv", "incident_id,recon_id", "i1,r1", "i2,r1"),
    )
    with open(log, "rb") as plain, gzip.open(log + ".gz", "wb") as out:
        out.write(plain.read() + b"cut,line\n")
    inputs = replace(inputs, event_logs=[log + ".gz"])
    sink = ParquetSink(str(tmp_path / "out"))
    left = set(settled_files(spark))
    for _ in range(2):
        report = run_etl(spark, inputs, sink)
        assert (report.lines, report.malformed) == (7, 1)
    assert set(settled_files(spark)) == left
    assert log_partitions(spark, inputs.event_logs, config) == 8 and log_partitions(spark, [log], config) is None
    assert log_partitions(spark, inputs.event_logs, replace(config, log_partitions=3)) == 3
    events, mapping, incidents = (
        readers.read_table(spark, f"{sink.root}/{t}") for t in ("events", "event_incident_mapping", "incidents")
    )
    assert (events.count(), mapping.count(), incidents.count()) == (8, 6, 1)
    assert set(events.columns) == {*schemas.EVENT_COLUMNS, "CORE_DAY"}
    assert set(mapping.columns) == {*schemas.MAPPING_COLUMN_TYPES, "CORE_DAY"}
    day = events.first()["CORE_DAY"]
    lookup = readers.read_clustered(spark, f"{sink.root}/events", ["used"], day, day).where(F.col("CORE_TIME") > "0")
    assert lookup.count() == 6
    scan = next(x for x in executed_plan(lookup).splitlines() if "FileScan" in x)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "METRIC_NAME" in filters and "CORE_DAY" in filters and "GreaterThan(CORE_TIME" in scan
    assert incidents.columns == list(schemas.INCIDENT_COLUMN_TYPES)
    got = rows(mapping.distinct(), "TARGET_ID", "CORE_TIME_NUM", "INCIDENT_ID", "INC_EVENT_TIME_DIFF", "HAS_MAPPED_INCIDENT")
    assert got == sorted([("t1", at, "i1", 10, 1), ("t1", at - 60, "i1", 70, None), ("t2", at, None, None, None)], key=repr)

    run_profiles(events, str(tmp_path / "profiles"))
    assert set(settled_files(spark)) == left
    profiles = spark.read.option("header", True).csv(str(tmp_path / "profiles"))
    assert rows(profiles, "METRIC_NAME", "level", "group_key", "count") == [
        ("PctFree", "client", "b2", "2"), ("PctFree", "device", "r2", "2"),
        ("used", "client", "q1", "6"), ("used", "device", "r1", "6"), ("used", "site", "S1", "6"),
    ]
    run_training_set(mapping, str(tmp_path / "week"))
    week = spark.read.option("header", True).csv(str(tmp_path / "week"))
    assert week.count() == 6 and rows(week.where("used_VALUE = '5.0'"), "HAS_NEIGHBOR_INCIDENT") == [("true",)] * 4
    run_top_talkers(incidents, config.incident_start, config.incident_end, str(tmp_path / "talkers"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "talkers")).collect()] == [("r1", "1")]
    run_device_extract(spark, [log], ["t2"], str(tmp_path / "devices"), partitions=2)
    assert rows(readers.read_header_series(spark, str(tmp_path / "devices")), "target_id", "measured_value") == [("t2", 5.0)]
    run_thresholds(
        readers.extract_devices(spark, [log], ["t1"]), str(tmp_path / "thresholds")
    )
    assert spark.read.option("header", True).csv(str(tmp_path / "thresholds")).first()["threshold"] == "5.0"
