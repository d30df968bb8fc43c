"""The monitoring data set's tables, derived from the order and event tables given for tests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opstelemetry.config import configure
from opstelemetry.operators.enrich import Dimensions, enrich_events, prepare_incidents
from opstelemetry.plans.etl import mapping_of

WINDOW_START = 1704240000  # 2024-01-03
WINDOW_END = 1706140800  # 2024-01-25

# Metric of an event by its type, for an even and an odd second digit of k.
METRIC_OF = {
    "click": ("utilization", "LDldDiskTimePercent"),
    "view": ("PctFree", "PctTotal"),
    "purchase": ("used", "UsedMBPct"),
    "signup": ("dskPercent", "LDldFreeSpacePct"),
}


def _text(c: Column) -> Column:
    return c.cast("string")


@dataclass(frozen=True)
class StandIn:

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        configure(self.spark)

    @cache
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events_raw(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"),
            F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        )

    @cached_property
    def event_log(self) -> DataFrame:
        k = F.col("k")
        metric: Column = F.lit(None).cast("string")
        for kind, (even, odd) in METRIC_OF.items():
            by_digit = F.when(F.floor(k / 10) % 2 == 0, even).otherwise(odd)
            metric = F.when(F.col("event_type") == kind, by_digit).otherwise(metric)
        return self.events_raw.where(F.col("event_type") != "error").select(
            F.concat(F.lit("D"), _text(k % 3)).alias("destination"),
            _text(F.col("t")).alias("core_time"),
            _text(F.col("t") + k % 60).alias("poller_time"),
            _text(F.col("user_id")).alias("target_id"),
            F.concat(F.lit("P"), _text(k % 7)).alias("policy_id"),
            F.when(F.floor(k / 3) % 4 == 0, "S").otherwise("T").alias("policy_type"),
            _text(k % 3).alias("detected_severity"),
            _text(k % 5).alias("propagated_severity"),
            F.lit("0").alias("low_threshold"),
            _text(F.col("value")).alias("measured_value"),
            F.lit("100").alias("high_threshold"),
            _text(k % 2).alias("propagated_flag"),
            _text(k % 2).alias("event_code"),
            F.when(k == 98, "Started").otherwise(metric).alias("metric_name"),
        )

    @cached_property
    def device(self) -> DataFrame:
        key = _text(F.col("c_custkey"))
        return self.table("customer").select(
            key.alias("DEVICE_TARGET_ID"), F.concat(F.lit("C"), key).alias("RECON_ID")
        )

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer").select(
            F.concat(F.lit("C"), _text(F.col("c_custkey"))).alias("RECONCILIATION_ID"),
            F.concat(F.lit("N"), _text(F.col("c_nationkey"))).alias("BUS_ID"),
        )

    @cached_property
    def bus_parent(self) -> DataFrame:
        return (
            self.table("nation")
            .where(F.col("n_nationkey") % 2 == 0)
            .select(
                F.concat(F.lit("R"), _text(F.col("n_regionkey"))).alias("PARENT_BUS_ID"),
                F.concat(F.lit("N"), _text(F.col("n_nationkey"))).alias("HIER_BUS_ID"),
            )
        )

    @cached_property
    def top_clients(self) -> DataFrame:
        own = self.customer.select(F.col("BUS_ID").alias("NEW_BUS_ID"))
        parents = self.customer.join(
            self.bus_parent, F.col("BUS_ID") == F.col("HIER_BUS_ID"), "inner"
        ).select(F.col("PARENT_BUS_ID").alias("NEW_BUS_ID"))
        return (
            own.unionByName(parents)
            .groupBy("NEW_BUS_ID")
            .agg(F.count(F.lit(1)).alias("NUM_CUST_DEVICES"))
            .orderBy(F.desc("NUM_CUST_DEVICES"), "NEW_BUS_ID")
            .limit(10)
        )

    @cached_property
    def device_location(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
            .where(F.col("c_custkey") % 10 != 9)
            .select(
                F.concat(F.lit("N"), _text(F.col("c_nationkey"))).alias("BUS_ID_DEV"),
                F.col("c_mktsegment").alias("DEVICE_TYPE"),
                F.concat(F.lit("OS"), _text(F.col("c_custkey") % 4)).alias("OPERATING_SYSTEM"),
                F.concat(F.lit("C"), _text(F.col("c_custkey"))).alias("RECONCILIATION_ID"),
                F.col("n_name").alias("SITE"),
                F.when(F.col("c_custkey") % 3 == 0, "Y").otherwise("N").alias("IS_VIRTUAL"),
            )
        )

    @cached_property
    def parent_monitor(self) -> DataFrame:
        part = self.table("part")
        child = _text(F.col("p_partkey")).alias("CHILD_TARGET_ID")
        return part.select(F.col("p_brand").alias("PARENT_TARGET_ID"), child).unionByName(
            part.where(F.col("p_size") % 5 == 0).select(F.col("p_type").alias("PARENT_TARGET_ID"), child)
        )

    @cached_property
    def monitor_type(self) -> DataFrame:
        return self.table("part").select(
            _text(F.col("p_partkey")).alias("MONITOR_ID"), F.col("p_type").alias("MONITOR_DESC")
        )

    @cached_property
    def dimensions(self) -> Dimensions:
        return Dimensions(
            device=self.device,
            customer=self.customer,
            bus_parent=self.bus_parent,
            top_clients=self.top_clients,
            device_location=self.device_location,
            parent_monitor=self.parent_monitor,
            monitor_type=self.monitor_type,
        )

    @cached_property
    def incident(self) -> DataFrame:
        k = F.col("k")
        return self.events_raw.where(F.col("event_type") == "error").select(
            _text(F.col("event_id")).alias("INCIDENT_ID"),
            _text(F.col("t")).alias("SUBMIT_DATE"),
            F.concat(F.lit("N"), _text(F.col("user_id") % 25)).alias("BUS_ID"),
            _text(k % 2).alias("EVENT_CODE"),
            F.when(k % 7 == 0, "Other").when(k % 7 != 1, "Monitor").alias("submitter"),
        )

    @cached_property
    def incident_device(self) -> DataFrame:
        errors = self.events_raw.where(F.col("event_type") == "error")
        listed = F.array_compact(
            F.array(F.col("user_id"), F.when(F.col("k") % 11 == 0, F.col("user_id") + 1))
        )
        return errors.select(
            _text(F.col("event_id")).alias("INCIDENT_DEV_ID"), F.explode(listed).alias("device")
        ).select("INCIDENT_DEV_ID", F.concat(F.lit("C"), _text(F.col("device"))).alias("RECON_ID"))

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich_events(self.event_log, self.dimensions)

    @cached_property
    def incidents(self) -> DataFrame:
        return prepare_incidents(self.incident, self.incident_device, WINDOW_START, WINDOW_END)

    @cached_property
    def mapping(self) -> DataFrame:
        return mapping_of(self.enriched, self.incidents).withColumn(
            "POLLER_TIME", F.col("POLLER_TIME").cast("bigint")
        )

    def series(self) -> DataFrame:
        """Readings of every event: time, target, metric and value."""
        return self.events_raw.select(
            F.col("t").alias("poller_time"),
            _text(F.col("user_id")).alias("target_id"),
            F.col("value").alias("measured_value"),
            F.col("event_type").alias("metric_name"),
        )

    def device_series(self, seconds: int) -> DataFrame:
        """Event types as devices, in three series, averaged per time slot."""
        return self.events_raw.select(
            (F.floor(F.col("t") / seconds) * seconds).alias("poller_time"),
            F.col("event_type").alias("target_id"),
            F.col("value").alias("measured_value"),
            (F.col("user_id") % 3).alias("shard"),
        )


@cache
def stand_in(spark: SparkSession, sf_dir: str) -> StandIn:
    """The entities of one session and folder, planned once. No data is kept."""
    return StandIn(spark, sf_dir)
