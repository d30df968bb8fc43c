"""Time the headline queries, and the direct forms of those that were restated.

Prints one JSON line. ``value`` is the time of the engine's own queries; ``direct_*`` entries
show the same results computed the plain way (OR join, self joins, a pass per grouping).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opstelemetry.config import PROFILED_METRICS
from opstelemetry.functions.scale import settle
from opstelemetry.operators import correlate as R
from opstelemetry.operators import distribution as D
from opstelemetry.operators import enrich as E
from opstelemetry.operators import features as X
from opstelemetry.operators import filters as P
from opstelemetry.plans import catalog
from opstelemetry.plans.standin import StandIn, stand_in

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def direct_top_clients(s: StandIn) -> DataFrame:
    rows = E.join_bus_parent(E.join_customer(E.join_device(s.event_log, s.device), s.customer), s.bus_parent)
    either = (F.col("BUS_ID") == F.col("NEW_BUS_ID")) | (F.col("PARENT_BUS_ID") == F.col("NEW_BUS_ID"))
    return rows.join(s.top_clients, either, "inner")


def direct_nearest(alarms: DataFrame, incidents: DataFrame) -> DataFrame:
    pairs = R.interval_match(alarms, incidents, binned=False)
    least = (
        pairs.where("SUBMIT_DATE_NUM != 0")
        .groupBy(F.col("INCIDENT_ID").alias("i"), F.col("RECON_ID").alias("r"))
        .agg(F.min("INC_EVENT_TIME_DIFF").alias("MIN_DIFF"), F.lit(1).alias("HAS_MAPPED_INCIDENT"))
    )
    on = (F.col("INC_EVENT_TIME_DIFF") == F.col("MIN_DIFF")) & (F.col("RECON_ID") == F.col("r"))
    return pairs.join(least, on & (F.col("INCIDENT_ID") == F.col("i")), "left").drop("i", "r")


def direct_neighbours(mapping: DataFrame) -> DataFrame:
    rows = mapping.withColumn("idx", F.monotonically_increasing_id())
    seen = P.mapped(mapping).select(
        F.col("POLLER_TIME").alias("at"), F.col("RECON_ID").alias("r"), F.col("METRIC_NAME").alias("m")
    ).distinct()
    near = P.is_neighbour(F.col("POLLER_TIME") - F.col("at"))
    joined = rows.join(seen, (F.col("RECON_ID") == F.col("r")) & (F.col("METRIC_NAME") == F.col("m")), "left")
    return joined.withColumn("HAS_NEIGHBOR_INCIDENT", near).drop("at", "r", "m").distinct()


def direct_profiles(events: DataFrame) -> list[DataFrame]:
    out = []
    for metric in PROFILED_METRICS:
        rows = P.valid_values(P.only(events, "METRIC_NAME", [metric]))
        ps = F.array(*[F.lit(p / 100) for p in D.PERCENTILES])
        for column in D.LEVELS.values():
            out.append(
                rows.groupBy(column).agg(
                    F.mean("MEASURED_VALUE"), F.count("MEASURED_VALUE"), F.stddev("MEASURED_VALUE"),
                    F.percentile("MEASURED_VALUE", ps),
                )
            )
    return out


def skewed_mapping(s: StandIn) -> DataFrame:
    """Every event as a mapping row, a third of them under one device and metric."""
    hot = F.col("event_id") % 3 == 0
    return s.events_raw.select(
        F.when(hot, "hot").otherwise(F.col("user_id").cast("string")).alias("RECON_ID"),
        F.lit("used").alias("METRIC_NAME"),
        F.col("t").alias("POLLER_TIME"),
        F.when(F.col("k") < 5, 1).alias("HAS_MAPPED_INCIDENT"),
    )


def skewed_alarms(s: StandIn) -> tuple[DataFrame, DataFrame]:
    """Alarms and incidents of which a third share one device and code."""
    hot = F.col("event_id") % 3 == 0
    rows = s.events_raw.withColumn("r", F.when(hot, "hot").otherwise(F.col("user_id").cast("string")))
    alarms = rows.where("event_type != 'error'").select(
        F.col("r").alias("RECON_ID"), F.lit("c").alias("EVENT_CODE"), F.col("t").alias("CORE_TIME_NUM"),
        F.lit("b").alias("BUS_ID"), "event_id",
    )
    incidents = rows.where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("INCIDENT_ID"), F.lit("b").alias("BUS_ID"),
        F.lit("c").alias("EVENT_CODE_INC"), F.col("r").alias("RECON_ID_INC"), F.lit(1).alias("Is_Source_Monitor"),
        F.col("t").alias("SUBMIT_DATE_NUM"),
    )
    return alarms, incidents


def run(make) -> float:
    start = time.time()
    made = make()
    for df in made if isinstance(made, list) else [made]:
        df.write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    s = stand_in(spark, SF_DIR)
    alarms = settle(R.with_core_number(P.alarms(s.enriched)))
    incidents = settle(s.incidents)
    mapping = settle(s.mapping)
    events = settle(s.enriched)
    skewed = settle(skewed_mapping(s))
    hot_alarms, hot_incidents = (settle(df) for df in skewed_alarms(s))

    own = {
        "flagship_mapping": lambda: catalog.event_incident_nearest(spark, SF_DIR),
        "enrich_chain": lambda: s.enriched,
        "top_client_join": lambda: catalog.top_client_or_join(spark, SF_DIR),
        "nearest_match": lambda: R.correlate(alarms, incidents),
        "neighbour_label": lambda: R.neighbour_label(mapping),
        "skewed_nearest_match": lambda: R.correlate(hot_alarms, hot_incidents),
        "skewed_neighbour_label": lambda: R.neighbour_label(skewed),
        "metric_profiles": lambda: D.metric_profiles(events),
        "metric_profile_lineitem": lambda: catalog.metric_profile_lineitem(spark, SF_DIR),
        "metric_profile_split": lambda: catalog.metric_profile_split(spark, SF_DIR),
        "seasonal_profile": lambda: catalog.seasonal_profile(spark, SF_DIR),
        "iqr_threshold": lambda: catalog.iqr_threshold(spark, SF_DIR),
        "hourly_features": lambda: X.hourly_features(mapping, incidents),
        "training_set": lambda: X.neighbour_training_set(mapping),
        "client_rank": lambda: catalog.customer_order_rank(spark, SF_DIR),
        "forecast_windows": lambda: catalog.forecast_windows(spark, SF_DIR),
        "pr_curve": lambda: catalog.pr_curve(spark, SF_DIR),
    }
    direct = {
        "direct_top_client_join": lambda: direct_top_clients(s),
        "direct_nearest_match": lambda: direct_nearest(alarms, incidents),
        "direct_neighbour_label": lambda: direct_neighbours(mapping),
        "direct_skewed_nearest_match": lambda: direct_nearest(hot_alarms, hot_incidents),
        "direct_skewed_neighbour_label": lambda: direct_neighbours(skewed),
        "direct_metric_profiles": lambda: direct_profiles(events),
    }
    times = {}
    for name, make in {**own, **direct}.items():
        run(make)
        times[name] = round(run(make), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times[n] for n in own), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
