"""Analysis parameters and the session settings the operators rely on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# Metric names, site spellings and device ids of the monitored estate.
TARGET_METRICS = (
    "LDldDiskTimePercent",
    "dskPercent",
    "utilization",
    "PctTotal",
    "PctFree",
    "used",
    "LDldFreeSpacePct",
    "UsedMBPct",
)
PROFILED_METRICS = (
    "used",
    "LDldFreeSpacePct",
    "utilization",
    "dskPercent",
    "PctFree",
    "PctTotal",
)
SPARSE_FEATURES = (
    "LDldDiskTimePercent_VALUE",
    "LDldFreeSpacePct_VALUE",
    "UsedMBPct_VALUE",
)
PROFILE_SITE_SPELLINGS = {"MMSB400MinutemanRd": "MM400MinutemanRd"}
TRAINING_SITE_SPELLINGS = {
    "MMSB400MinutemanRd": "MM400MinutemanRd",
    "MM400MinutemanRoad": "MM400MinutemanRd",
    "SCCA1302805LafayetteSt": "SCCALafayetteSt",
    "SCCA1202805LafayetteSt": "SCCALafayetteSt",
    "SCCA1102805LafayetteSt": "SCCALafayetteSt",
}
SERIES_DEVICES = ("2421540", "1640315", "1833973", "1478336")


@dataclass(frozen=True)
class Config:

    incident_start: int = 1567900800
    incident_end: int = 1568592000
    match_seconds: int = 14400
    neighbour_seconds: int = 3600
    hour_seconds: int = 3600
    value_ceiling: float = 105.0
    iqr_multiplier: float = 1.5
    top_clients: int = 150
    top_talkers: int = 20
    lookback: int = 10
    horizons: int = 3
    tolerance: float = 5.0
    log_partitions: int | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators assume.

    Epochs are rendered and bucketed in UTC. Shuffle joins keep hot keys in check through
    adaptive skew splitting, which is forced even where it costs an extra shuffle. Folder names of
    laid-out tables stay text, so days compare as written.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark
