"""Which alarm led to which incident, and which events are near a mapped one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opstelemetry.functions.scalar import epoch_col
from opstelemetry.functions.scale import BROADCAST_BYTES, lookup_join, measured_bytes, settle
from opstelemetry.operators.filters import mapped, time_diff

_INCIDENT_KEYS = ["RECON_ID_INC", "EVENT_CODE_INC"]


def _bin(seconds: Column | str, width: int) -> Column:
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.floor(c / F.lit(width))


def with_core_number(alarms: DataFrame) -> DataFrame:
    """Alarms with their core time as a number."""
    return alarms.withColumn("CORE_TIME_NUM", epoch_col("CORE_TIME")).drop("CORE_TIME")


def interval_match(
    alarms: DataFrame, incidents: DataFrame, seconds: int = 14400, binned: bool = True
) -> DataFrame:
    """Alarms with every incident of their device and code in the next ``seconds``.

    Unmatched alarms stay, with NULL incident columns. When binned, time is cut into slots as
    long as the interval: an alarm sits in its own slot, an incident in its own and the one
    before, so every pair meets in one slot and a hot (device, code) is spread over time.
    """
    right = incidents.drop("BUS_ID", "Is_Source_Monitor")
    left = alarms.drop("BUS_ID")
    diff = time_diff()
    match = (
        (F.col("RECON_ID") == F.col("RECON_ID_INC"))
        & (F.col("EVENT_CODE") == F.col("EVENT_CODE_INC"))
        & diff.between(0, seconds)
    )
    if binned:
        own = _bin("SUBMIT_DATE_NUM", seconds)
        right = right.withColumn("__slot_inc", F.explode(F.array(own, own - 1)))
        left = left.withColumn("__slot", _bin("CORE_TIME_NUM", seconds))
        match = match & (F.col("__slot") == F.col("__slot_inc"))
    pairs = left.join(right, match, "left").drop(*_INCIDENT_KEYS, "__slot", "__slot_inc")
    return pairs.withColumn("INC_EVENT_TIME_DIFF", diff)


def nearest_alarm(alarms: DataFrame, incidents: DataFrame, seconds: int = 14400) -> DataFrame:
    """A2: ``NEAREST_DIFF`` per (INCIDENT_ID, RECON_ID_INC) that has an alarm in its interval.

    Works on distinct seconds: the last alarm second at or before each submit second is found
    in slots as long as the interval, so a window never holds more than three slots' seconds.
    """
    keys = ["recon", "code"]
    alarm_seconds = alarms.select(
        F.col("RECON_ID").alias("recon"),
        F.col("EVENT_CODE").alias("code"),
        F.col("CORE_TIME_NUM").alias("at"),
    ).distinct()
    submit_seconds = incidents.select(
        F.col("RECON_ID_INC").alias("recon"),
        F.col("EVENT_CODE_INC").alias("code"),
        F.col("SUBMIT_DATE_NUM").alias("at"),
    ).distinct()
    own = _bin("at", seconds)
    timeline = alarm_seconds.select(
        *keys, "at", own.alias("slot"), F.col("at").alias("alarm"), F.lit(0).alias("kind")
    ).unionByName(
        submit_seconds.select(
            *keys,
            "at",
            F.explode(F.array(own, own - 1)).alias("slot"),
            F.lit(None).cast("bigint").alias("alarm"),
            F.lit(1).alias("kind"),
        )
    )
    so_far = (
        W.partitionBy(*keys, "slot").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    )
    last = (
        timeline.withColumn("alarm", F.last("alarm", ignorenulls=True).over(so_far))
        .where(F.col("kind") == 1)
        .groupBy(*keys, "at")
        .agg(F.max("alarm").alias("alarm"))
        .where(F.col("at") - F.col("alarm") <= seconds)
    )
    joined = incidents.join(
        last,
        (F.col("RECON_ID_INC") == F.col("recon"))
        & (F.col("EVENT_CODE_INC") == F.col("code"))
        & (F.col("SUBMIT_DATE_NUM") == F.col("at")),
        "inner",
    )
    return joined.groupBy("INCIDENT_ID", "RECON_ID_INC").agg(
        F.min(F.col("at") - F.col("alarm")).alias("NEAREST_DIFF")
    )


def _flag(pairs: DataFrame) -> DataFrame:
    nearest = F.col("INC_EVENT_TIME_DIFF") == F.col("NEAREST_DIFF")
    return pairs.withColumns(
        {
            "MIN_DIFF": F.when(nearest, F.col("NEAREST_DIFF")),
            "HAS_MAPPED_INCIDENT": F.when(nearest, F.lit(1)),
        }
    ).drop("NEAREST_DIFF")


def correlate(alarms: DataFrame, incidents: DataFrame, seconds: int = 14400) -> DataFrame:
    """J9 + J10: the event-incident mapping.

    The smallest distance of each incident is found before the wide join and travels with the
    incident, so the joined rows are not shuffled again to be flagged.
    """
    nearest = nearest_alarm(alarms, incidents, seconds).select(
        F.col("INCIDENT_ID").alias("__incident"), F.col("RECON_ID_INC").alias("__recon"), "NEAREST_DIFF"
    )
    known = incidents.join(
        nearest,
        (F.col("INCIDENT_ID") == F.col("__incident")) & (F.col("RECON_ID_INC") == F.col("__recon")),
        "left",
    ).drop("__incident", "__recon")
    return _flag(interval_match(alarms, known, seconds))


def flag_nearest(mapping: DataFrame) -> DataFrame:
    """Flag the nearest alarms of each (incident, device) in a given mapping.

    Ties are all flagged. The mapping is evaluated once: it is settled without the keys of unmatched
    alarms, so their common NULL never gathers in one task, the least distance of each key combines
    before its shuffle, and the rows look it up.
    """
    matched = F.coalesce(F.col("SUBMIT_DATE_NUM") != 0, F.lit(False)) & F.col("INCIDENT_ID").isNotNull()
    rows = settle(mapping.withColumn("__key", F.when(matched, F.col("INCIDENT_ID"))))
    nearest = (
        rows.where(F.col("__key").isNotNull())
        .groupBy(F.col("__key").alias("__incident"), F.col("RECON_ID").alias("__recon"))
        .agg(F.min("INC_EVENT_TIME_DIFF").alias("NEAREST_DIFF"))
    )
    return _flag(lookup_join(rows, settle(nearest), {"__key": "__incident", "RECON_ID": "__recon"}).drop("__key"))


def neighbour_label(
    mapping: DataFrame,
    radius: int = 3600,
    label_mode: str = "faithful",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Label events by mapped events of the same device and metric nearby.

    ``faithful`` gives an event one row per outcome among its mapped partners: True when one
    lies within the radius, False when one lies outside or there is none. ``any`` gives one
    row, True when any is near.

    Time is cut into slots as long as the radius. A mapped event in the same slot is always
    near; of the slot before only the last can be, of the slot after only the first. So three
    numbers per slot and two per key decide the label, and no pairs are formed.
    """
    if label_mode not in ("faithful", "any"):
        raise ValueError("label_mode must be 'faithful' or 'any'")
    keys = ["RECON_ID", "METRIC_NAME"]
    seen = mapped(mapping).select(*keys, "POLLER_TIME", _bin("POLLER_TIME", radius).alias("slot"))
    slots = settle(
        seen.groupBy(*keys, "slot").agg(
            F.min("POLLER_TIME").alias("first"),
            F.max("POLLER_TIME").alias("last"),
            F.count_if(F.col("POLLER_TIME").isNull()).alias("undated"),
        )
    )
    # Each slot becomes at most three rows of the first lookup, and one of the second.
    size = {"broadcast_bytes": broadcast_bytes, "dim_bytes": 3 * measured_bytes(slots)}
    none = F.lit(None).cast("bigint")
    spread = F.array(
        F.struct(F.col("slot"), F.lit(True).alias("same"), none.alias("before"), none.alias("after")),
        F.struct((F.col("slot") + 1).alias("slot"), F.lit(False).alias("same"), F.col("last").alias("before"), none.alias("after")),
        F.struct((F.col("slot") - 1).alias("slot"), F.lit(False).alias("same"), none.alias("before"), F.col("first").alias("after")),
    )
    near = (
        slots.where(F.col("slot").isNotNull())
        .select(*[F.col(k).alias(f"__n_{k}") for k in keys], F.inline(spread))
        .groupBy(*[f"__n_{k}" for k in keys], F.col("slot").alias("__n_slot"))
        .agg(
            F.bool_or("same").alias("__same"),
            F.max("before").alias("__before"),
            F.min("after").alias("__after"),
        )
    )
    extent = slots.groupBy(*[F.col(k).alias(f"__e_{k}") for k in keys]).agg(
        F.min("first").alias("__first"),
        F.max("last").alias("__last"),
        F.sum("undated").alias("__undated"),
    )
    rows = mapping.withColumn("__slot", _bin("POLLER_TIME", radius))
    rows = lookup_join(
        rows,
        near,
        {**{k: f"__n_{k}" for k in keys}, "__slot": "__n_slot"},
        null_safe=True,
        **size,
    )
    t = F.col("POLLER_TIME")
    inside = F.coalesce(
        F.col("__same") | (t - F.col("__before") < radius) | (F.col("__after") - t < radius), F.lit(False)
    )
    added = ["__slot", "__same", "__before", "__after"]
    if label_mode == "any":
        return rows.withColumn("HAS_NEIGHBOR_INCIDENT", inside).drop(*added)
    rows = lookup_join(rows, extent, {k: f"__e_{k}" for k in keys}, null_safe=True, **size)
    outside = F.coalesce(
        (t - F.col("__first") >= radius) | (F.col("__last") - t >= radius) | (F.col("__undated") > 0),
        F.lit(False),
    )
    labels = F.array_compact(
        F.array(F.when(inside, F.lit(True)), F.when(outside | ~inside, F.lit(False)))
    )
    return rows.withColumn("HAS_NEIGHBOR_INCIDENT", F.explode(labels)).drop(
        *added, "__first", "__last", "__undated"
    )
