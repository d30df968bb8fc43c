"""Registered queries: each runs operators over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opstelemetry import schemas
from opstelemetry.functions.scalar import fmt_time, hour_bucket, hour_of, weekday_of
from opstelemetry.functions.scalar import push_window as push
from opstelemetry.functions.scale import new_folder, settle
from opstelemetry.operators import classify as C
from opstelemetry.operators import clients as K
from opstelemetry.operators import correlate as R
from opstelemetry.operators import distribution as D
from opstelemetry.operators import enrich as E
from opstelemetry.operators import features as X
from opstelemetry.operators import filters as P
from opstelemetry.operators import forecast as T
from opstelemetry.operators import series as S
from opstelemetry.plans.analysis import forecast_wide, score_other_week, train_full, train_hourly, train_single
from opstelemetry.plans.etl import ParquetSink
from opstelemetry.plans.standin import WINDOW_END, WINDOW_START, stand_in
from opstelemetry.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# Spellings of the stand-in sites, one of them merged into another.
SITE_SPELLINGS = {"NATION1": "NATION0", "NATION3": "NATION2"}
HOUR = 3600
SLOT = 4 * HOUR
FINE_SLOT = 600
# The events' month is cut into two training periods here (2024-01-16).
SECOND_WEEK = 1705363200


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to few digits; the nudge makes exact halves round alike in all engines."""
    return df.select(
        *[
            F.round(F.col(c) + 1e-9, digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def stamp(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that engines compare alike."""
    return df.select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kind == "timestamp" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def policy_alarm_filter(spark: SparkSession, sf: str) -> DataFrame:
    return P.alarms(P.policy_filter(stand_in(spark, sf).event_log))


def site_clean(spark: SparkSession, sf: str) -> DataFrame:
    sites = P.with_clean_site(stand_in(spark, sf).device_location)
    return P.canonical_site(sites, SITE_SPELLINGS).select("RECONCILIATION_ID", "SITE", "SITE_DESC")


def incident_window(spark: SparkSession, sf: str) -> DataFrame:
    return stamp(stand_in(spark, sf).incidents)


def enrich_chain(spark: SparkSession, sf: str) -> DataFrame:
    return stamp(stand_in(spark, sf).enriched)


def top_client_or_join(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    rows = E.join_customer(E.join_device(s.event_log, s.device), s.customer)
    rows = E.join_top_clients(E.join_bus_parent(rows, s.bus_parent), s.top_clients)
    return rows.select(
        "target_id", "core_time", "metric_name", "RECON_ID", "BUS_ID", "PARENT_BUS_ID", "NEW_BUS_ID", "NUM_CUST_DEVICES"
    )


_PAIR_COLUMNS = (
    "TARGET_ID",
    "METRIC_NAME",
    "RECON_ID",
    "EVENT_CODE",
    "NEW_BUS_ID",
    "PARENT_TARGET_ID",
    "CORE_TIME_NUM",
    "INCIDENT_ID",
    "SUBMIT_DATE_NUM",
    "INC_EVENT_TIME_DIFF",
)


def _interval(spark: SparkSession, sf: str, binned: bool) -> DataFrame:
    s = stand_in(spark, sf)
    found = R.with_core_number(P.alarms(s.enriched))
    return R.interval_match(found, s.incidents, binned=binned)


def event_incident_interval(spark: SparkSession, sf: str) -> DataFrame:
    return _interval(spark, sf, binned=False).select(*_PAIR_COLUMNS)


def event_incident_binned(spark: SparkSession, sf: str) -> DataFrame:
    return _interval(spark, sf, binned=True).select(*_PAIR_COLUMNS)


def event_incident_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return stand_in(spark, sf).mapping.select(*_PAIR_COLUMNS, "MIN_DIFF", "HAS_MAPPED_INCIDENT")


def event_incident_flagged(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _interval(spark, sf, binned=True)
    return R.flag_nearest(pairs).select(*_PAIR_COLUMNS, "MIN_DIFF", "HAS_MAPPED_INCIDENT")


def matched_incidents(spark: SparkSession, sf: str) -> DataFrame:
    return (
        P.matched(_interval(spark, sf, binned=True))
        .groupBy("INCIDENT_ID", "RECON_ID")
        .agg(F.min("INC_EVENT_TIME_DIFF").alias("min_diff"), F.count(F.lit(1)).alias("pairs"))
    )


def client_device_rank(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    counts = K.device_count(K.client_rollup(s.customer, s.bus_parent))
    return rounded(K.top_clients(K.client_rank(counts), 150))


def customer_order_rank(spark: SparkSession, sf: str) -> DataFrame:
    orders = stand_in(spark, sf).table("orders")
    counts = K.device_count(
        orders.select(F.col("o_custkey").cast("string").alias("client"), "o_orderkey"), "client", "o_orderkey"
    )
    return rounded(K.client_rank(counts))


def top_talkers(spark: SparkSession, sf: str) -> DataFrame:
    return K.top_talkers(stand_in(spark, sf).incidents, WINDOW_START, WINDOW_END, 20)


def metric_profile(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    values = P.valid_values(s.series().withColumnRenamed("measured_value", "MEASURED_VALUE"))
    return rounded(D.metric_profile(values, ["metric_name", "target_id"]))


def metric_profile_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = stand_in(spark, sf).table("lineitem")
    return rounded(D.metric_profile(lines, ["l_returnflag", "l_suppkey"], "l_extendedprice"))


def metric_profile_split(spark: SparkSession, sf: str) -> DataFrame:
    lines = stand_in(spark, sf).table("lineitem")
    return rounded(D.metric_profile(lines, ["l_returnflag"], "l_extendedprice"))


def metric_profile_levels(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(D.metric_profiles(stand_in(spark, sf).enriched, spellings=SITE_SPELLINGS))


def seasonal_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(D.seasonal_profile(stand_in(spark, sf).series()))


def iqr_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(D.iqr_threshold(D.seasonal_profile(stand_in(spark, sf).series())))


def iqr_threshold_floored(spark: SparkSession, sf: str) -> DataFrame:
    profile = D.seasonal_profile(stand_in(spark, sf).series())
    return rounded(D.iqr_threshold(profile, floor={"view": 95.0}))


def _neighbours(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    rows = R.neighbour_label(stand_in(spark, sf).mapping, label_mode=mode)
    return rows.select(
        "RECON_ID", "METRIC_NAME", "POLLER_TIME", "NEW_BUS_ID", "PARENT_TARGET_ID", "INCIDENT_ID",
        "HAS_MAPPED_INCIDENT", F.col("HAS_NEIGHBOR_INCIDENT").cast("int").alias("HAS_NEIGHBOR_INCIDENT"),
    )


def neighbour_label(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(spark, sf, "faithful")


def neighbour_label_any(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(spark, sf, "any")


def neighbour_training_set(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.neighbour_training_set(stand_in(spark, sf).mapping, spellings=SITE_SPELLINGS)
    return rows.withColumn("HAS_NEIGHBOR_INCIDENT", F.col("HAS_NEIGHBOR_INCIDENT").cast("int"))


def hourly_features(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    rows = rounded(X.hourly_features(s.mapping, s.incidents))
    return rows.withColumn("HAS_MAPPED_INCIDENT_MERGED", F.col("HAS_MAPPED_INCIDENT_MERGED").cast("int"))


def hourly_spread(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    rows = rounded(X.hourly_training_set(s.mapping, s.incidents))
    return rows.withColumn("HAS_MAPPED_INCIDENT_MERGED", F.col("HAS_MAPPED_INCIDENT_MERGED").cast("int"))


def hourly_group_transform(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    joined = X.hourly_match(s.mapping, s.incidents)
    keys = ["RECON_ID", "METRIC_NAME", "POLLER_TIME_PERIOD_60_MIN"]
    value = F.col("MEASURED_VALUE").try_cast("double")
    rows = X.group_transform(
        joined.select(*keys, "POLLER_TIME", "INCIDENT_ID_y", "MEASURED_VALUE"),
        keys,
        {"MEAN": F.avg(value), "MAX": F.max(value), "MIN": F.min(value), "COUNT": F.count(value)},
    )
    return rounded(rows)


def first_reading(spark: SparkSession, sf: str) -> DataFrame:
    rows = stand_in(spark, sf).events_raw.withColumn("hour", F.floor(F.col("t") / HOUR))
    keys = ["user_id", "event_type", "hour"]
    return X.first_per_key(rows, keys, ["t", "event_id"]).select(*keys, "event_id", "t", "value")


def incident_coverage(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    return X.incident_coverage(X.hourly_match(s.mapping, s.incidents))


def metric_spread(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.valid_values(stand_in(spark, sf).enriched).select(
        "TARGET_ID", "POLLER_TIME", "METRIC_NAME", "NEW_BUS_ID", "MEASURED_VALUE"
    )
    return X.spread_values(X.metric_one_hot(rows))


def sparse_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.spread_values(P.valid_values(stand_in(spark, sf).enriched))
    return P.all_null(rows, ["LDldDiskTimePercent_VALUE", "LDldFreeSpacePct_VALUE", "UsedMBPct_VALUE"]).select(
        "TARGET_ID", "POLLER_TIME", "NEW_BUS_ID", "METRIC_NAME", "PctFree_VALUE", "utilization_VALUE"
    )


def _weeks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two training periods, by time."""
    rows = _training_rows(spark, sf)
    return rows.where(F.col("POLLER_TIME") < SECOND_WEEK), rows.where(F.col("POLLER_TIME") >= SECOND_WEEK)


@cache
def _mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping that both kinds of training rows are made of; labels read it twice."""
    return settle(stand_in(spark, sf).mapping)


@cache
def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return settle(X.neighbour_training_set(_mapping(spark, sf), spellings=SITE_SPELLINGS))


def _slot(vector: str) -> list[Column]:
    """Where a one-hot vector has its 1, and its length."""
    dense = vector_to_array(vector)
    at = F.nullif(F.array_position(dense, 1.0), F.lit(0))
    return [(at - 1).cast("bigint").alias("site_slot"), F.size(dense).alias("site_slots")]


def single_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The two periods, rows without a time in the second, and the whole month appended to them: every row twice."""
    rows = _training_rows(spark, sf)
    first = F.coalesce(F.col("POLLER_TIME") < SECOND_WEEK, F.lit(False))
    rows = X.clean_single([rows.where(first), rows.where(~first), rows], "PctFree")
    return rows.withColumn("HAS_NEIGHBOR_INCIDENT", F.col("HAS_NEIGHBOR_INCIDENT").cast("int"))


def full_feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.clean_full(_training_rows(spark, sf))
    rows = rows.withColumn("HAS_NEIGHBOR_INCIDENT", F.col("HAS_NEIGHBOR_INCIDENT").cast("int"))
    return rows.select(*[c for c in rows.columns if c != "SITE_HOT"], *_slot("SITE_HOT"))


def drop_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = stand_in(spark, sf).events_raw.select(
        "event_id",
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("k") > 90, F.col("value")).alias("partial"),
        "value",
    )
    some = P.drop_null_columns(rows, "all")
    none = P.drop_null_columns(rows, "any")
    return some.join(none.withColumnRenamed("value", "kept_value"), "event_id", "inner")


def _hourly_labels(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    return X.hourly_features(s.mapping, s.incidents).select(
        F.col("HAS_MAPPED_INCIDENT_MERGED").cast("int").alias("label")
    )


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return X.class_counts(_hourly_labels(spark, sf), "label")


def class_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.class_ratio(_hourly_labels(spark, sf), "label"))


def site_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    sites = P.with_clean_site(stand_in(spark, sf).device_location).select("RECONCILIATION_ID", "SITE")
    return X.site_one_hot(sites, X.site_index(sites)).select("RECONCILIATION_ID", *_slot("SITE_HOT"))


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = X.split(stand_in(spark, sf).events_raw, 0.67, keys=["event_id"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("event_id", "part")


def device_extract(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    chosen = P.only(s.event_log, "metric_name", ["utilization", "PctFree"]).select(
        "poller_time", "target_id", "measured_value", "metric_name"
    )
    rest = P.only(s.event_log, "metric_name", ["used"]).select("poller_time", "target_id", "metric_name")
    return P.append_frames(chosen, rest)


def time_parts(spark: SparkSession, sf: str) -> DataFrame:
    return stand_in(spark, sf).events_raw.select(
        "event_id",
        fmt_time("t").alias("text"),
        hour_of("t").cast("int").alias("hour"),
        weekday_of("t").cast("int").alias("weekday"),
        hour_bucket("t").alias("bucket"),
    )


def _steps(spark: SparkSession, sf: str, seconds: int) -> DataFrame:
    rows = stand_in(spark, sf).device_series(seconds)
    return S.number_steps(S.pivot_series(rows, EVENT_TYPES, group=["shard"]), ["shard"])


def _elements(name: str, count: int = len(EVENT_TYPES)) -> list[Column]:
    return [F.col(name)[i].alias(f"{name}_{i}") for i in range(count)]


def series_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_steps(spark, sf, HOUR).select("shard", "time", "step", "n_steps", *_elements("values")))


def lag_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = S.concat_pairs(S.lag_pairs(_steps(spark, sf, HOUR), ["shard"], block=64))
    return rounded(pairs.select("shard", "step", *_elements("xy", 2 * len(EVENT_TYPES))))


def forecast_windows(spark: SparkSession, sf: str) -> DataFrame:
    windows = S.forecast_windows(_steps(spark, sf, HOUR), ["shard"], block=64)
    past = [
        sum(F.coalesce(F.col("x")[j][i], F.lit(0.0)) * (j + 1) for j in range(10)).alias(f"x_{i}")
        for i in range(len(EVENT_TYPES))
    ]
    ahead = [F.col(f"y_{h}")[i].alias(f"y_{h}_{i}") for h in (1, 2, 3) for i in range(len(EVENT_TYPES))]
    return rounded(windows.select("shard", "window", F.size("x").alias("steps"), *past, *ahead), 4)


def push_window(spark: SparkSession, sf: str) -> DataFrame:
    windows = S.forecast_windows(_steps(spark, sf, HOUR), ["shard"])
    pushed = windows.withColumn("next", push("x", "y_1"))
    return rounded(pushed.select(
        "shard", "window", F.size("next").alias("steps"),
        F.col("next")[0][0].alias("oldest"), F.element_at("next", -1)[0].alias("newest"),
    ))


def chrono_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = S.chrono_split(_steps(spark, sf, HOUR), 0.99)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).select(
        "shard", "time", "step", "part"
    )


def _fixed_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Labels and made predictions of every event: error events scored by their k."""
    return stand_in(spark, sf).events_raw.select(
        (F.col("event_type") == "error").cast("int").alias("label"),
        (F.col("value") > 40).cast("int").alias("prediction"),
        (F.floor(F.least(F.col("value"), F.lit(512.0)) * 4) / 2048).alias("p_incident"),
    )


def confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.confusion(_fixed_scores(spark, sf))


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = _fixed_scores(spark, sf)
    both = C.confusion_metrics(scored, 1).withColumn("positive", F.lit(1)).unionByName(
        C.confusion_metrics(scored, 0).withColumn("positive", F.lit(0))
    )
    return rounded(both)


def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.pr_curve(_fixed_scores(spark, sf)))


def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.average_precision(_fixed_scores(spark, sf)))


def _fixed_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Windows with the mean of the past steps as every step's forecast."""
    windows = S.forecast_windows(_steps(spark, sf, SLOT), ["shard"])
    means = F.array(
        *[
            sum(F.coalesce(F.col("x")[j][i], F.lit(0.0)) for j in range(10)) / 10
            for i in range(len(EVENT_TYPES))
        ]
    )
    return windows.withColumns({f"pred_{h}": means for h in (1, 2, 3)})


def tolerance_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    table = T.compare_table(_fixed_forecasts(spark, sf), 3, group=["shard"])
    known = table.where(F.col("actual").isNotNull())
    accuracy = T.tolerance_accuracy(known)
    errors = T.mse(known).withColumnRenamed("horizon", "horizon_key")
    both = accuracy.join(errors, F.col("horizon") == F.col("horizon_key"), "inner")
    return rounded(both.drop("horizon_key"), 4)


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    table = T.compare_table(_fixed_forecasts(spark, sf), 3, group=["shard"])
    errors = table.groupBy(F.col("shard").alias("model_id")).agg(
        F.avg(F.pow(F.col("predicted") - F.col("actual"), 2)).alias("mse")
    )
    return rounded(T.best_model(errors), 4)


# -- files ---------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return new_folder(spark, name)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    path = _folder(spark, "customer")
    writers.write_csv(s.customer, path)
    return readers.read_dimension(spark, path, schemas.CUSTOMER)


def _log_files(spark: SparkSession, sf: str) -> str:
    """The event log as gzip files, with a line of too few fields for each event of one k, and one of too many for another."""
    s = stand_in(spark, sf)
    log = s.event_log
    good = log.select(F.concat_ws(",", *log.columns).alias("line"))
    short = s.events_raw.where("k = 13").select(F.concat(F.lit("cut,"), F.col("event_id").cast("string")).alias("line"))
    long = s.events_raw.where("k = 14").select(F.concat(F.lit("long"), F.repeat(F.lit(",x"), 14)).alias("line"))
    path = _folder(spark, "event_log")
    good.unionByName(short).unionByName(long).write.option("compression", "gzip").text(path)
    return path


def event_log_scan(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_event_log(spark, _log_files(spark, sf), partitions=8)


def event_log_rejects(spark: SparkSession, sf: str) -> DataFrame:
    lines = readers.scan_event_log(spark, _log_files(spark, sf), partitions=8)
    per_file = readers.malformed_lines(lines).agg(F.sum("malformed").alias("all_files"))
    counts = lines.where(F.col("_malformed").isNotNull()).groupBy(F.col("destination").alias("kind")).agg(F.count("_malformed").alias("n"))
    return counts.join(F.broadcast(per_file))  # one row


def etl_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Two metrics in ten days of the laid-out events table."""
    sink = ParquetSink(_folder(spark, "etl"))
    sink.put(stand_in(spark, sf).enriched, "events", "append", None)
    found = readers.read_clustered(spark, f"{sink.root}/events", ["utilization", "used"], "2024-01-05", "2024-01-14")
    return found.select("METRIC_NAME", "CORE_DAY", "CORE_TIME", "RECON_ID", "MEASURED_VALUE")


def appended_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two periods of incidents appended to one typed table."""
    incidents = stand_in(spark, sf).incidents
    path = _folder(spark, "appended")
    early = F.col("SUBMIT_DATE_NUM") < SECOND_WEEK
    for part in (incidents.where(early), incidents.where(~early)):
        writers.write_table(part, path, "append", schemas.INCIDENT_COLUMN_TYPES)
    return stamp(readers.read_table(spark, path))


def metric_subset(spark: SparkSession, sf: str) -> DataFrame:
    rows = readers.metric_subset(stand_in(spark, sf).enriched, ["utilization", "used", "absent"])
    return rows.select("METRIC_NAME", "RECON_ID", "CORE_TIME", "MEASURED_VALUE")


def clustered_table(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    path = _folder(spark, "clustered")
    writers.write_clustered(P.policy_filter(s.event_log), path, ["metric_name"], ["core_time", "target_id"])
    table = readers.read_table(spark, path)
    return P.only(table, "metric_name", ["utilization"]).select("metric_name", "core_time", "target_id")


def profile_files(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    path = _folder(spark, "profiles")
    writers.write_profiles(D.metric_profiles(s.enriched, spellings=SITE_SPELLINGS), path)
    rows = spark.read.option("header", True).csv(path)
    return rounded(rows.select(
        "METRIC_NAME", "level", "group_key", F.col("count").cast("bigint").alias("count"),
        *[F.col(c).cast("double").alias(c) for c in ("mean", "std", *[f"percentile_{p}" for p in D.PERCENTILES])],
    ))


def typed_table(spark: SparkSession, sf: str) -> DataFrame:
    s = stand_in(spark, sf)
    path = _folder(spark, "incidents")
    writers.write_table(s.incidents, path, "overwrite", schemas.INCIDENT_COLUMN_TYPES)
    return stamp(readers.read_table(spark, path))


def series_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "series")
    rows = stand_in(spark, sf).series().select(F.lit("row").alias("DeviceID"), "*")
    rows.write.mode("overwrite").csv(path)
    return readers.read_series(spark, path)


def header_series_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "header_series")
    writers.write_csv(stand_in(spark, sf).series().withColumn("unknown", F.lit("x")), path)
    return readers.read_header_series(spark, path)


def log_extract(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "header_log")
    writers.write_csv(stand_in(spark, sf).event_log, path)
    return readers.extract_devices(spark, path, ["7", "8", "46", "149"])


def metric_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return readers.metric_samples(stand_in(spark, sf).enriched, "utilization")


def feature_files(spark: SparkSession, sf: str) -> DataFrame:
    week = neighbour_training_set(spark, sf)
    path = _folder(spark, "features")
    writers.write_csv(week, path)
    return readers.read_features(spark, path, week.schema)


# -- learning ------------------------------------------------------------------------------


@cache
def _full_model(spark: SparkSession, sf: str) -> tuple[C.Classifier, DataFrame, DataFrame]:
    """The all-metric classifier, its scored hold-out and its confusion table of the second period, trained once a session."""
    week, other = _weeks(spark, sf)
    model, scored, _ = train_full(week)
    path = new_folder(spark, "model")
    model.save(path)
    # the other period is scored by a model that another run has saved
    return model, settle(scored), settle(score_other_week(C.load_classifier(spark, path, model.label), other))


@cache
def _single_scored(spark: SparkSession, sf: str) -> DataFrame:
    return settle(train_single(_weeks(spark, sf))[1])


@cache
def _hourly_scored(spark: SparkSession, sf: str) -> DataFrame:
    return settle(train_hourly(_mapping(spark, sf), stand_in(spark, sf).incidents)[1])


def gbt_confusion(spark: SparkSession, sf: str) -> DataFrame:
    _, scored, other = _full_model(spark, sf)
    return C.confusion(scored).withColumn("part", F.lit("hold-out")).unionByName(other.withColumn("part", F.lit("other week")))


def gbt_single_metric(spark: SparkSession, sf: str) -> DataFrame:
    return C.confusion_metrics(_single_scored(spark, sf))


def gbt_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return C.confusion_metrics(_hourly_scored(spark, sf))


def learner_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows per learner, part and true class; the predictions are those of the three queries before.

    The learners share their settled input and train side by side: each has some 1500 short jobs, which leave cores idle.
    """
    _training_rows(spark, sf)
    learners = (_full_model, _single_scored, _hourly_scored)
    with ThreadPoolExecutor(len(learners)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(learner), spark, sf) for learner in learners]:
            done.result()
    single, hourly = C.confusion(_single_scored(spark, sf)), C.confusion(_hourly_scored(spark, sf))
    cells = gbt_confusion(spark, sf).withColumn("learner", F.lit("all metrics"))
    cells = cells.unionByName(single.withColumns({"learner": F.lit("one metric"), "part": F.lit("hold-out")}))
    cells = cells.unionByName(hourly.withColumns({"learner": F.lit("hourly"), "part": F.lit("hold-out")}))
    return cells.groupBy("learner", "part", "label").agg(F.sum("n").alias("n"))


def importance(spark: SparkSession, sf: str) -> DataFrame:
    return C.importance(_full_model(spark, sf)[0], spark)


def tree_leaf_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows that reach the leaves of each tree, and the nodes that are neither leaf nor parent of two."""
    nodes = C.tree_nodes(_full_model(spark, sf)[0], spark)
    leaf = F.col("feature").isNull()
    return nodes.groupBy("tree").agg(
        F.sum(F.when(leaf, F.col("rows"))).alias("rows"),
        (F.count_if(leaf) - F.count_if(~leaf)).alias("leaves_beyond_splits"),
    )


def recursive_forecast(spark: SparkSession, sf: str) -> DataFrame:
    wide = S.pivot_series(stand_in(spark, sf).device_series(FINE_SLOT), EVENT_TYPES, group=["shard"])
    result = forecast_wide(wide, len(EVENT_TYPES), ["shard"], gaps="carry")
    return T.compare_table(result.forecasts, 3, group=["shard"])


def forecast_targets(spark: SparkSession, sf: str) -> DataFrame:
    """What the forecasts of the query before are held against: the held-out windows' real values."""
    return rounded(recursive_forecast(spark, sf).select("shard", "window", "horizon", "actual"))


def carried_series(spark: SparkSession, sf: str) -> DataFrame:
    wide = S.pivot_series(stand_in(spark, sf).device_series(FINE_SLOT), EVENT_TYPES, group=["shard"])
    return rounded(S.carry_forward(wide, len(EVENT_TYPES), ["shard"]).select("shard", "time", *_elements("values")))


def one_lag_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Each event type's next value on its last one alone."""
    out = None
    for kind in EVENT_TYPES:
        wide = S.pivot_series(stand_in(spark, sf).device_series(HOUR), [kind], group=["shard"])
        windows = S.forecast_windows(S.number_steps(wide, ["shard"]), ["shard"], lookback=1, horizons=1)
        (model,) = T.fit_path(T.complete(windows, 1), 1, 1, [0.0])
        row = spark.createDataFrame([(kind, model.intercepts[0], model.weights[0][0])], "device string, intercept double, slope double")
        out = row if out is None else out.unionByName(row)
    return rounded(out)


def zero_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values in steps of fifty, of which the lowest step is 0 and so lost."""
    rows = P.valid_values(stand_in(spark, sf).enriched)
    steps = rows.withColumn("MEASURED_VALUE", F.floor(F.col("MEASURED_VALUE") / 50) * 50.0)
    return X.spread_values(steps, ["utilization", "used"]).select(
        "TARGET_ID", "POLLER_TIME", "METRIC_NAME", "NEW_BUS_ID", "MEASURED_VALUE", "utilization_VALUE", "used_VALUE"
    )


def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(K.top_clients(customer_order_rank(spark, sf), 150))


def queries() -> dict[str, Query]:
    listed: Sequence[Query] = (
        policy_alarm_filter, site_clean, incident_window, enrich_chain, top_client_or_join,
        event_incident_interval, event_incident_binned, event_incident_nearest, event_incident_flagged,
        matched_incidents, client_device_rank, customer_order_rank, top_talkers, metric_profile,
        metric_profile_lineitem, metric_profile_split, metric_profile_levels, seasonal_profile, iqr_threshold,
        iqr_threshold_floored, neighbour_label, neighbour_label_any, neighbour_training_set,
        hourly_features, hourly_spread, hourly_group_transform, first_reading, incident_coverage,
        metric_spread, sparse_filter, single_metric_rows, full_feature_rows, drop_null_columns,
        class_balance, class_ratio, site_one_hot, hash_split, device_extract, time_parts, series_pivot, lag_pairs,
        forecast_windows, push_window, chrono_split, confusion_counts, confusion_metrics, pr_curve,
        average_precision, tolerance_accuracy, best_model, csv_roundtrip, event_log_scan,
        clustered_table, profile_files, typed_table, series_files, header_series_files, log_extract,
        metric_lookup, feature_files, gbt_confusion, gbt_single_metric, gbt_hourly,
        importance, recursive_forecast, event_log_rejects, etl_lookup, appended_table, metric_subset, learner_totals,
        tree_leaf_rows, forecast_targets, carried_series, one_lag_regression, zero_values, top_customers,
    )
    return {q.__name__: q for q in listed}
