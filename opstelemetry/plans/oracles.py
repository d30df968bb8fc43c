"""Plain SQL for the registered queries, in the direct form: OR joins, self joins, repeated rows."""

from __future__ import annotations

WINDOW_START = 1704240000
WINDOW_END = 1706140800
METRICS = (
    "LDldDiskTimePercent", "dskPercent", "utilization", "PctTotal",
    "PctFree", "used", "LDldFreeSpacePct", "UsedMBPct",
)
PROFILED = ("used", "LDldFreeSpacePct", "utilization", "dskPercent", "PctFree", "PctTotal")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
PERCENTILES = (10, 20, 30, 40, 50, 60, 70, 80, 90, 99)

# Each entry is one common table expression; a query lists those it needs, in this order.
CTES = {
    "ev": """
        SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000000 AS t,
               CAST(props ->> '$.k' AS INTEGER) AS k
        FROM events""",
    "event_log": """
        SELECT 'D' || (k % 3) AS destination, CAST(t AS VARCHAR) AS core_time,
               CAST(t + k % 60 AS VARCHAR) AS poller_time, CAST(user_id AS VARCHAR) AS target_id,
               'P' || (k % 7) AS policy_id,
               CASE WHEN (k // 3) % 4 = 0 THEN 'S' ELSE 'T' END AS policy_type,
               CAST(k % 3 AS VARCHAR) AS detected_severity,
               CAST(k % 5 AS VARCHAR) AS propagated_severity, '0' AS low_threshold,
               CAST(value AS VARCHAR) AS measured_value, '100' AS high_threshold,
               CAST(k % 2 AS VARCHAR) AS propagated_flag, CAST(k % 2 AS VARCHAR) AS event_code,
               CASE WHEN k = 98 THEN 'Started'
                    WHEN event_type = 'click' AND (k // 10) % 2 = 0 THEN 'utilization'
                    WHEN event_type = 'click' THEN 'LDldDiskTimePercent'
                    WHEN event_type = 'view' AND (k // 10) % 2 = 0 THEN 'PctFree'
                    WHEN event_type = 'view' THEN 'PctTotal'
                    WHEN event_type = 'purchase' AND (k // 10) % 2 = 0 THEN 'used'
                    WHEN event_type = 'purchase' THEN 'UsedMBPct'
                    WHEN event_type = 'signup' AND (k // 10) % 2 = 0 THEN 'dskPercent'
                    WHEN event_type = 'signup' THEN 'LDldFreeSpacePct' END AS metric_name
        FROM ev WHERE event_type <> 'error'""",
    "device": """
        SELECT CAST(c_custkey AS VARCHAR) AS DEVICE_TARGET_ID, 'C' || c_custkey AS RECON_ID FROM customer""",
    "cust": """
        SELECT 'C' || c_custkey AS RECONCILIATION_ID, 'N' || c_nationkey AS BUS_ID FROM customer""",
    "bus_parent": """
        SELECT 'R' || n_regionkey AS PARENT_BUS_ID, 'N' || n_nationkey AS HIER_BUS_ID
        FROM nation WHERE n_nationkey % 2 = 0""",
    "top_clients": """
        SELECT NEW_BUS_ID, count(*) AS NUM_CUST_DEVICES
        FROM (SELECT BUS_ID AS NEW_BUS_ID FROM cust
              UNION ALL
              SELECT PARENT_BUS_ID FROM cust JOIN bus_parent ON BUS_ID = HIER_BUS_ID)
        GROUP BY NEW_BUS_ID ORDER BY NUM_CUST_DEVICES DESC, NEW_BUS_ID LIMIT 10""",
    "device_location": """
        SELECT c_mktsegment AS DEVICE_TYPE, 'OS' || (c_custkey % 4) AS OPERATING_SYSTEM,
               'C' || c_custkey AS RECONCILIATION_ID, n_name AS SITE_DESC,
               regexp_replace(n_name, '[^0-9a-zA-Z]+', '', 'g') AS SITE,
               CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS IS_VIRTUAL
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 9""",
    "parent_monitor": """
        SELECT p_brand AS PARENT_TARGET_ID, CAST(p_partkey AS VARCHAR) AS CHILD_TARGET_ID FROM part
        UNION ALL
        SELECT p_type, CAST(p_partkey AS VARCHAR) FROM part WHERE p_size % 5 = 0""",
    "monitor_type": """
        SELECT CAST(p_partkey AS VARCHAR) AS MONITOR_ID, p_type AS MONITOR_DESC FROM part""",
    "enriched": """
        SELECT e.destination AS DESTINATION, e.core_time AS CORE_TIME,
               strftime(make_timestamp(CAST(e.core_time AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS CORE_TIMESTAMP,
               e.poller_time AS POLLER_TIME,
               strftime(make_timestamp(CAST(e.poller_time AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS POLLER_TIMESTAMP,
               e.target_id AS TARGET_ID, e.policy_id AS POLICY_ID,
               e.detected_severity AS DETECTED_SEVERITY, e.propagated_severity AS PROPAGATED_SEVERITY,
               e.low_threshold AS LOW_THRESHOLD, e.measured_value AS MEASURED_VALUE,
               e.high_threshold AS HIGH_THRESHOLD, e.propagated_flag AS PROPAGATED_FLAG,
               e.event_code AS EVENT_CODE, e.metric_name AS METRIC_NAME, d.RECON_ID, c.BUS_ID,
               b.PARENT_BUS_ID, t.NEW_BUS_ID, t.NUM_CUST_DEVICES, l.DEVICE_TYPE, l.OPERATING_SYSTEM,
               l.SITE, l.SITE_DESC, l.IS_VIRTUAL, p.PARENT_TARGET_ID, m.MONITOR_DESC
        FROM event_log e
        JOIN device d ON e.target_id = d.DEVICE_TARGET_ID
        JOIN cust c ON d.RECON_ID = c.RECONCILIATION_ID
        LEFT JOIN bus_parent b ON c.BUS_ID = b.HIER_BUS_ID
        JOIN top_clients t ON c.BUS_ID = t.NEW_BUS_ID OR b.PARENT_BUS_ID = t.NEW_BUS_ID
        LEFT JOIN device_location l ON d.RECON_ID = l.RECONCILIATION_ID
        LEFT JOIN parent_monitor p ON e.target_id = p.CHILD_TARGET_ID
        LEFT JOIN monitor_type m ON e.target_id = m.MONITOR_ID
        WHERE e.policy_type = 'T' AND e.metric_name <> 'Started'""",
    "incidents": f"""
        SELECT i.INCIDENT_ID, strftime(make_timestamp(i.t * 1000000), '%Y-%m-%d %H:%M:%S') AS SUBMIT_DATE,
               i.BUS_ID, i.EVENT_CODE AS EVENT_CODE_INC, d.RECON_ID AS RECON_ID_INC,
               1 AS Is_Source_Monitor, i.t AS SUBMIT_DATE_NUM
        FROM (SELECT CAST(event_id AS VARCHAR) AS INCIDENT_ID, t, 'N' || (user_id % 25) AS BUS_ID,
                     CAST(k % 2 AS VARCHAR) AS EVENT_CODE,
                     CASE WHEN k % 7 = 0 THEN 'Other' WHEN k % 7 <> 1 THEN 'Monitor' END AS submitter
              FROM ev WHERE event_type = 'error') i
        JOIN (SELECT CAST(event_id AS VARCHAR) AS INCIDENT_DEV_ID, 'C' || user_id AS RECON_ID
              FROM ev WHERE event_type = 'error'
              UNION ALL
              SELECT CAST(event_id AS VARCHAR), 'C' || (user_id + 1)
              FROM ev WHERE event_type = 'error' AND k % 11 = 0) d
        ON i.INCIDENT_ID = d.INCIDENT_DEV_ID
        WHERE CASE WHEN i.submitter = 'Other' THEN 0 ELSE 1 END = 1
          AND i.t >= {WINDOW_START} AND i.t < {WINDOW_END}""",
    "pairs": """
        SELECT a.*, CAST(a.CORE_TIME AS BIGINT) AS CORE_TIME_NUM, i.INCIDENT_ID, i.SUBMIT_DATE_NUM,
               i.SUBMIT_DATE_NUM - CAST(a.CORE_TIME AS BIGINT) AS INC_EVENT_TIME_DIFF
        FROM enriched a
        LEFT JOIN incidents i
        ON a.RECON_ID = i.RECON_ID_INC AND a.EVENT_CODE = i.EVENT_CODE_INC
           AND i.SUBMIT_DATE_NUM - CAST(a.CORE_TIME AS BIGINT) <= 14400
           AND i.SUBMIT_DATE_NUM - CAST(a.CORE_TIME AS BIGINT) >= 0
        WHERE a.DETECTED_SEVERITY <> '0' OR a.PROPAGATED_SEVERITY <> '0'""",
    "mapping": """
        SELECT p.* EXCLUDE (POLLER_TIME), CAST(p.POLLER_TIME AS BIGINT) AS POLLER_TIME,
               m.MIN_DIFF, m.HAS_MAPPED_INCIDENT
        FROM pairs p
        LEFT JOIN (SELECT INCIDENT_ID, RECON_ID, min(INC_EVENT_TIME_DIFF) AS MIN_DIFF, 1 AS HAS_MAPPED_INCIDENT
                   FROM pairs WHERE SUBMIT_DATE_NUM <> 0 GROUP BY INCIDENT_ID, RECON_ID) m
        ON p.INC_EVENT_TIME_DIFF = m.MIN_DIFF AND p.RECON_ID = m.RECON_ID AND p.INCIDENT_ID = m.INCIDENT_ID""",
    "numbered": "SELECT row_number() OVER () AS idx, * FROM mapping",
    "neighbours": """
        SELECT DISTINCT r.idx, r.POLLER_TIME, r.METRIC_NAME, r.MEASURED_VALUE, r.RECON_ID, r.NEW_BUS_ID,
               r.SITE, r.PARENT_TARGET_ID, r.INCIDENT_ID, r.HAS_MAPPED_INCIDENT,
               coalesce(r.POLLER_TIME - e.at < 3600 AND r.POLLER_TIME - e.at > -3600, false) AS near
        FROM numbered r
        LEFT JOIN (SELECT DISTINCT POLLER_TIME AS at, RECON_ID, METRIC_NAME
                   FROM mapping WHERE HAS_MAPPED_INCIDENT = 1) e
        ON r.RECON_ID = e.RECON_ID AND r.METRIC_NAME = e.METRIC_NAME""",
    "hourly": """
        SELECT r.RECON_ID, r.METRIC_NAME, r.POLLER_TIME // 3600 AS POLLER_TIME_PERIOD_60_MIN, r.POLLER_TIME,
               r.MEASURED_VALUE, TRY_CAST(r.MEASURED_VALUE AS DOUBLE) AS v, r.HAS_MAPPED_INCIDENT,
               i.INCIDENT_ID AS INCIDENT_ID_y
        FROM mapping r
        LEFT JOIN incidents i
        ON r.RECON_ID = i.RECON_ID_INC AND r.POLLER_TIME // 3600 = i.SUBMIT_DATE_NUM // 3600
           AND r.EVENT_CODE = i.EVENT_CODE_INC""",
    "hourly_stats": """
        SELECT RECON_ID, METRIC_NAME, POLLER_TIME_PERIOD_60_MIN, round(avg(v) + 1e-9, 6) AS MEAN,
               round(max(v) + 1e-9, 6) AS MAX, round(min(v) + 1e-9, 6) AS MIN, count(v) AS COUNT,
               CAST(coalesce(bool_or(HAS_MAPPED_INCIDENT = 1), false) AS INTEGER) AS HAS_MAPPED_INCIDENT_MERGED
        FROM hourly GROUP BY ALL""",
    "valid": """
        SELECT * REPLACE (TRY_CAST(MEASURED_VALUE AS DOUBLE) AS MEASURED_VALUE)
        FROM enriched WHERE TRY_CAST(MEASURED_VALUE AS DOUBLE) <= 105""",
    "training": """
        SELECT POLLER_TIME, v AS MEASURED_VALUE, NEW_BUS_ID,
               CASE SITE WHEN 'NATION1' THEN 'NATION0' WHEN 'NATION3' THEN 'NATION2' ELSE SITE END AS SITE,
               CAST(near AS INTEGER) AS HAS_NEIGHBOR_INCIDENT, """
    + ", ".join(f"""CASE WHEN METRIC_NAME = '{m}' THEN nullif(v, 0) END AS "{m}_VALUE\"""" for m in METRICS)
    + """, CAST(extract(hour FROM make_timestamp(POLLER_TIME * 1000000)) AS INTEGER) AS HOUR,
               CAST(isodow(make_timestamp(POLLER_TIME * 1000000)) - 1 AS INTEGER) AS WEEKDAY
        FROM (SELECT *, TRY_CAST(MEASURED_VALUE AS DOUBLE) AS v FROM neighbours) WHERE v <= 105""",
    "seasonal": """
        SELECT CAST(user_id AS VARCHAR) AS target_id, event_type AS metric_name,
               CAST(extract(hour FROM make_timestamp(t * 1000000)) AS INTEGER) AS hour,
               CAST(isodow(make_timestamp(t * 1000000)) - 1 AS INTEGER) AS dayofweek,
               avg(value) AS mean, min(value) AS min, max(value) AS max, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q2
        FROM ev GROUP BY ALL""",
    "wide": """
        SELECT user_id % 3 AS shard, t // 3600 * 3600 AS time, """
    + ", ".join(f"avg(CASE WHEN event_type = '{e}' THEN value END) AS v_{i}" for i, e in enumerate(EVENT_TYPES))
    + " FROM ev GROUP BY ALL",
    "steps": """
        SELECT *, row_number() OVER (PARTITION BY shard ORDER BY time) - 1 AS step,
               count(*) OVER (PARTITION BY shard) AS n_steps
        FROM wide""",
    "slots": """
        SELECT user_id % 3 AS shard, t // 14400 AS slot,
               avg(CASE WHEN event_type = 'signup' THEN value END) AS v
        FROM ev GROUP BY ALL""",
    "forecasts": """
        SELECT shard, h.horizon,
               (coalesce(x0, 0) + coalesce(x1, 0) + coalesce(x2, 0) + coalesce(x3, 0) + coalesce(x4, 0)
                + coalesce(x5, 0) + coalesce(x6, 0) + coalesce(x7, 0) + coalesce(x8, 0) + coalesce(x9, 0)) / 10 AS predicted,
               CASE h.horizon WHEN 1 THEN y1 WHEN 2 THEN y2 ELSE y3 END AS actual
        FROM (SELECT shard, slot, """
    + ", ".join(f"lag(v, {9 - j}) OVER w AS x{j}" for j in range(10))
    + """, lead(v, 1) OVER w AS y1, lead(v, 2) OVER w AS y2, lead(v, 3) OVER w AS y3,
                     row_number() OVER w - 1 AS step, count(*) OVER (PARTITION BY shard) AS n_steps
              FROM slots WINDOW w AS (PARTITION BY shard ORDER BY slot)) s,
             (SELECT unnest([1, 2, 3]) AS horizon) h
        WHERE step >= 9 AND step + 3 < n_steps""",
    "scores": """
        SELECT CAST(event_type = 'error' AS INTEGER) AS label, CAST(value > 40 AS INTEGER) AS prediction,
               floor(least(value, 512.0) * 4) / 2048 AS p_incident
        FROM ev""",
}

_LOG = ["ev", "event_log"]
_CLIENTS = ["device", "cust", "bus_parent", "top_clients"]
_ENRICHED = [*_LOG, *_CLIENTS, "device_location", "parent_monitor", "monitor_type", "enriched"]
_PAIRS = [*_ENRICHED, "incidents", "pairs"]
_MAPPING = [*_PAIRS, "mapping"]
_NEIGHBOURS = [*_MAPPING, "numbered", "neighbours"]


def _sql(ctes: list[str], body: str) -> str:
    listed = ", ".join(f"{name} AS ({CTES[name]})" for name in ctes)
    return f"WITH {listed} {body}" if ctes else body


def _percentiles(value: str) -> str:
    return ", ".join(
        f"round(quantile_cont({value}, {p / 100}) + 1e-9, 6) AS percentile_{p}" for p in PERCENTILES
    )


def _profile(value: str) -> str:
    return (
        f"round(avg({value}) + 1e-9, 6) AS mean, count({value}) AS count, "
        f"round(stddev_samp({value}) + 1e-9, 6) AS std, {_percentiles(value)}"
    )


_PAIR_COLUMNS = """TARGET_ID, METRIC_NAME, RECON_ID, EVENT_CODE, NEW_BUS_ID, PARENT_TARGET_ID, CORE_TIME_NUM,
    INCIDENT_ID, SUBMIT_DATE_NUM, INC_EVENT_TIME_DIFF"""


def _levels() -> str:
    parts = [
        f"""SELECT METRIC_NAME, '{level}' AS level, {column} AS group_key, {_profile('v')}
            FROM profiled WHERE {column} IS NOT NULL GROUP BY METRIC_NAME, {column}"""
        for level, column in (("site", "SITE"), ("client", "NEW_BUS_ID"), ("device", "RECON_ID"))
    ]
    names = ", ".join(f"'{m}'" for m in PROFILED)
    return (
        f"""SELECT * FROM (WITH profiled AS (
                SELECT METRIC_NAME, RECON_ID, NEW_BUS_ID, MEASURED_VALUE AS v,
                       CASE SITE WHEN 'NATION1' THEN 'NATION0' WHEN 'NATION3' THEN 'NATION2' ELSE SITE END AS SITE
                FROM valid WHERE METRIC_NAME IN ({names})) """
        + " UNION ALL ".join(parts)
        + ")"
    )


def _spread_stats() -> str:
    return ", ".join(
        f"""CASE WHEN METRIC_NAME = '{m}' THEN "{s}" END AS "{m}_{s}\""""
        for m in METRICS
        for s in ("MEAN", "MIN", "MAX", "COUNT")
    )


def _rank(counts: str) -> str:
    return f"""
        SELECT NEW_BUS_ID, n AS RECONCILIATION_NUM, round(100.0 * n / sum(n) OVER () + 1e-9, 6) AS PERCENT,
               round(100.0 * sum(n) OVER (ORDER BY n DESC, md5(NEW_BUS_ID), NEW_BUS_ID
                     ROWS UNBOUNDED PRECEDING) / sum(n) OVER () + 1e-9, 6) AS CUMULATIVE_PERCENT,
               row_number() OVER (ORDER BY n DESC, md5(NEW_BUS_ID), NEW_BUS_ID) AS RANK
        FROM ({counts})"""


_COUNTS = """SELECT label, prediction, count(s.label) AS n
    FROM (SELECT unnest([0, 0, 1, 1]) AS l, unnest([0, 1, 0, 1]) AS p) c
    LEFT JOIN scores s ON s.label = c.l AND s.prediction = c.p GROUP BY ALL"""


def _metrics(positive: int) -> str:
    t, g = f"label = {positive}", f"prediction = {positive}"
    return f"""SELECT *, round(tp / (tp + fp) + 1e-9, 6) AS precision, round(tp / (tp + fn) + 1e-9, 6) AS recall,
                      round(2 * tp / (2 * tp + fp + fn) + 1e-9, 6) AS f1, {positive} AS positive
               FROM (SELECT count(*) FILTER ({t} AND {g}) AS tp, count(*) FILTER (NOT {t} AND {g}) AS fp,
                            count(*) FILTER ({t} AND NOT {g}) AS fn,
                            count(*) FILTER (NOT {t} AND NOT {g}) AS tn FROM scores)"""


_CURVE = """
    SELECT threshold, tp / predicted AS precision, tp / total AS recall, hits / total * tp / predicted AS gain
    FROM (SELECT threshold, hits, sum(hits) OVER w AS tp, sum(n) OVER w AS predicted, sum(hits) OVER () AS total
          FROM (SELECT p_incident AS threshold, count(*) FILTER (label = 1) AS hits, count(*) AS n
                FROM scores GROUP BY ALL)
          WINDOW w AS (ORDER BY threshold DESC))"""

_V = [f"v_{i}" for i in range(len(EVENT_TYPES))]


def _windows() -> str:
    past = ", ".join(
        "round(" + " + ".join(f"coalesce(lag({v}, {9 - j}) OVER w, 0.0) * {j + 1}" for j in range(10)) + f" + 1e-9, 4) AS x_{i}"
        for i, v in enumerate(_V)
    )
    ahead = ", ".join(
        f"round(lead({v}, {h}) OVER w + 1e-9, 4) AS y_{h}_{i}" for h in (1, 2, 3) for i, v in enumerate(_V)
    )
    return f"""SELECT * EXCLUDE (step, n_steps) FROM (
        SELECT shard, step - 9 AS "window", 10 AS steps, step, n_steps, {past}, {ahead}
        FROM steps WINDOW w AS (PARTITION BY shard ORDER BY time))
        WHERE step >= 9 AND step + 3 < n_steps"""


def _pairs_of_steps() -> str:
    now = ", ".join(f"round({v} + 1e-9, 6) AS xy_{i}" for i, v in enumerate(_V))
    later = ", ".join(f"round(lead({v}) OVER w + 1e-9, 6) AS xy_{i + len(_V)}" for i, v in enumerate(_V))
    return f"""SELECT * EXCLUDE (n_steps) FROM (SELECT shard, step, n_steps, {now}, {later}
        FROM steps WINDOW w AS (PARTITION BY shard ORDER BY time)) WHERE step < n_steps - 2"""


# The second training period begins here (2024-01-16).
SECOND_WEEK = 1705363200
_SPARSE = """"LDldDiskTimePercent_VALUE" IS NULL AND "LDldFreeSpacePct_VALUE" IS NULL AND "UsedMBPct_VALUE" IS NULL"""


def _draw(*keys: str) -> str:
    """A number in [0, 1) from the keys' MD5."""
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(keys)}, '7')), 1, 8))::BIGINT / 4294967296.0)"


def _learner_totals() -> str:
    draw = _draw("POLLER_TIME", "NEW_BUS_ID", "SITE")
    hour = _draw("RECON_ID", "METRIC_NAME", "POLLER_TIME_PERIOD_60_MIN")
    return f"""
        SELECT learner, part, label, sum(n)::BIGINT AS n FROM (
          SELECT 'all metrics' AS learner, CASE WHEN POLLER_TIME < {SECOND_WEEK} THEN 'hold-out' ELSE 'other week' END AS part,
                 HAS_NEIGHBOR_INCIDENT AS label, 1 AS n
          FROM training WHERE {_SPARSE} AND (POLLER_TIME >= {SECOND_WEEK} OR {draw} >= 0.67)
          UNION ALL
          SELECT 'one metric', 'hold-out', HAS_NEIGHBOR_INCIDENT, 1 FROM training WHERE "PctFree_VALUE" IS NOT NULL AND {draw} >= 0.8
          UNION ALL
          SELECT 'hourly', 'hold-out', HAS_MAPPED_INCIDENT_MERGED, 1 FROM hourly_stats WHERE {hour} >= 0.67
          UNION ALL
          SELECT l, p, c, 0 FROM (SELECT unnest([0, 1]) AS c),
            (SELECT 'all metrics' AS l, 'hold-out' AS p UNION ALL SELECT 'all metrics', 'other week'
             UNION ALL SELECT 'one metric', 'hold-out' UNION ALL SELECT 'hourly', 'hold-out'))
        GROUP BY ALL"""


def _fine_steps() -> str:
    """Ten-minute slots with every device's last reading."""
    values = ", ".join(
        f"last_value(avg(CASE WHEN event_type = '{e}' THEN value END) IGNORE NULLS) OVER "
        f"(PARTITION BY user_id % 3 ORDER BY t // 600 ROWS UNBOUNDED PRECEDING) AS v_{i}"
        for i, e in enumerate(EVENT_TYPES)
    )
    return f"SELECT user_id % 3 AS shard, t // 600 * 600 AS time, {values} FROM ev GROUP BY user_id % 3, t // 600"


def _forecast_targets() -> str:
    """Windows of ten steps inside the last hundredth of each shard, and one device's next three values."""
    whole = " AND ".join(
        f"count({v}) OVER (PARTITION BY shard ORDER BY time ROWS BETWEEN 9 PRECEDING AND 3 FOLLOWING) = 13" for v in _V
    )
    ahead = ", ".join(f"lead(v_3, {h}) OVER (PARTITION BY shard ORDER BY time) AS y{h}" for h in (1, 2, 3))
    return f"""
        SELECT shard, w AS "window", horizon, round(CASE horizon WHEN 1 THEN y1 WHEN 2 THEN y2 ELSE y3 END + 1e-9, 6) AS actual
        FROM (SELECT shard, step - 9 AS w, step, m, {ahead}, {whole} AS complete
              FROM (SELECT *, row_number() OVER p - 1 AS step, count(*) OVER (PARTITION BY shard) AS m
                    FROM (SELECT *, row_number() OVER p - 1 AS s, count(*) OVER (PARTITION BY shard) AS n
                          FROM fine WINDOW p AS (PARTITION BY shard ORDER BY time))
                    WHERE s >= floor(n * 0.99) WINDOW p AS (PARTITION BY shard ORDER BY time))),
             (SELECT unnest([1, 2, 3]) AS horizon)
        WHERE step >= 9 AND step + 3 < m AND complete"""


def oracle_sql() -> dict[str, str]:
    mapping_columns = f"{_PAIR_COLUMNS}, MIN_DIFF, HAS_MAPPED_INCIDENT"
    neighbour_columns = """RECON_ID, METRIC_NAME, POLLER_TIME, NEW_BUS_ID, PARENT_TARGET_ID, INCIDENT_ID,
        HAS_MAPPED_INCIDENT"""
    values = ", ".join(f"""CASE WHEN METRIC_NAME = '{m}' THEN nullif(MEASURED_VALUE, 0) END AS "{m}_VALUE\"""" for m in METRICS)
    hot = ", ".join(f"""CAST(METRIC_NAME = '{m}' AS INTEGER) AS "METRIC_NAME_{m}\"""" for m in METRICS)
    threshold = """SELECT target_id, metric_name, q3 + 1.5 * (q3 - q1) AS threshold
        FROM (SELECT target_id, metric_name, quantile_cont(max, 0.25) AS q1, quantile_cont(max, 0.75) AS q3
              FROM seasonal GROUP BY ALL)"""
    return {
        "policy_alarm_filter": _sql(_LOG, """SELECT * FROM event_log
            WHERE policy_type = 'T' AND metric_name <> 'Started'
              AND (detected_severity <> '0' OR propagated_severity <> '0')"""),
        "site_clean": _sql(["device_location"], """SELECT RECONCILIATION_ID, SITE_DESC,
            CASE SITE WHEN 'NATION1' THEN 'NATION0' WHEN 'NATION3' THEN 'NATION2' ELSE SITE END AS SITE
            FROM device_location"""),
        "incident_window": _sql(["ev", "incidents"], "SELECT * FROM incidents"),
        "enrich_chain": _sql(_ENRICHED, "SELECT * FROM enriched"),
        "top_client_or_join": _sql([*_LOG, *_CLIENTS], """
            SELECT e.target_id, e.core_time, e.metric_name, d.RECON_ID, c.BUS_ID, b.PARENT_BUS_ID,
                   t.NEW_BUS_ID, t.NUM_CUST_DEVICES
            FROM event_log e JOIN device d ON e.target_id = d.DEVICE_TARGET_ID
            JOIN cust c ON d.RECON_ID = c.RECONCILIATION_ID
            LEFT JOIN bus_parent b ON c.BUS_ID = b.HIER_BUS_ID
            JOIN top_clients t ON c.BUS_ID = t.NEW_BUS_ID OR b.PARENT_BUS_ID = t.NEW_BUS_ID"""),
        "event_incident_interval": _sql(_PAIRS, f"SELECT {_PAIR_COLUMNS} FROM pairs"),
        "event_incident_binned": _sql(_PAIRS, f"SELECT {_PAIR_COLUMNS} FROM pairs"),
        "event_incident_nearest": _sql(_MAPPING, f"SELECT {mapping_columns} FROM mapping"),
        "event_incident_flagged": _sql(_MAPPING, f"SELECT {mapping_columns} FROM mapping"),
        "matched_incidents": _sql(_PAIRS, """SELECT INCIDENT_ID, RECON_ID, min(INC_EVENT_TIME_DIFF) AS min_diff,
            count(*) AS pairs FROM pairs WHERE SUBMIT_DATE_NUM <> 0 GROUP BY INCIDENT_ID, RECON_ID"""),
        "client_device_rank": _sql(["cust", "bus_parent"], "SELECT * FROM (" + _rank("""
            SELECT coalesce(p.PARENT_BUS_ID, c.BUS_ID) AS NEW_BUS_ID, count(c.RECONCILIATION_ID) AS n
            FROM cust c LEFT JOIN (SELECT HIER_BUS_ID, min(PARENT_BUS_ID) AS PARENT_BUS_ID
                                   FROM bus_parent GROUP BY HIER_BUS_ID) p ON c.BUS_ID = p.HIER_BUS_ID
            GROUP BY 1""") + ") WHERE RANK <= 150"),
        "customer_order_rank": _rank(
            "SELECT CAST(o_custkey AS VARCHAR) AS NEW_BUS_ID, count(o_orderkey) AS n FROM orders GROUP BY 1"),
        "top_talkers": _sql(["ev", "incidents"], f"""SELECT RECON_ID_INC AS recon_id, count(*) AS incident_count
            FROM incidents WHERE SUBMIT_DATE_NUM > {WINDOW_START} AND SUBMIT_DATE_NUM < {WINDOW_END}
            GROUP BY 1 ORDER BY incident_count DESC, recon_id LIMIT 20"""),
        "metric_profile": f"""SELECT event_type AS metric_name, CAST(user_id AS VARCHAR) AS target_id,
            {_profile('value')} FROM events WHERE value <= 105 GROUP BY 1, 2""",
        "metric_profile_lineitem": f"""SELECT l_returnflag, l_suppkey, {_profile('l_extendedprice')}
            FROM lineitem GROUP BY 1, 2""",
        "metric_profile_split": f"""SELECT l_returnflag, {_profile('l_extendedprice')}
            FROM lineitem GROUP BY 1""",
        "metric_profile_levels": _sql([*_ENRICHED, "valid"], _levels()),
        "profile_files": _sql([*_ENRICHED, "valid"],
            f"SELECT * FROM ({_levels()})"),
        "seasonal_profile": _sql(["ev", "seasonal"], """SELECT target_id, metric_name, hour, dayofweek,
            round(mean + 1e-9, 6) AS mean, round(min + 1e-9, 6) AS min, round(max + 1e-9, 6) AS max, round(median + 1e-9, 6) AS median,
            round(q1 + 1e-9, 6) AS q1, round(q2 + 1e-9, 6) AS q2 FROM seasonal"""),
        "iqr_threshold": _sql(["ev", "seasonal"],
            f"SELECT target_id, metric_name, round(threshold + 1e-9, 6) AS threshold FROM ({threshold})"),
        "iqr_threshold_floored": _sql(["ev", "seasonal"], f"""SELECT target_id, metric_name,
            round(CASE WHEN metric_name = 'view' THEN greatest(95.0, threshold) ELSE threshold END + 1e-9, 6) AS threshold
            FROM ({threshold})"""),
        "neighbour_label": _sql(_NEIGHBOURS,
            f"SELECT {neighbour_columns}, CAST(near AS INTEGER) AS HAS_NEIGHBOR_INCIDENT FROM neighbours"),
        "neighbour_label_any": _sql(_NEIGHBOURS, f"""SELECT {neighbour_columns},
            CAST(bool_or(near) AS INTEGER) AS HAS_NEIGHBOR_INCIDENT
            FROM neighbours GROUP BY idx, {neighbour_columns}"""),
        "neighbour_training_set": _sql([*_NEIGHBOURS, "training"], "SELECT * FROM training"),
        "single_metric_rows": _sql([*_NEIGHBOURS, "training"], """
            SELECT HAS_NEIGHBOR_INCIDENT, "PctFree_VALUE" FROM (SELECT * FROM training UNION ALL SELECT * FROM training)
            WHERE "PctFree_VALUE" IS NOT NULL"""),
        "full_feature_rows": _sql([*_NEIGHBOURS, "training"],
            'SELECT HAS_NEIGHBOR_INCIDENT, "dskPercent_VALUE", "utilization_VALUE", "PctTotal_VALUE", '
            '"PctFree_VALUE", "used_VALUE", HOUR, WEEKDAY, site_slot, '
            "(SELECT count(DISTINCT SITE)::INTEGER FROM training) AS site_slots "
            "FROM training LEFT JOIN (SELECT SITE, row_number() OVER (ORDER BY SITE) - 1 AS site_slot "
            "FROM (SELECT DISTINCT SITE FROM training WHERE SITE IS NOT NULL)) USING (SITE) "
            f"WHERE {_SPARSE}"),
        "hourly_features": _sql([*_MAPPING, "hourly", "hourly_stats"], "SELECT * FROM hourly_stats"),
        "hourly_spread": _sql([*_MAPPING, "hourly", "hourly_stats"], f"""
            SELECT COUNT, HAS_MAPPED_INCIDENT_MERGED, {_spread_stats()},
                   CAST(extract(hour FROM make_timestamp(POLLER_TIME_PERIOD_60_MIN * 3600000000)) AS INTEGER) AS HOUR,
                   CAST(isodow(make_timestamp(POLLER_TIME_PERIOD_60_MIN * 3600000000)) - 1 AS INTEGER) AS WEEKDAY
            FROM hourly_stats"""),
        "hourly_group_transform": _sql([*_MAPPING, "hourly"], """
            SELECT RECON_ID, METRIC_NAME, POLLER_TIME_PERIOD_60_MIN, POLLER_TIME, INCIDENT_ID_y, MEASURED_VALUE,
                   round(avg(v) OVER g + 1e-9, 6) AS MEAN, max(v) OVER g AS MAX, min(v) OVER g AS MIN, count(v) OVER g AS COUNT
            FROM hourly WINDOW g AS (PARTITION BY RECON_ID, METRIC_NAME, POLLER_TIME_PERIOD_60_MIN)"""),
        "first_reading": _sql(["ev"], """
            SELECT user_id, event_type, hour, event_id, t, value
            FROM (SELECT *, t // 3600 AS hour,
                         row_number() OVER (PARTITION BY user_id, event_type, t // 3600 ORDER BY t, event_id) AS n
                  FROM ev) WHERE n = 1"""),
        "incident_coverage": _sql([*_MAPPING, "hourly"], """
            SELECT count(*) AS incidents FROM (SELECT DISTINCT INCIDENT_ID_y FROM hourly)"""),
        "metric_spread": _sql([*_ENRICHED, "valid"],
            f"SELECT TARGET_ID, POLLER_TIME, METRIC_NAME, NEW_BUS_ID, MEASURED_VALUE, {hot}, {values} FROM valid"),
        "sparse_filter": _sql([*_ENRICHED, "valid"], f"""
            SELECT TARGET_ID, POLLER_TIME, NEW_BUS_ID, METRIC_NAME, "PctFree_VALUE", "utilization_VALUE"
            FROM (SELECT *, {values} FROM valid)
            WHERE "LDldDiskTimePercent_VALUE" IS NULL AND "LDldFreeSpacePct_VALUE" IS NULL
              AND "UsedMBPct_VALUE" IS NULL"""),
        "drop_null_columns": _sql(["ev"], """SELECT event_id, CASE WHEN k > 90 THEN value END AS partial, value,
            value AS kept_value FROM ev"""),
        "class_balance": _sql([*_MAPPING, "hourly", "hourly_stats"], """
            SELECT HAS_MAPPED_INCIDENT_MERGED AS label, count(*) AS n FROM hourly_stats GROUP BY 1"""),
        "class_ratio": _sql([*_MAPPING, "hourly", "hourly_stats"], """
            SELECT noise, incident, round(noise / incident + 1e-9, 6) AS ratio
            FROM (SELECT count(*) FILTER (HAS_MAPPED_INCIDENT_MERGED = 0) AS noise,
                         count(*) FILTER (HAS_MAPPED_INCIDENT_MERGED = 1) AS incident FROM hourly_stats)"""),
        "site_one_hot": _sql(["device_location"], """SELECT RECONCILIATION_ID, dense_rank() OVER (ORDER BY SITE) - 1 AS site_slot,
            (SELECT count(DISTINCT SITE)::INTEGER FROM device_location) AS site_slots FROM device_location"""),
        "hash_split": f"SELECT event_id, CASE WHEN {_draw('event_id')} < 0.67 THEN 'train' ELSE 'test' END AS part FROM events",
        "device_extract": _sql(_LOG, """
            SELECT poller_time, target_id, measured_value, metric_name FROM event_log
            WHERE metric_name IN ('utilization', 'PctFree')
            UNION ALL
            SELECT poller_time, target_id, NULL, metric_name FROM event_log WHERE metric_name = 'used'"""),
        "time_parts": _sql(["ev"], """
            SELECT event_id, strftime(moment, '%a %b ') || lpad(CAST(day(moment) AS VARCHAR), 2, ' ')
                   || strftime(moment, ' %H:%M:%S %Y') AS text, CAST(hour(moment) AS INTEGER) AS hour,
                   CAST(isodow(moment) - 1 AS INTEGER) AS weekday, t // 3600 AS bucket
            FROM (SELECT *, make_timestamp(t * 1000000) AS moment FROM ev)"""),
        "series_pivot": _sql(["ev", "wide", "steps"], "SELECT shard, time, step, n_steps, "
            + ", ".join(f"round({v} + 1e-9, 6) AS values_{i}" for i, v in enumerate(_V)) + " FROM steps"),
        "lag_pairs": _sql(["ev", "wide", "steps"], _pairs_of_steps()),
        "forecast_windows": _sql(["ev", "wide", "steps"], _windows()),
        "chrono_split": _sql(["ev", "wide", "steps"], """SELECT shard, time, step,
            CASE WHEN step < floor(n_steps * 0.99) THEN 'train' ELSE 'test' END AS part FROM steps"""),
        "confusion_counts": _sql(["ev", "scores"], _COUNTS),
        "confusion_metrics": _sql(["ev", "scores"], f"{_metrics(1)} UNION ALL {_metrics(0)}"),
        "pr_curve": _sql(["ev", "scores"], f"""SELECT round(threshold + 1e-9, 6) AS threshold, round(precision + 1e-9, 6) AS precision,
            round(recall + 1e-9, 6) AS recall, round(gain + 1e-9, 6) AS gain FROM ({_CURVE})"""),
        "average_precision": _sql(["ev", "scores"],
            f"SELECT round(sum(gain) + 1e-9, 6) AS average_precision FROM ({_CURVE})"),
        "tolerance_accuracy": _sql(["ev", "slots", "forecasts"], """
            SELECT horizon, round(avg(CAST(abs(predicted - actual) <= 5 AS INTEGER)) + 1e-9, 4) AS accuracy,
                   round(avg((predicted - actual) ** 2) + 1e-9, 4) AS mse
            FROM forecasts WHERE actual IS NOT NULL GROUP BY horizon"""),
        "best_model": _sql(["ev", "slots", "forecasts"], """
            SELECT arg_min(shard, mse) AS model_id, round(min(mse) + 1e-9, 4) AS mse
            FROM (SELECT shard, avg((predicted - actual) ** 2) AS mse FROM forecasts GROUP BY shard)"""),
        "csv_roundtrip": _sql(["cust"], "SELECT * FROM cust"),
        "event_log_scan": _sql(_LOG, "SELECT * FROM event_log"),
        "clustered_table": _sql(_LOG, """SELECT metric_name, core_time, target_id FROM event_log
            WHERE policy_type = 'T' AND metric_name = 'utilization'"""),
        "series_files": _sql(["ev"], """SELECT t AS poller_time, CAST(user_id AS VARCHAR) AS target_id,
            value AS measured_value, event_type AS metric_name FROM ev"""),
        "header_series_files": _sql(["ev"], """SELECT t AS poller_time, CAST(user_id AS VARCHAR) AS target_id,
            value AS measured_value, event_type AS metric_name FROM ev"""),
        "log_extract": _sql(_LOG, """SELECT poller_time, target_id, measured_value, metric_name
            FROM event_log WHERE target_id IN ('7', '8', '46', '149')"""),
        "metric_lookup": _sql(_ENRICHED, """SELECT RECON_ID, NEW_BUS_ID, SITE, MEASURED_VALUE
            FROM enriched WHERE METRIC_NAME = 'utilization'"""),
        "feature_files": _sql([*_NEIGHBOURS, "training"], "SELECT * FROM training"),
        "push_window": _sql(["ev", "wide", "steps"], """SELECT * EXCLUDE (step, n_steps) FROM (
            SELECT shard, step - 9 AS "window", 10 AS steps, step, n_steps,
                   round(lag(v_0, 8) OVER w + 1e-9, 6) AS oldest, round(lead(v_0, 1) OVER w + 1e-9, 6) AS newest
            FROM steps WINDOW w AS (PARTITION BY shard ORDER BY time))
            WHERE step >= 9 AND step + 3 < n_steps"""),
        "typed_table": _sql(["ev", "incidents"], "SELECT * FROM incidents"),
        "appended_table": _sql(["ev", "incidents"], "SELECT * FROM incidents"),
        "event_log_rejects": _sql(["ev"], """SELECT kind, n, sum(n) OVER ()::BIGINT AS all_files FROM (
            SELECT CASE k WHEN 13 THEN 'cut' ELSE 'long' END AS kind, count(*) AS n FROM ev WHERE k IN (13, 14) GROUP BY ALL)"""),
        "etl_lookup": _sql(_ENRICHED, """SELECT METRIC_NAME, substr(CORE_TIMESTAMP, 1, 10) AS CORE_DAY, CORE_TIME, RECON_ID, MEASURED_VALUE
            FROM enriched WHERE METRIC_NAME IN ('utilization', 'used')
              AND substr(CORE_TIMESTAMP, 1, 10) BETWEEN '2024-01-05' AND '2024-01-14'"""),
        "metric_subset": _sql(_ENRICHED, """SELECT METRIC_NAME, RECON_ID, CORE_TIME, MEASURED_VALUE
            FROM enriched WHERE METRIC_NAME IN ('utilization', 'used')"""),
        "learner_totals": _sql([*_NEIGHBOURS, "training", "hourly", "hourly_stats"], _learner_totals()),
        "tree_leaf_rows": _sql([*_NEIGHBOURS, "training"], f"""
            SELECT t::INTEGER AS tree, n AS rows, 1::BIGINT AS leaves_beyond_splits FROM range(100) r(t),
              (SELECT count(*) AS n FROM training WHERE {_SPARSE} AND POLLER_TIME < {SECOND_WEEK}
                 AND {_draw("POLLER_TIME", "NEW_BUS_ID", "SITE")} < 0.67)"""),
        "carried_series": f"WITH ev AS ({CTES['ev']}), fine AS ({_fine_steps()}) SELECT shard, time, "
            + ", ".join(f"round({v} + 1e-9, 6) AS values_{i}" for i, v in enumerate(_V)) + " FROM fine",
        "forecast_targets": f"WITH ev AS ({CTES['ev']}), fine AS ({_fine_steps()}) {_forecast_targets()}",
        "one_lag_regression": _sql(["ev"], """
            SELECT event_type AS device, round(regr_intercept(y, x) + 1e-9, 6) AS intercept, round(regr_slope(y, x) + 1e-9, 6) AS slope
            FROM (SELECT event_type, v AS x, lead(v) OVER (PARTITION BY event_type, shard ORDER BY slot) AS y
                  FROM (SELECT event_type, user_id % 3 AS shard, t // 3600 AS slot, avg(value) AS v FROM ev GROUP BY ALL))
            WHERE y IS NOT NULL GROUP BY event_type"""),
        "zero_values": _sql([*_ENRICHED, "valid"], """
            SELECT TARGET_ID, POLLER_TIME, METRIC_NAME, NEW_BUS_ID, m AS MEASURED_VALUE,
                   CASE WHEN METRIC_NAME = 'utilization' THEN nullif(m, 0) END AS "utilization_VALUE",
                   CASE WHEN METRIC_NAME = 'used' THEN nullif(m, 0) END AS "used_VALUE"
            FROM (SELECT *, floor(MEASURED_VALUE / 50) * 50.0 AS m FROM valid)"""),
        "top_customers": "SELECT * FROM (" + _rank(
            "SELECT CAST(o_custkey AS VARCHAR) AS NEW_BUS_ID, count(o_orderkey) AS n FROM orders GROUP BY 1") + ") WHERE RANK <= 150",
    }
