"""Independent DuckDB formulations of the catalogue queries.

They start from the raw ``events`` view and never parse JSON: the property
rows of a message are computed directly, the linked text with an ordered
``string_agg``, and change detection compares the property's own value with
``lag`` -- a different route to the same answer as the Spark plans.
"""

from __future__ import annotations

from devdelta.config import LINKED_PROPERTIES, PATH_A_BOUND_MS, PATH_B_IDLE_TTL_MS
from devdelta.sources.fixtures import EVENT_PROPERTIES, N_PARTITIONS

_LINKED = ", ".join(f"'{n}'" for n in LINKED_PROPERTIES)
_NAME = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{n}'" for e, n in EVENT_PROPERTIES) + " END"

# Property rows of the derived snapshot messages.
PROPERTY_CTES = f"""
ev AS (
  SELECT user_id, event_id, ts, event_type, CAST(ts AS DATE) AS day,
         epoch_us(ts) // 1000 AS ms,
         CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS code
  FROM events
),
msg AS (
  SELECT user_id, day, min(event_id) AS first_event_id, max(ms) AS last_ms FROM ev GROUP BY user_id, day
),
latest AS (
  SELECT * FROM (
    SELECT ev.*, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY ts DESC, event_id DESC) AS rn
    FROM ev) WHERE rn = 1
),
prop AS (
  SELECT l.user_id, l.day, {_NAME} AS name, l.code, l.ms AS t, m.first_event_id, m.last_ms
  FROM latest l JOIN msg m ON l.user_id = m.user_id AND l.day = m.day
),
grp AS (
  SELECT user_id, day,
         string_agg(name || ':' || CAST(code AS VARCHAR), ',' ORDER BY name) AS gtext,
         string_agg(name || ':', ',' ORDER BY name) AS gori
  FROM prop WHERE name IN ({_LINKED}) GROUP BY user_id, day
),
pe AS (
  SELECT 'T' || CAST(p.user_id % 3 AS VARCHAR) AS deviceType,
         'iot' || CAST(p.user_id AS VARCHAR) AS iotId,
         CAST(p.first_event_id AS VARCHAR) AS requestId,
         '{{}}' AS checkFailedData,
         'P' || CAST(p.user_id % 5 AS VARCHAR) AS productKey,
         p.t AS gmtCreate,
         'dev' || CAST(p.user_id AS VARCHAR) AS deviceName,
         p.name AS eventName,
         CASE WHEN p.name IN ({_LINKED}) THEN g.gtext ELSE p.name || ':' || CAST(p.code AS VARCHAR) END AS eventValue,
         CASE WHEN p.name IN ({_LINKED}) THEN g.gori ELSE p.name || ':' END AS eventOriValue,
         p.code AS code, p.user_id, p.day, p.first_event_id, p.last_ms
  FROM prop p LEFT JOIN grp g ON p.user_id = g.user_id AND p.day = g.day
),
lagged AS (
  SELECT pe.*,
         lag(code) OVER w AS prev_code,
         lag(eventValue) OVER w AS prev_value,
         row_number() OVER w AS rn
  FROM pe
  WINDOW w AS (PARTITION BY productKey, deviceName, eventName ORDER BY gmtCreate)
),
changes AS (
  SELECT deviceType, iotId, requestId, checkFailedData, productKey, gmtCreate, deviceName, eventName, eventValue,
         CASE WHEN rn = 1 THEN eventOriValue ELSE prev_value END AS eventOriValue
  FROM lagged WHERE rn = 1 OR code <> prev_code
)"""

_GROUP_ORDER = "CASE name " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(LINKED_PROPERTIES)) + " END"

# Path B: whole messages, previous message of the same device, group texts in
# the fixed group order with a leading comma.
SNAPSHOT_CTES_TEMPLATE = """
items_json AS (
  SELECT user_id, day,
         '{{' || string_agg('"' || name || '":{{"value":' || CAST(code AS VARCHAR) || ',"time":' || CAST(t AS VARCHAR) || '}}',
                            ',' ORDER BY name) || '}}' AS items
  FROM prop GROUP BY user_id, day
),
msgs0 AS (
  SELECT m.user_id, m.day, m.first_event_id, m.last_ms,
         row_number() OVER (PARTITION BY m.user_id ORDER BY m.last_ms) AS rn0,
         lag(m.day) OVER (PARTITION BY m.user_id ORDER BY m.last_ms) AS prev_day0,
         m.last_ms - lag(m.last_ms) OVER (PARTITION BY m.user_id ORDER BY m.last_ms) AS gap
  FROM msg m
),
msgs AS (
  SELECT m0.*, CASE WHEN {idle} THEN 1 ELSE m0.rn0 END AS rn, CASE WHEN {idle} THEN NULL ELSE m0.prev_day0 END AS prev_day
  FROM msgs0 m0
),
env AS (
  SELECT ms.*, 'T' || CAST(ms.user_id % 3 AS VARCHAR) AS deviceType,
         'iot' || CAST(ms.user_id AS VARCHAR) AS iotId,
         CAST(ms.first_event_id AS VARCHAR) AS requestId,
         '{{}}' AS checkFailedData,
         'P' || CAST(ms.user_id % 5 AS VARCHAR) AS productKey,
         ms.last_ms AS gmtCreate,
         'dev' || CAST(ms.user_id AS VARCHAR) AS deviceName
  FROM msgs ms
),
bgrp AS (
  SELECT user_id, day, string_agg(',' || name || ':' || CAST(code AS VARCHAR), '' ORDER BY {_GROUP_ORDER}) AS g
  FROM prop WHERE name IN ({_LINKED}) GROUP BY user_id, day
),
diff AS (
  SELECT e.deviceType, e.iotId, e.requestId, e.checkFailedData, e.productKey, e.gmtCreate, e.deviceName,
         'ErrorCode' AS event_name,
         'ErrorCode:' || coalesce((SELECT CAST(p.code AS VARCHAR) FROM prop p
                                   WHERE p.user_id = e.user_id AND p.day = e.day AND p.name = 'ErrorCode'), '0')
           AS event_value,
         'ErrorCode:' AS event_ori_value
  FROM env e WHERE e.rn = 1
  UNION ALL
  SELECT e.deviceType, e.iotId, e.requestId, e.checkFailedData, e.productKey, e.gmtCreate, e.deviceName,
         n.name AS event_name,
         CASE WHEN n.name IN ({_LINKED}) THEN gn.g ELSE n.name || ':' || CAST(n.code AS VARCHAR) END AS event_value,
         CASE WHEN n.name IN ({_LINKED}) THEN go.g ELSE n.name || ':' || CAST(o.code AS VARCHAR) END AS event_ori_value
  FROM env e
  JOIN prop n ON n.user_id = e.user_id AND n.day = e.day
  JOIN prop o ON o.user_id = e.user_id AND o.day = e.prev_day AND o.name = n.name
  LEFT JOIN bgrp gn ON gn.user_id = e.user_id AND gn.day = e.day
  LEFT JOIN bgrp go ON go.user_id = e.user_id AND go.day = e.prev_day
  WHERE e.rn > 1 AND n.code <> o.code
)"""

SNAPSHOT_CTES = SNAPSHOT_CTES_TEMPLATE.format(_LINKED=_LINKED, _GROUP_ORDER=_GROUP_ORDER, idle="FALSE")
# Idle expiry: a device silent for more than 24 h starts over.
SNAPSHOT_IDLE_CTES = SNAPSHOT_CTES_TEMPLATE.format(
    _LINKED=_LINKED, _GROUP_ORDER=_GROUP_ORDER, idle=f"coalesce(m0.gap > {PATH_B_IDLE_TTL_MS}, FALSE)"
)

EVENT_COLS = (
    "deviceType, iotId, requestId, checkFailedData, productKey, gmtCreate, deviceName, "
    "eventName, eventValue, eventOriValue"
)


def _with(body: str) -> str:
    return f"WITH {PROPERTY_CTES}\n{body}"


def _with_b(body: str, ctes: str | None = None) -> str:
    return f"WITH {PROPERTY_CTES},{ctes or SNAPSHOT_CTES}\n{body}"


_BEAN = sorted(c.strip() for c in EVENT_COLS.split(","))


# Irregular messages, one per event: what each kind must come to.
EDGE_CTES = f"""
ev AS (
  SELECT user_id, event_id, event_id % 16 AS kind, epoch_us(ts) // 1000 AS ms,
         CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS code, user_id % {N_PARTITIONS} AS part
  FROM events
),
e AS (
  SELECT *, CASE WHEN kind IN (9, 10, 11) THEN NULL ELSE 'T' || CAST(user_id % 3 AS VARCHAR) END AS deviceType,
         'iot' || CAST(user_id AS VARCHAR) AS iotId, CAST(event_id AS VARCHAR) AS requestId, '{{}}' AS checkFailedData,
         'P' || CAST(user_id % 5 AS VARCHAR) AS productKey, 'dev' || CAST(user_id AS VARCHAR) AS deviceName,
         CASE kind WHEN 1 THEN CAST(code AS VARCHAR) || '.0' WHEN 2 THEN CASE WHEN code % 2 = 0 THEN 'On' ELSE 'ON' END
                   WHEN 3 THEN CASE WHEN code % 2 = 0 THEN 'a:b' ELSE 'a:c' END ELSE CAST(code AS VARCHAR) END AS v
  FROM ev
)"""


ORACLE: dict[str, str] = {
    "edge_change_log": f"""
WITH {EDGE_CTES},
p AS (
  SELECT *, CASE WHEN kind = 12 THEN ms - ms % 3600000 ELSE ms END AS t,
         CASE kind WHEN 14 THEN 'null' WHEN 15 THEN '' ELSE v END AS txt
  FROM e WHERE kind NOT IN (5, 6, 7, 8, 9)
),
d AS (SELECT *, row_number() OVER (PARTITION BY user_id, t ORDER BY part, event_id) AS dup FROM p),
l AS (
  SELECT *, lag(txt) OVER w AS prev, row_number() OVER w AS rn
  FROM d WHERE dup = 1 WINDOW w AS (PARTITION BY user_id ORDER BY t)
)
SELECT deviceType, iotId, requestId, checkFailedData, productKey, t AS gmtCreate, deviceName, 'Mode' AS eventName,
       'Mode:' || txt AS eventValue, CASE WHEN rn = 1 THEN 'Mode:' ELSE 'Mode:' || prev END AS eventOriValue
FROM l WHERE rn = 1 OR split_part(txt, ':', 1) <> split_part(prev, ':', 1)""",
    "edge_snapshot_diff": f"""
WITH {EDGE_CTES},
p AS (
  SELECT *, CASE WHEN kind = 11 THEN '7' ELSE deviceType END AS dt,
         CASE WHEN kind IN (6, 14) THEN NULL WHEN kind = 15 THEN '{{"a":1}}' ELSE v END AS txt
  FROM e WHERE kind <> 7
),
l AS (
  SELECT *, lag(txt) OVER w AS prev, row_number() OVER w AS rn
  FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ms, part, event_id)
)
SELECT dt AS deviceType, iotId, requestId, checkFailedData, productKey, ms AS gmtCreate, deviceName,
       CASE WHEN rn = 1 THEN 'ErrorCode' ELSE 'Mode' END AS event_name,
       CASE WHEN rn = 1 THEN 'ErrorCode:0' ELSE 'Mode:' || txt END AS event_value,
       CASE WHEN rn = 1 THEN 'ErrorCode:' ELSE 'Mode:' || coalesce(prev, 'null') END AS event_ori_value
FROM l WHERE rn = 1 OR (txt IS NOT NULL AND (prev IS NULL OR lower(txt) <> lower(prev)))""",
    "parse_envelope": _with(
        """
SELECT 'T' || CAST(m.user_id % 3 AS VARCHAR) AS deviceType,
       'iot' || CAST(m.user_id AS VARCHAR) AS iotId,
       CAST(m.first_event_id AS VARCHAR) AS requestId,
       '{}' AS checkFailedData,
       'P' || CAST(m.user_id % 5 AS VARCHAR) AS productKey,
       'dev' || CAST(m.user_id AS VARCHAR) AS deviceName,
       m.first_event_id AS "offset",
       (SELECT string_agg(p.name, ',' ORDER BY p.name) FROM prop p
         WHERE p.user_id = m.user_id AND p.day = m.day) AS item_names
FROM msg m"""
    ),
    "explode_properties": _with(
        f"SELECT {EVENT_COLS} FROM pe WHERE eventName NOT IN ({_LINKED})"
    ),
    "linked_group": _with(f"SELECT {EVENT_COLS} FROM pe WHERE eventName IN ({_LINKED})"),
    "first_seen": _with(f"SELECT {EVENT_COLS} FROM lagged WHERE rn = 1"),
    "change_log": _with(f"SELECT {EVENT_COLS} FROM changes"),
    "snapshot_lag": _with_b(
        """
SELECT e.deviceType, e.iotId, e.requestId, e.checkFailedData, e.productKey, e.gmtCreate, e.deviceName,
       i.items AS newData,
       lag(i.items) OVER (PARTITION BY e.user_id ORDER BY e.gmtCreate) AS oldData
FROM env e JOIN items_json i ON i.user_id = e.user_id AND i.day = e.day"""
    ),
    "snapshot_diff": _with_b("SELECT * FROM diff"),
    "snapshot_diff_idle": _with_b("SELECT * FROM diff", SNAPSHOT_IDLE_CTES),
    "sink_rows": _with(
        "SELECT productKey || '-' || deviceName AS key, CAST(to_json(struct_pack("
        + ", ".join(f"{c} := {c}" for c in _BEAN)
        + ")) AS VARCHAR) AS value FROM changes"
    ),
    "snapshot_sink_rows": _with_b(
        "SELECT CAST(to_json(struct_pack("
        + "deviceType := deviceType, iotId := iotId, requestId := requestId, checkFailedData := checkFailedData, "
        + "productKey := productKey, gmtCreate := gmtCreate, deviceName := deviceName, eventName := event_name, "
        + "eventValue := event_value, eventOriValue := event_ori_value)) AS VARCHAR) AS value FROM diff"
    ),
    "stream_change_log": _with(
        "SELECT " + EVENT_COLS + " FROM changes"
    ),
    "stream_late": _with(
        f"""
, bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM msg),
mid AS (SELECT lo + CAST(floor((hi - lo) / 2) AS INTEGER) AS mid FROM bounds),
wm AS (SELECT max(ms) - {PATH_A_BOUND_MS} - 1 AS wm FROM ev, mid WHERE day >= mid),
timed AS (SELECT ev.*, wm, wm - 1 + event_id % 3 AS t FROM ev, wm)
SELECT {EVENT_COLS} FROM pe, mid WHERE pe.day < mid
UNION ALL
SELECT 'T' || CAST(user_id % 3 AS VARCHAR), 'iot' || CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), '{{}}',
       'P' || CAST(user_id % 5 AS VARCHAR), t, 'dev' || CAST(user_id AS VARCHAR), 'Edge',
       'Edge:' || CAST(code AS VARCHAR), 'Edge:'
FROM timed WHERE t <= wm"""
    ),
    "stream_min_watermark": _with(
        f"""
, bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM msg),
cut AS (SELECT lo + CAST(floor((hi - lo) / 2) AS INTEGER) AS mid, lo + CAST(floor((hi - lo) / 4) AS INTEGER) AS quarter FROM bounds),
placed AS (
  SELECT pe.*, user_id % {N_PARTITIONS} < {N_PARTITIONS // 2} AS fast,
         CASE WHEN user_id % {N_PARTITIONS} < {N_PARTITIONS // 2} THEN day >= mid ELSE day >= quarter AND day < mid END AS early
  FROM pe, cut
),
wm AS (
  SELECT least((SELECT max(gmtCreate) FROM placed WHERE early AND fast), (SELECT max(gmtCreate) FROM placed WHERE early AND NOT fast))
         - {PATH_A_BOUND_MS} - 1 AS wm
)
SELECT {EVENT_COLS} FROM placed, wm WHERE NOT early AND gmtCreate <= wm"""
    ),
    "stream_from_backfill": _with(f"SELECT {EVENT_COLS} FROM changes"),
    "stream_committed": _with(f"SELECT {EVENT_COLS} FROM changes"),
    "incremental_change_log": _with(f"SELECT {EVENT_COLS} FROM changes"),
    "bucketed_change_log": _with(f"SELECT {EVENT_COLS} FROM changes"),
    "stream_snapshots_from_backfill": _with_b("SELECT * FROM diff"),
    "sql_lateral_diff": _with_b("SELECT * FROM diff"),
    "sql_insert_into": _with_b(
        "SELECT deviceType, iotId, requestId, checkFailedData, productKey, gmtCreate, deviceName, "
        "event_name AS eventName, event_value AS eventValue, event_ori_value AS eventOriValue FROM diff"
    ),
    "stream_drop_counts": """
WITH k AS (SELECT event_id % 23 AS kind FROM events)
SELECT 'bad_key' AS cause, count(*) AS n FROM k WHERE kind = 2
UNION ALL SELECT 'not_object', count(*) FROM k WHERE kind IN (3, 4, 5)
UNION ALL SELECT 'missing_field', count(*) FROM k WHERE kind BETWEEN 6 AND 12
UNION ALL SELECT 'no_items', count(*) FROM k WHERE kind IN (13, 14, 15)
UNION ALL SELECT 'property_not_object', count(*) FROM k WHERE kind = 16
UNION ALL SELECT 'property_incomplete', count(*) FROM k WHERE kind IN (17, 18)
UNION ALL SELECT 'bad_time', count(*) FROM k WHERE kind = 19""",
    "gate_change_log": f"""
WITH ev AS (
  SELECT user_id, event_id, event_id % 23 AS kind, epoch_us(ts) // 1000 AS ms,
         CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS VARCHAR) AS code, user_id % {N_PARTITIONS} AS part
  FROM events
),
p AS (
  SELECT *, 'Mode' AS name, CASE kind WHEN 19 THEN ms * 1000000 ELSE ms END AS t,
         CASE kind WHEN 20 THEN '123456789012345678' || code ELSE code END AS v
  FROM ev WHERE kind IN (0, 1, 16, 17, 18, 19, 20)
  UNION ALL
  SELECT ev.*, n.name, ms, code FROM ev, (VALUES ('MultiStageName'), ('RStOvState')) n(name) WHERE kind IN (21, 22)
),
d AS (SELECT *, row_number() OVER (PARTITION BY user_id, name, t ORDER BY part, event_id) AS dup FROM p),
e AS (
  SELECT *, CASE WHEN name = 'Mode' THEN 'Mode:' || v ELSE 'MultiStageName:' || v || ',RStOvState:' || v END AS value,
         CASE WHEN name = 'Mode' THEN 'Mode:' ELSE 'MultiStageName:,RStOvState:' END AS ori
  FROM d WHERE dup = 1
),
l AS (SELECT *, lag(v) OVER w AS prev_v, lag(value) OVER w AS prev, row_number() OVER w AS rn
      FROM e WINDOW w AS (PARTITION BY user_id, name ORDER BY t))
SELECT 'T' || CAST(user_id % 3 AS VARCHAR) AS deviceType, 'iot' || CAST(user_id AS VARCHAR) AS iotId,
       CAST(event_id AS VARCHAR) AS requestId, '{{}}' AS checkFailedData, 'P' || CAST(user_id % 5 AS VARCHAR) AS productKey,
       t AS gmtCreate, 'dev' || CAST(user_id AS VARCHAR) AS deviceName, name AS eventName, value AS eventValue,
       CASE WHEN rn = 1 THEN ori ELSE prev END AS eventOriValue
FROM l WHERE rn = 1 OR v <> prev_v""",
    "stream_snapshot_diff": _with_b(
        "SELECT * FROM diff"
    ),
    "sql_get_diff": _with_b("SELECT * FROM diff"),
    "stream_snapshot_diff_idle": _with_b("SELECT * FROM diff", SNAPSHOT_IDLE_CTES),
    "dedup_same_time": f"""
WITH ev AS (
  SELECT user_id, event_id, event_type, CAST(ts AS DATE) AS day,
         CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS code
  FROM events
),
r AS (
  SELECT ev.*, {_NAME} AS name,
         row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY user_id % {N_PARTITIONS}, event_id) AS rn
  FROM ev
)
SELECT 'T' || CAST(user_id % 3 AS VARCHAR) AS deviceType,
       'iot' || CAST(user_id AS VARCHAR) AS iotId,
       CAST(event_id AS VARCHAR) AS requestId,
       '{{}}' AS checkFailedData,
       'P' || CAST(user_id % 5 AS VARCHAR) AS productKey,
       epoch_ms(CAST(day AS TIMESTAMP)) AS gmtCreate,
       'dev' || CAST(user_id AS VARCHAR) AS deviceName,
       name AS eventName,
       name || ':' || CAST(code AS VARCHAR) AS eventValue,
       name || ':' AS eventOriValue,
       event_id AS "offset"
FROM r WHERE rn = 1""",
}
