"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark plans, from the operator semantics: the
test mappings as CTEs over the driver's views, then plain SQL for windows,
conditional aggregates, ``arg_max`` for latest values and window functions
for lags and cumulative sums.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from stayframe.config import WindowConfig
from stayframe.plans import mappings as M


def lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def in_list(items) -> str:
    return ", ".join(lit(i) for i in items)


EVENTS_CTES = f"""
per_user AS (
  SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts,
         max(CASE WHEN event_type = 'error' AND value > {M.EVENTS_LABEL_THRESHOLD} THEN 1 ELSE 0 END) AS sepsis_label
  FROM events GROUP BY user_id),
stays AS (
  SELECT user_id AS stay_id, CAST(user_id // 2 AS BIGINT) AS hadm_id, user_id AS subject_id,
         date_trunc('hour', first_ts) + INTERVAL {M.EVENTS_START_OFFSET_HOURS} HOUR AS intime,
         last_ts AS outtime
  FROM per_user),
labels AS (SELECT user_id AS stay_id, CAST(sepsis_label AS INTEGER) AS sepsis_label FROM per_user),
vitals AS (
  SELECT user_id AS stay_id, ts AS charttime, event_type AS itemid, value AS valuenum
  FROM events WHERE event_type IN ({in_list(M.EVENTS_VITALS)})),
labs AS (
  SELECT CAST(user_id // 2 AS BIGINT) AS hadm_id, ts AS charttime, event_type AS itemid, value AS valuenum
  FROM events WHERE event_type IN ({in_list(M.EVENTS_LABS)})),
patients AS (SELECT c_custkey AS subject_id, c_acctbal / 100.0 AS anchor_age FROM customer)"""

LINEITEM_CTES = f"""
stays AS (
  SELECT o_orderkey AS stay_id, o_custkey AS hadm_id, o_custkey AS subject_id,
         o_orderdate AS intime, o_orderdate + INTERVAL {M.ORDERS_STAY_DAYS} DAY AS outtime
  FROM orders),
labels AS (
  SELECT o_orderkey AS stay_id,
         CAST(CASE WHEN substr(o_orderpriority, 1, 1) IN ({in_list(M.ORDERS_LABEL_PREFIXES)}) THEN 1 ELSE 0 END AS INTEGER) AS sepsis_label
  FROM orders),
vitals AS (
  SELECT l_orderkey AS stay_id, l_shipdate AS charttime, l_returnflag || l_linestatus AS itemid,
         l_extendedprice AS valuenum
  FROM lineitem),
labs AS (
  SELECT o.o_custkey AS hadm_id, l.l_shipdate AS charttime, l.l_linenumber AS itemid,
         l.l_extendedprice AS valuenum
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
patients AS (SELECT c_custkey AS subject_id, c_acctbal / 100.0 AS anchor_age FROM customer)"""

MAPPING_CTES = {"events": EVENTS_CTES, "lineitem": LINEITEM_CTES}
MAPPING_CFG = {"events": M.EVENTS_CFG, "lineitem": M.LINEITEM_CFG}


def window_id_sql(start: str, ts: str, cfg: WindowConfig) -> str:
    return f"CAST(floor(datediff('microsecond', {start}, {ts}) / {cfg.window_micros}.0) AS INTEGER)"


def window_end_sql(start: str, wid: str, cfg: WindowConfig) -> str:
    return f"{start} + to_seconds(CAST({wid} + 1 AS BIGINT) * {int(cfg.window_seconds)})"


def pipeline_ctes(cfg: WindowConfig) -> str:
    """Windowed vitals/labs, Silver, lab windows and Gold as CTEs."""
    vit_aggs = []
    for i in cfg.vital_items:
        v = f"CASE WHEN itemid = {lit(i)} THEN valuenum END"
        vit_aggs += [
            f"avg({v}) AS vital_{i}_mean",
            f"min({v}) AS vital_{i}_min",
            f"max({v}) AS vital_{i}_max",
            f"stddev_samp({v}) AS vital_{i}_std",
            f"CAST(CASE WHEN count({v}) = 0 THEN 1 ELSE 0 END AS INTEGER) AS vital_{i}_missing",
        ]
    lab_aggs = []
    for i in cfg.lab_items:
        lab_aggs += [
            f"arg_max(valuenum, (charttime, valuenum)) FILTER (WHERE itemid = {lit(i)}) AS lab_{i}_last",
            f"CAST(CASE WHEN count(valuenum) FILTER (WHERE itemid = {lit(i)}) = 0 THEN 1 ELSE 0 END AS INTEGER) AS lab_{i}_missing",
        ]
    lab_cols = []
    for i in cfg.lab_items:
        lab_cols += [f"lw.lab_{i}_last", f"CAST(COALESCE(lw.lab_{i}_missing, 1) AS INTEGER) AS lab_{i}_missing"]
    wh = cfg.window_seconds / 3600.0
    return f"""
vw AS (
  SELECT v.stay_id, v.itemid, v.valuenum, v.charttime, s.intime,
         {window_id_sql('s.intime', 'v.charttime', cfg)} AS window_id
  FROM vitals v JOIN stays s ON v.stay_id = s.stay_id
  WHERE v.itemid IN ({in_list(cfg.vital_items)}) AND v.valuenum IS NOT NULL AND NOT isnan(v.valuenum)
    AND v.charttime >= s.intime),
vagg AS (
  SELECT stay_id, window_id, min(intime) AS intime, {', '.join(vit_aggs)}
  FROM vw GROUP BY stay_id, window_id),
silver AS (
  SELECT stay_id, window_id, {window_end_sql('intime', 'window_id', cfg)} AS window_end,
         {', '.join(cfg.vital_columns())},
         CAST({window_end_sql('intime', 'window_id', cfg)} AS DATE) AS window_date
  FROM vagg),
lwin AS (
  SELECT s.stay_id, l.itemid, l.valuenum, l.charttime,
         {window_id_sql('s.intime', 'l.charttime', cfg)} AS window_id
  FROM labs l JOIN stays s ON l.hadm_id = s.hadm_id
  WHERE l.itemid IN ({in_list(cfg.lab_items)}) AND l.valuenum IS NOT NULL AND NOT isnan(l.valuenum)
    AND l.charttime >= s.intime),
labw AS (
  SELECT stay_id, window_id, {', '.join(lab_aggs)}
  FROM lwin GROUP BY stay_id, window_id),
gold AS (
  SELECT s.stay_id, s.window_end, {', '.join('s.' + c for c in cfg.vital_columns())},
         {', '.join(lab_cols)},
         CAST(s.window_id AS DOUBLE) * {wh} + {wh / 2.0} AS icu_hours_elapsed,
         CAST(hour(s.window_end) AS INTEGER) AS time_of_day,
         CAST(COALESCE(lb.sepsis_label, 0) AS INTEGER) AS sepsis_label,
         s.window_id, s.window_date
  FROM silver s LEFT JOIN labw lw ON s.stay_id = lw.stay_id AND s.window_id = lw.window_id
  LEFT JOIN labels lb ON s.stay_id = lb.stay_id)"""


def with_mapping(mapping: str, body: str, extra_ctes: str = "", pipeline: bool = True) -> str:
    cfg = MAPPING_CFG[mapping]
    ctes = MAPPING_CTES[mapping]
    if pipeline:
        ctes += "," + pipeline_ctes(cfg)
    if extra_ctes:
        ctes += "," + extra_ctes
    return f"WITH {ctes}\n{body}"


def rounded(sql: str, double_cols, date_cols=()) -> str:
    """Round the listed double columns of a query's output to 6 places and
    render date columns as ISO text."""
    # Spark rounds a double half-up on its shortest decimal text; rounding
    # that text as a DECIMAL gives the same result at exact decimal ties.
    reps = [
        f"CASE WHEN isinf(\"{c}\") OR isnan(\"{c}\") THEN \"{c}\" "
        f"ELSE CAST(round(CAST(CAST(\"{c}\" AS VARCHAR) AS DECIMAL(38, 12)), 6) AS DOUBLE) END AS \"{c}\""
        for c in double_cols
    ]
    reps += [f"CAST(\"{c}\" AS VARCHAR) AS \"{c}\"" for c in date_cols]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM (\n{sql}\n) q"
