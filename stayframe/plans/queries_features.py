"""Registered queries: lag features, global order, sort/top-k/union,
filters, contracts, window attributes and joins (LAG1-LAG5, ORD1, WIN7,
SRT1-SRT3, SET1, FLT4-FLT6, PRJ2-PRJ4, WIN1, WIN3, WIN5, WIN6, JON1-JON4,
JON8, AGG4, AGG13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.config import ADMISSION, INTIME, LABEL, STAY, TIME, WINDOW
from stayframe.functions import iso_string
from stayframe.operators.aggregates import first_window, lab_windows, silver_windows, vitals_by_window
from stayframe.operators.contracts import assert_contract, bound_violations, fill_flags
from stayframe.operators.filters import clean_ranges, range_drop_report, restrict_to
from stayframe.operators.joins import (
    attach_admission_stays,
    attach_admission_stays_within,
    attach_labs,
    attach_stays,
    join_blocks,
    labs_for_stays,
)
from stayframe.operators.ordering import global_prefix, global_rank, sort_rows, top_k, first_n, union_parts
from stayframe.operators.temporal import add_lags, assemble_v3, lags_from_previous, missing_trend, previous_window_map
from stayframe.operators.windows import calendar_parts, parse_times, replay_schedule, temporal_attributes, window_count
from stayframe.plans import oracle as Q
from stayframe.plans.catalog import gold_doubles, inputs, register
from stayframe.plans.mappings import EVENTS_CFG, LINEITEM_CFG, table
from stayframe.plans.medallion import batch_matrix, gold_table
from stayframe.plans.queries_eval import _score_sql, scored_gold


def _gold(spark, sf_dir, m):
    x = inputs(spark, sf_dir, m)
    return gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg), x


def _lag_sql(cfg, n_missing_type="INTEGER", lag_type="DOUBLE") -> str:
    w = "OVER (PARTITION BY stay_id ORDER BY icu_hours_elapsed)"
    cols = []
    for c in cfg.lag_base_columns():
        cols += [f"lag({c}) {w} AS {c}_lag1", f"{c} - lag({c}) {w} AS {c}_delta"]
    miss = " + ".join(f"vital_{i}_missing" for i in cfg.vital_items)
    return f"""
lagged AS (
  SELECT *, {', '.join(cols)},
         CAST({miss} AS {n_missing_type}) AS n_missing_vitals,
         CAST(lag({miss}) {w} AS {lag_type}) AS n_missing_vitals_lag1,
         CAST(({miss}) - lag({miss}) {w} AS {lag_type}) AS missing_trend
  FROM gold)"""


# LAG1 + LAG2 -----------------------------------------------------------------
def _lag12(spark, sf_dir):
    g, x = _gold(spark, sf_dir, "lineitem")
    out = add_lags(g, x.cfg.lag_base_columns(), window_hours=x.cfg.window_hours)
    cols = [c for b in x.cfg.lag_base_columns() for c in (f"{b}_lag1", f"{b}_delta")]
    return out.select(STAY, "window_end", *cols, "gap_windows")


_lag_cols = [c for b in LINEITEM_CFG.lag_base_columns() for c in (f"{b}_lag1", f"{b}_delta")]
register(
    "LAG1_LAG2_lags_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT stay_id, window_end, {', '.join(_lag_cols)},
       round((icu_hours_elapsed - lag(icu_hours_elapsed) OVER (PARTITION BY stay_id ORDER BY icu_hours_elapsed))
             / {LINEITEM_CFG.window_hours}) AS gap_windows
FROM lagged""",
        _lag_sql(LINEITEM_CFG),
    ),
    _lag_cols + ["gap_windows"],
)(_lag12)


# LAG1 + LAG4, stays cut into time slices of four windows ---------------------
def _lag_slices(spark, sf_dir):
    g, x = _gold(spark, sf_dir, "events")
    hours = 4 * x.cfg.window_hours
    out = add_lags(g, x.cfg.lag_base_columns(), slice_hours=hours)
    out = missing_trend(out, x.cfg.vital_missing_columns(), slice_hours=hours)
    cols = [c for b in x.cfg.lag_base_columns() for c in (f"{b}_lag1", f"{b}_delta")]
    return out.select(STAY, "window_end", *cols, "n_missing_vitals_lag1", "missing_trend")


_slice_cols = [c for b in EVENTS_CFG.lag_base_columns() for c in (f"{b}_lag1", f"{b}_delta")]
register(
    "LAG1_LAG4_sliced_lags_events",
    Q.with_mapping(
        "events",
        f"SELECT stay_id, window_end, {', '.join(_slice_cols)}, n_missing_vitals_lag1, missing_trend FROM lagged",
        _lag_sql(EVENTS_CFG),
    ),
    _slice_cols + ["n_missing_vitals_lag1", "missing_trend"],
)(_lag_slices)


# LAG4 ------------------------------------------------------------------------
def _lag4(spark, sf_dir):
    g, x = _gold(spark, sf_dir, "events")
    return missing_trend(g, x.cfg.vital_missing_columns()).select(
        STAY, "window_end", "n_missing_vitals", "n_missing_vitals_lag1", "missing_trend"
    )


register(
    "LAG4_missing_trend_events",
    Q.with_mapping(
        "events",
        "SELECT stay_id, window_end, n_missing_vitals, n_missing_vitals_lag1, missing_trend FROM lagged",
        _lag_sql(EVENTS_CFG),
    ),
    ["n_missing_vitals_lag1", "missing_trend"],
)(_lag4)


# LAG5 ------------------------------------------------------------------------
for _m, _cfg in (("events", EVENTS_CFG), ("lineitem", LINEITEM_CFG)):

    def _lag5(spark, sf_dir, m=_m):
        g, x = _gold(spark, sf_dir, m)
        return assemble_v3(g, x.cfg)

    register(
        f"LAG5_v3_features_{_m}",
        Q.with_mapping(
            _m,
            f"SELECT stay_id, window_end, sepsis_label, {', '.join(_cfg.v3_feature_columns())} FROM lagged",
            _lag_sql(_cfg),
        ),
        gold_doubles(_cfg)
        + [c for b in _cfg.lag_base_columns() for c in (f"{b}_lag1", f"{b}_delta")]
        + ["n_missing_vitals_lag1", "missing_trend"],
    )(_lag5)


# LAG3 ------------------------------------------------------------------------
def _lag3(spark, sf_dir):
    g, x = _gold(spark, sf_dir, "events")
    req = previous_window_map(g, x.cfg)
    out = lags_from_previous(req, x.cfg)
    return out.select(STAY, "window_end", *x.cfg.lag_feature_columns(), "n_missing_vitals", "n_missing_vitals_lag1", "missing_trend")


register(
    "LAG3_lags_from_previous_events",
    Q.with_mapping(
        "events",
        f"""SELECT stay_id, window_end, {', '.join(EVENTS_CFG.lag_feature_columns())},
       n_missing_vitals, n_missing_vitals_lag1, missing_trend FROM lagged""",
        _lag_sql(EVENTS_CFG, "DOUBLE", "DOUBLE"),
    ),
    EVENTS_CFG.lag_feature_columns() + ["n_missing_vitals", "n_missing_vitals_lag1", "missing_trend"],
)(_lag3)


# ORD1 ------------------------------------------------------------------------
def _ord1(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    o = o.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    r = global_prefix(o.select("o_orderkey", "o_orderdate", "cents", F.lit(1).cast("long").alias("one")), order, ["cents", "one"])
    return r.select("o_orderkey", "o_orderdate", (F.col("one_cum") - 1).alias("position"), F.col("cents_cum").alias("running_cents"))


register(
    "ORD1_global_prefix_orders",
    """SELECT o_orderkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM orders""",
)(_ord1)


# WIN7 ------------------------------------------------------------------------
def _win7(spark, sf_dir):
    ev = table(spark, sf_dir, "events", ["event_id", "ts"])
    return replay_schedule(ev, 100.0, ts="ts", tiebreak=["event_id"]).select(
        "event_id", "ts", "emit_offset_seconds", "delay_seconds"
    )


register(
    "WIN7_replay_schedule_events",
    """SELECT event_id, ts,
       datediff('microsecond', min(ts) OVER (), ts) / 100000000.0 AS emit_offset_seconds,
       coalesce(greatest(0.0, datediff('microsecond', lag(ts) OVER (ORDER BY ts, event_id), ts) / 100000000.0), 0.0)
         AS delay_seconds
FROM events""",
    ["emit_offset_seconds", "delay_seconds"],
)(_win7)


# SRT1 / SRT2 / SRT3 / SET1 ---------------------------------------------------
def _srt1(spark, sf_dir):
    from stayframe.operators.ordering import global_position

    x = inputs(spark, sf_dir, "events")
    return global_position(sort_rows(x.vitals, TIME, STAY, "itemid", "valuenum"))


register(
    "SRT1_sort_events",
    Q.with_mapping(
        "events",
        "SELECT *, row_number() OVER (ORDER BY charttime, stay_id, itemid, valuenum NULLS FIRST) - 1 AS position FROM vitals",
        pipeline=False,
    ),
    ["valuenum"],
)(_srt1)


def _srt2(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return top_k(p.select(STAY, "window_end", "sepsis_prob", "sepsis_alert", LABEL), "sepsis_prob", 10, [STAY, "window_end"])


register(
    "SRT2_top_k_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT stay_id, window_end, sepsis_prob, sepsis_alert, sepsis_label FROM pred "
        "ORDER BY sepsis_prob DESC, stay_id, window_end LIMIT 10",
        _score_sql("lineitem"),
    ),
    ["sepsis_prob"],
)(_srt2)


def _srt3(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    return first_n(x.stays, [STAY], 20)


register(
    "SRT3_first_n_events",
    Q.with_mapping("events", "SELECT * FROM stays ORDER BY stay_id LIMIT 20", pipeline=False),
)(_srt3)


def _set1(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    v = x.vitals.withColumn("kind", F.lit("vital"))
    lab = attach_admission_stays(x.labs, x.stays, cols=(STAY,)).drop(ADMISSION).withColumn("kind", F.lit("lab"))
    return union_parts(v, lab)


register(
    "SET1_union_events",
    Q.with_mapping(
        "events",
        """SELECT stay_id, charttime, itemid, valuenum, 'vital' AS kind FROM vitals
UNION ALL
SELECT s.stay_id, l.charttime, l.itemid, l.valuenum, 'lab' FROM labs l JOIN stays s ON l.hadm_id = s.hadm_id""",
        pipeline=False,
    ),
    ["valuenum"],
)(_set1)


# FLT4 / FLT5 / FLT6 ----------------------------------------------------------
def _flt4(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    return restrict_to(x.vitals, x.labels.where(F.col(LABEL) == 1))


register(
    "FLT4_restrict_to_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT * FROM vitals WHERE stay_id IN (SELECT stay_id FROM labels WHERE sepsis_label = 1)",
        pipeline=False,
    ),
    ["valuenum"],
)(_flt4)

_RANGES_SQL = "ranges(itemid, lo, hi) AS (VALUES " + ", ".join(
    f"({Q.lit(k)}, {float(lo)}, {float(hi)})" for k, (lo, hi) in LINEITEM_CFG.ranges.items()
) + ")"


def _flt5(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    return clean_ranges(x.vitals, x.cfg.ranges)


register(
    "FLT5_clean_ranges_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT v.itemid, v.stay_id, v.charttime, v.valuenum FROM vitals v JOIN ranges r ON v.itemid = r.itemid
WHERE v.valuenum BETWEEN r.lo AND r.hi""",
        _RANGES_SQL,
        pipeline=False,
    ),
    ["valuenum"],
)(_flt5)


def _flt6(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    return range_drop_report(x.vitals, x.cfg.ranges)


register(
    "FLT6_range_drop_report_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT CAST(v.itemid AS VARCHAR) AS item, count(*) AS n_before,
       count(*) FILTER (WHERE v.valuenum BETWEEN r.lo AND r.hi) AS n_kept,
       100.0 * (1.0 - count(*) FILTER (WHERE v.valuenum BETWEEN r.lo AND r.hi) / count(*)) AS pct_dropped
FROM vitals v JOIN ranges r ON v.itemid = r.itemid GROUP BY v.itemid
UNION ALL
SELECT 'total', count(*), count(*) FILTER (WHERE r.itemid IS NOT NULL AND v.valuenum BETWEEN r.lo AND r.hi),
       100.0 * (1.0 - count(*) FILTER (WHERE r.itemid IS NOT NULL AND v.valuenum BETWEEN r.lo AND r.hi) / count(*))
FROM vitals v LEFT JOIN ranges r ON v.itemid = r.itemid""",
        _RANGES_SQL,
        pipeline=False,
    ),
    ["pct_dropped"],
)(_flt6)


# PRJ2 / PRJ3 / PRJ4 ----------------------------------------------------------
def _prj2(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    m = batch_matrix(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    return assert_contract(m, x.cfg.gold_columns(), {"stay_id": "bigint", "window_end": "timestamp_ntz"}, exact=True)


def _batch_ref(name):
    from stayframe.plans.catalog import REGISTRY

    return REGISTRY[name].sql


register("PRJ2_contract_batch_lineitem", _batch_ref("AGG5_batch_matrix_lineitem"), gold_doubles(LINEITEM_CFG))(_prj2)


def _prj3(spark, sf_dir):
    g, _ = _gold(spark, sf_dir, "lineitem")
    return bound_violations(g)


def _prj3_sql():
    rules = []
    for c in LINEITEM_CFG.gold_columns():
        if c.endswith("_missing"):
            rules.append((f"{c} in (0,1)", f"{c} IN (0, 1)"))
    rules.append(("icu_hours_elapsed >= 0", "icu_hours_elapsed >= 0"))
    rules.append(("time_of_day in 0..23", "time_of_day BETWEEN 0 AND 23"))
    parts = [
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({cond}, true)) AS n_violations, count(*) AS n_rows FROM gold"
        for name, cond in rules
    ]
    return "\nUNION ALL\n".join(parts)


register("PRJ3_bound_violations_lineitem", Q.with_mapping("lineitem", _prj3_sql()))(_prj3)


def _prj4(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    j = attach_labs(silver_windows(x.vitals, x.stays, x.cfg), lab_windows(x.labs, x.stays, x.cfg))
    j = fill_flags(j, {f"lab_{i}_missing": 1 for i in x.cfg.lab_items})
    return j.select(STAY, WINDOW, *[f"lab_{i}_missing" for i in x.cfg.lab_items])


register(
    "PRJ4_fill_flags_events",
    Q.with_mapping(
        "events",
        "SELECT stay_id, window_id, "
        + ", ".join(f"lab_{i}_missing" for i in EVENTS_CFG.lab_items)
        + " FROM gold",
    ),
)(_prj4)


# WIN1 / WIN3 / WIN5 / WIN6 ---------------------------------------------------
def _win1(spark, sf_dir):
    ev = table(spark, sf_dir, "events", ["event_id", "ts"])
    txt = ev.select("event_id", iso_string("ts").alias("ts_text"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_plain"))
    parsed = parse_times(txt.withColumn("parsed_iso", F.col("ts_text")).withColumn("parsed_plain", F.col("ts_plain")), ["parsed_iso", "parsed_plain"])
    return parsed


def _iso_sql(c):
    return (
        f"CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


register(
    "WIN1_parse_times_events",
    f"""SELECT event_id, {_iso_sql('ts')} AS ts_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_plain,
       ts AS parsed_iso, date_trunc('second', ts) AS parsed_plain
FROM events""",
)(_win1)


def _win5(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    s = silver_windows(x.vitals, x.stays, x.cfg)
    end = temporal_attributes(s, x.cfg, "end").withColumnRenamed("icu_hours_elapsed", "elapsed_end")
    both = temporal_attributes(end, x.cfg, "mid").withColumnRenamed("icu_hours_elapsed", "elapsed_mid")
    return both.select(STAY, WINDOW, "window_end", "elapsed_end", "elapsed_mid", "time_of_day", "window_date")


register(
    "WIN3_WIN5_window_attributes_events",
    Q.with_mapping(
        "events",
        f"""SELECT stay_id, window_id, window_end, CAST(window_id + 1 AS DOUBLE) * {EVENTS_CFG.window_hours} AS elapsed_end,
       CAST(window_id AS DOUBLE) * {EVENTS_CFG.window_hours} + {EVENTS_CFG.window_hours / 2} AS elapsed_mid,
       CAST(hour(window_end) AS INTEGER) AS time_of_day, window_date FROM silver""",
    ),
    ["elapsed_end", "elapsed_mid"],
    ["window_date"],
)(_win5)


def _win6(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    return calendar_parts(x.stays, INTIME).select(STAY, INTIME, "admit_hour", "admit_dow")


register(
    "WIN6_calendar_parts_events",
    Q.with_mapping(
        "events",
        "SELECT stay_id, intime, CAST(hour(intime) AS INTEGER) AS admit_hour, dayname(intime) AS admit_dow FROM stays",
        pipeline=False,
    ),
)(_win6)


# JON1 / JON2 / JON4 / JON8 / AGG4 / AGG13 ------------------------------------
def _jon1(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    return attach_stays(x.vitals, x.stays, cols=(INTIME, ADMISSION))


register(
    "JON1_attach_stays_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT v.stay_id, v.charttime, v.itemid, v.valuenum, s.intime, s.hadm_id FROM vitals v JOIN stays s ON v.stay_id = s.stay_id",
        pipeline=False,
    ),
    ["valuenum"],
)(_jon1)


def _jon2(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    return attach_admission_stays(x.labs, x.stays)


register(
    "JON2_labs_to_stays_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT l.hadm_id, l.charttime, l.itemid, l.valuenum, s.stay_id, s.intime FROM labs l JOIN stays s ON l.hadm_id = s.hadm_id",
        pipeline=False,
    ),
    ["valuenum"],
)(_jon2)


def _jon2_within(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    stays = x.stays.withColumn("n_windows", window_count(x.cfg))
    return attach_admission_stays_within(x.labs, stays, x.cfg, span=2)


register(
    "JON2_interval_join_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT l.hadm_id, l.charttime, l.itemid, l.valuenum, s.stay_id, s.intime FROM labs l JOIN stays s ON l.hadm_id = s.hadm_id
WHERE l.charttime >= s.intime AND epoch_us(l.charttime) - epoch_us(s.intime)
      < greatest(1, (epoch_us(s.outtime) - epoch_us(s.intime)) // {LINEITEM_CFG.window_micros}) * {LINEITEM_CFG.window_micros}""",
        pipeline=False,
    ),
    ["valuenum"],
)(_jon2_within)


def _jon4(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    v = vitals_by_window(x.vitals, x.stays, x.cfg).select(STAY, WINDOW, *[f"vital_{i}_mean" for i in x.cfg.vital_items])
    lab = lab_windows(x.labs, x.stays, x.cfg).select(STAY, WINDOW, *[f"lab_{i}_last" for i in x.cfg.lab_items])
    return join_blocks(v, lab, how="full_outer")


_jon4_cols = [f"vital_{i}_mean" for i in LINEITEM_CFG.vital_items] + [f"lab_{i}_last" for i in LINEITEM_CFG.lab_items]
register(
    "JON4_join_blocks_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT coalesce(v.stay_id, l.stay_id) AS stay_id, coalesce(v.window_id, l.window_id) AS window_id,
       {', '.join('v.vital_' + str(i) + '_mean' for i in LINEITEM_CFG.vital_items)},
       {', '.join('l.lab_' + str(i) + '_last' for i in LINEITEM_CFG.lab_items)}
FROM vagg v FULL OUTER JOIN labw l ON v.stay_id = l.stay_id AND v.window_id = l.window_id""",
    ),
    _jon4_cols,
)(_jon4)


def _jon8(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    return labs_for_stays(x.labs, x.stays, x.labels.where(F.col(LABEL) == 1))


register(
    "JON8_labs_for_stays_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT l.hadm_id, l.charttime, l.itemid, l.valuenum, s.stay_id
FROM labs l JOIN (SELECT hadm_id, stay_id FROM stays WHERE stay_id IN (SELECT stay_id FROM labels WHERE sepsis_label = 1)) s
  ON l.hadm_id = s.hadm_id""",
        pipeline=False,
    ),
    ["valuenum"],
)(_jon8)


def _agg4(spark, sf_dir):
    g, x = _gold(spark, sf_dir, "lineitem")
    flags = x.cfg.vital_missing_columns() + [f"lab_{i}_missing" for i in x.cfg.lab_items]
    return g.select(STAY, "window_end", *flags)


register(
    "AGG4_missing_flags_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT stay_id, window_end, "
        + ", ".join(LINEITEM_CFG.vital_missing_columns() + [f"lab_{i}_missing" for i in LINEITEM_CFG.lab_items])
        + " FROM gold",
    ),
)(_agg4)


def _agg13(spark, sf_dir):
    g, _ = _gold(spark, sf_dir, "lineitem")
    return first_window(g)


register(
    "AGG13_first_window_lineitem",
    Q.with_mapping("lineitem", "SELECT stay_id, min(window_end) AS first_window_end FROM gold GROUP BY stay_id"),
)(_agg13)



# JON3 / JON5 / JON6 ----------------------------------------------------------
def _jon3(spark, sf_dir):
    from stayframe.operators.joins import fill_grid
    from stayframe.operators.windows import window_grid

    x = inputs(spark, sf_dir, "lineitem")
    grid = window_grid(x.stays, x.cfg).select(STAY, WINDOW)
    v = vitals_by_window(x.vitals, x.stays, x.cfg).select(
        STAY, WINDOW, *[f"vital_{i}_mean" for i in x.cfg.vital_items], *x.cfg.vital_missing_columns()
    )
    return fill_grid(grid, v)


def _jon3_sql():
    n = (
        "greatest(1, coalesce(CAST(floor(datediff('microsecond', intime, outtime) / "
        f"{LINEITEM_CFG.window_micros}.0) AS BIGINT), 1))"
    )
    cols = [f"v.vital_{i}_mean" for i in LINEITEM_CFG.vital_items] + [f"v.{c}" for c in LINEITEM_CFG.vital_missing_columns()]
    return Q.with_mapping(
        "lineitem",
        f"""SELECT g.stay_id, g.window_id, {', '.join(cols)}
FROM grid g LEFT JOIN vagg v ON g.stay_id = v.stay_id AND g.window_id = v.window_id""",
        f"grid AS (SELECT stay_id, CAST(unnest(range(0, {n})) AS INTEGER) AS window_id FROM stays)",
    )


register("JON3_fill_grid_lineitem", _jon3_sql(), [f"vital_{i}_mean" for i in LINEITEM_CFG.vital_items])(_jon3)


def _jon5(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    s = silver_windows(x.vitals, x.stays, x.cfg).select(STAY, WINDOW, "window_end")
    return attach_labs(s, lab_windows(x.labs, x.stays, x.cfg))


_jon5_cols = [c for i in EVENTS_CFG.lab_items for c in (f"lab_{i}_last", f"lab_{i}_missing")]
register(
    "JON5_attach_labs_events",
    Q.with_mapping(
        "events",
        f"""SELECT s.stay_id, s.window_id, s.window_end, {', '.join('lw.' + c for c in _jon5_cols)}
FROM silver s LEFT JOIN labw lw ON s.stay_id = lw.stay_id AND s.window_id = lw.window_id""",
    ),
    [f"lab_{i}_last" for i in EVENTS_CFG.lab_items],
)(_jon5)


def _jon6(spark, sf_dir):
    from stayframe.operators.joins import attach_labels

    x = inputs(spark, sf_dir, "events")
    s = silver_windows(x.vitals, x.stays, x.cfg).select(STAY, WINDOW)
    return attach_labels(s, x.labels)


register(
    "JON6_attach_labels_events",
    Q.with_mapping(
        "events",
        """SELECT s.stay_id, s.window_id, lb.sepsis_label, lb.stay_id IS NOT NULL AS label_known
FROM silver s LEFT JOIN labels lb ON s.stay_id = lb.stay_id""",
    ),
)(_jon6)
