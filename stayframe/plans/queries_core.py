"""Registered queries for the Silver/Gold/batch-matrix core (AGG1-AGG6,
JON1-JON6, WIN2-WIN5, PRJ1, PRJ2, PRJ4, FLT1-FLT3)."""

from __future__ import annotations

from stayframe.config import LABEL, STAY, WINDOW
from stayframe.operators.aggregates import (
    lab_windows,
    one_per_key,
    pivot_windows,
    silver_windows,
    windowed_vitals,
)
from stayframe.operators.windows import window_grid
from stayframe.plans import oracle as Q
from stayframe.plans.catalog import gold_doubles, inputs, register, silver_doubles
from stayframe.plans.mappings import EVENTS_CFG, LINEITEM_CFG
from stayframe.plans.medallion import batch_matrix, gold_table

CFGS = {"events": EVENTS_CFG, "lineitem": LINEITEM_CFG}


def _grid_sql(cfg) -> str:
    n = (
        f"greatest(1, coalesce(CAST(floor(datediff('microsecond', intime, outtime) / {cfg.window_micros}.0) AS BIGINT), 1))"
    )
    return f"""
grid AS (
  SELECT stay_id, hadm_id, intime, CAST(unnest(range(0, {n})) AS INTEGER) AS window_id FROM stays)"""


def _batch_sql(cfg) -> str:
    vit = []
    for i in cfg.vital_items:
        vit += [
            f"v.vital_{i}_mean",
            f"v.vital_{i}_min",
            f"v.vital_{i}_max",
            f"v.vital_{i}_std",
            f"CAST(COALESCE(v.vital_{i}_missing, 1) AS INTEGER) AS vital_{i}_missing",
        ]
    lab = []
    for i in cfg.lab_items:
        lab += [f"lw.lab_{i}_last", f"CAST(COALESCE(lw.lab_{i}_missing, 1) AS INTEGER) AS lab_{i}_missing"]
    wh = cfg.window_seconds / 3600.0
    end = Q.window_end_sql("g.intime", "g.window_id", cfg)
    return f"""
SELECT g.stay_id, {end} AS window_end, {', '.join(vit)}, {', '.join(lab)},
       CAST(g.window_id + 1 AS DOUBLE) * {wh} AS icu_hours_elapsed,
       CAST(hour({end}) AS INTEGER) AS time_of_day,
       CAST(COALESCE(lb.sepsis_label, 0) AS INTEGER) AS sepsis_label
FROM grid g
LEFT JOIN vagg v ON g.stay_id = v.stay_id AND g.window_id = v.window_id
LEFT JOIN labw lw ON g.stay_id = lw.stay_id AND g.window_id = lw.window_id
LEFT JOIN labels lb ON g.stay_id = lb.stay_id"""


for _m, _cfg in CFGS.items():

    def _silver(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return silver_windows(x.vitals, x.stays, x.cfg)

    register(
        f"AGG1_silver_{_m}",
        Q.with_mapping(_m, f"SELECT * FROM silver"),
        silver_doubles(_cfg),
        ["window_date"],
    )(_silver)

    def _pivot(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return pivot_windows(x.vitals, x.stays, x.cfg)

    register(
        f"AGG2_pivot_{_m}", Q.with_mapping(_m, "SELECT * FROM silver"), silver_doubles(_cfg), ["window_date"]
    )(_pivot)

    def _labw(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return lab_windows(x.labs, x.stays, x.cfg)

    register(
        f"AGG3_lab_windows_{_m}",
        Q.with_mapping(_m, "SELECT * FROM labw"),
        [f"lab_{i}_last" for i in _cfg.lab_items],
    )(_labw)

    def _gold(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)

    register(
        f"GOLD_{_m}",
        Q.with_mapping(_m, f"SELECT {', '.join(_cfg.gold_columns())} FROM gold"),
        gold_doubles(_cfg),
    )(_gold)

    def _batch(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return batch_matrix(x.vitals, x.labs, x.stays, x.labels, x.cfg)

    register(
        f"AGG5_batch_matrix_{_m}",
        Q.with_mapping(_m, _batch_sql(_cfg), _grid_sql(_cfg)),
        gold_doubles(_cfg),
    )(_batch)

    def _grid(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return window_grid(x.stays, x.cfg)

    register(
        f"WIN4_grid_{_m}",
        Q.with_mapping(
            _m,
            f"SELECT stay_id, hadm_id, intime, window_id, "
            f"intime + to_seconds(CAST(window_id AS BIGINT) * {int(_cfg.window_seconds)}) AS window_start, "
            f"{Q.window_end_sql('intime', 'window_id', _cfg)} AS window_end FROM grid",
            _grid_sql(_cfg),
        ),
    )(_grid)


def _windowed(spark, sf_dir):
    """WIN1-WIN3 + JON1 + FLT1-FLT3 on every vital reading of mapping A."""
    x = inputs(spark, sf_dir, "events")
    w = windowed_vitals(x.vitals, x.stays, x.cfg)
    from stayframe.operators.windows import window_bounds

    return window_bounds(w, x.cfg, with_start=True).select(
        STAY, "charttime", "itemid", "valuenum", WINDOW, "window_start", "window_end", "window_date"
    )


register(
    "WIN2_assign_window_events",
    Q.with_mapping(
        "events",
        "SELECT stay_id, charttime, itemid, valuenum, window_id, "
        f"intime + to_seconds(CAST(window_id AS BIGINT) * {int(EVENTS_CFG.window_seconds)}) AS window_start, "
        f"{Q.window_end_sql('intime', 'window_id', EVENTS_CFG)} AS window_end, "
        f"CAST({Q.window_end_sql('intime', 'window_id', EVENTS_CFG)} AS DATE) AS window_date FROM vw",
    ),
    ["valuenum"],
    ["window_date"],
)(_windowed)


def _labels(spark, sf_dir):
    """AGG6: one label per stay from a table with one row per window."""
    x = inputs(spark, sf_dir, "lineitem")
    g = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    return one_per_key(g.select(STAY, LABEL))


register(
    "AGG6_one_per_key_lineitem",
    Q.with_mapping("lineitem", "SELECT stay_id, max(sepsis_label) AS sepsis_label FROM gold GROUP BY stay_id"),
)(_labels)
