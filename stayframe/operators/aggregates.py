"""Per-window aggregates (AGG1-AGG6, AGG13).

All aggregates are algebraic or have a partial form (avg, min, max,
stddev_samp, count, max_by), so Spark combines map-side before the shuffle:
a window holding many readings costs one partial row per task, not one row
per reading, and a hot entity spreads over its many windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.config import (
    ADMISSION,
    INTIME,
    ITEM,
    LABEL,
    STAY,
    TIME,
    VALUE,
    WINDOW,
    WindowConfig,
)
from stayframe.functions import flag, window_index
from stayframe.operators.filters import drop_before_start, keep_items, keep_measured
from stayframe.operators.joins import BLOCK, attach_admission_stays, attach_admission_stays_within, attach_stays
from stayframe.operators.windows import GRID_KEY, assign_window, deal_by_block, window_bounds


def _prepared(readings: DataFrame, items) -> DataFrame:
    """FLT1 + FLT2 on a measurement table (FLT2 tests the raw value for NULL
    and NaN, so the null test reaches the scan)."""
    return keep_measured(keep_items(readings, items))


# Optional stay column: number of full windows; readings past them are dropped
# with the window index, before anything is aggregated or shuffled by window.
BOUND = "n_windows"


def _within_grid(df: DataFrame) -> DataFrame:
    return df.where(F.col(WINDOW) < F.col(BOUND)) if BOUND in df.columns else df


def _stay_columns(stays: DataFrame, *cols: str) -> tuple:
    return (*cols, BOUND) if BOUND in stays.columns else cols


def windowed_vitals(vitals: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Readings (stay-keyed) joined to their stay start, pre-start readings
    dropped, window index assigned: the input of every vitals aggregate.
    Stays that carry ``n_windows`` also bound the index from above."""
    ev = _prepared(vitals.select(STAY, TIME, ITEM, VALUE), cfg.vital_items)
    j = drop_before_start(attach_stays(ev, stays, cols=_stay_columns(stays, INTIME)))
    return _within_grid(assign_window(j, cfg))


def windowed_labs(labs: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Readings windowed like vitals: those keyed by stay (resolved before
    they were published) join their stay, those keyed by admission fan out to
    every stay of the admission."""
    if STAY in labs.columns:
        ev = _prepared(labs.select(STAY, TIME, ITEM, VALUE), cfg.lab_items)
        j = attach_stays(ev, stays, cols=_stay_columns(stays, INTIME))
    else:
        ev = _prepared(labs.select(ADMISSION, TIME, ITEM, VALUE), cfg.lab_items)
        cols = _stay_columns(stays, STAY, INTIME)
        j = attach_admission_stays_within(ev, stays, cfg, cols, BOUND, keep_block=True) if BOUND in cols else attach_admission_stays(ev, stays, cols=cols)
    j = drop_before_start(j)
    return _within_grid(assign_window(j, cfg))


def missing_flag(values: Column) -> Column:
    """AGG4: 1 when the window has no non-NULL reading, else 0."""
    return F.when(F.count(values) == 0, F.lit(1)).otherwise(F.lit(0)).cast("int")


def vital_aggregates(cfg: WindowConfig) -> list[Column]:
    """Conditional aggregates: mean/min/max/sample std/missing per item, in
    the contract's column order."""
    out = []
    for i in cfg.vital_items:
        v = F.when(F.col(ITEM) == F.lit(i), F.col(VALUE))
        out += [
            F.avg(v).alias(f"vital_{i}_mean"),
            F.min(v).alias(f"vital_{i}_min"),
            F.max(v).alias(f"vital_{i}_max"),
            F.stddev_samp(v).alias(f"vital_{i}_std"),
            missing_flag(v).alias(f"vital_{i}_missing"),
        ]
    return out


def lab_aggregates(cfg: WindowConfig) -> list[Column]:
    """AGG3: latest value per item as ``max_by(value, charttime)`` over rows
    that are already unique per ``(stay, window, item, charttime)`` (see
    ``lab_windows``), so the choice is deterministic.  Both buffers are
    fixed-width, which keeps the aggregate a hash aggregate with map-side
    partials (a struct ordering key would force a sort aggregate)."""
    out = []
    for i in cfg.lab_items:
        is_item = F.col(ITEM) == F.lit(i)
        v = F.when(is_item, F.col(VALUE))
        out += [
            F.max_by(v, F.when(is_item, F.col(TIME))).alias(f"lab_{i}_last"),
            missing_flag(v).alias(f"lab_{i}_missing"),
        ]
    return out


def vitals_by_window(vitals: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """``(stay_id, window_id, intime)`` + 30 vital columns, windows with at
    least one reading only."""
    w = windowed_vitals(vitals, stays, cfg)
    return w.groupBy(STAY, WINDOW).agg(F.min(INTIME).alias(INTIME), *vital_aggregates(cfg))


def silver_windows(vitals: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """AGG1 (Silver): one row per ``(stay, window)`` holding at least one
    vital reading; no upper bound at discharge (sparse).

    Columns: ``stay_id, window_id, window_end, <vital columns>, window_date``.
    """
    agg = vitals_by_window(vitals, stays, cfg)
    return window_bounds(agg, cfg).select(STAY, WINDOW, "window_end", *cfg.vital_columns(), "window_date")


def pivot_windows(vitals: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """AGG2: the group-then-pivot form of AGG1.  Groups by
    ``(stay, window, item)`` first and pivots on the listed items only (no
    distinct-value job; items absent from the data still get columns).  Gives
    the same rows as ``silver_windows`` and scales to many items where very
    wide conditional aggregates would exceed code-generation limits."""
    w = windowed_vitals(vitals, stays, cfg)
    items = list(cfg.vital_items)
    p = (
        w.groupBy(STAY, WINDOW)
        .pivot(ITEM, items)
        .agg(
            F.min(INTIME).alias("intime"),
            F.avg(VALUE).alias("mean"),
            F.min(VALUE).alias("min"),
            F.max(VALUE).alias("max"),
            F.stddev_samp(VALUE).alias("std"),
            F.count(VALUE).alias("n"),
        )
    )
    start = F.coalesce(*[F.col(f"{i}_intime") for i in items]).alias(INTIME)
    cols = [STAY, WINDOW, start]
    for i in items:
        cols += [
            F.col(f"{i}_mean").alias(f"vital_{i}_mean"),
            F.col(f"{i}_min").alias(f"vital_{i}_min"),
            F.col(f"{i}_max").alias(f"vital_{i}_max"),
            F.col(f"{i}_std").alias(f"vital_{i}_std"),
            flag(F.coalesce(F.col(f"{i}_n"), F.lit(0)) == 0).alias(f"vital_{i}_missing"),
        ]
    out = p.select(*cols)
    return window_bounds(out, cfg).select(STAY, WINDOW, "window_end", *cfg.vital_columns(), "window_date")


def lab_windows_dealt(labs: DataFrame, stays: DataFrame, cfg: WindowConfig, partitions: int) -> DataFrame:
    """``lab_windows`` on the partitions of a dense grid (``deal_by_block``).

    A window's readings collapse on the fan-out join's own partitions to one
    row with each item's latest value and its time, and only those rows move; a
    window that lies across two of the join's time blocks has a row of each.
    Values are never NULL here, so a missing item is one without a value."""
    w = windowed_labs(labs, stays, cfg)
    joined_on = [c for c in (ADMISSION, BLOCK) if c in w.columns]
    at_time = w.groupBy(*joined_on, STAY, WINDOW, ITEM, TIME).agg(F.max(VALUE).alias(VALUE))
    latest = []
    for k, i in enumerate(cfg.lab_items):
        time = F.when(F.col(ITEM) == F.lit(i), F.col(TIME))
        latest += [F.max_by(VALUE, time).alias(f"_last{k}"), F.max(time).alias(f"_time{k}")]
    rows = deal_by_block(at_time.groupBy(*joined_on, STAY, WINDOW).agg(*latest).drop(*joined_on), partitions)
    out = rows.groupBy(STAY, GRID_KEY, WINDOW).agg(*[F.max_by(f"_last{k}", f"_time{k}").alias(f"lab_{i}_last") for k, i in enumerate(cfg.lab_items)])
    return out.withColumns({f"lab_{i}_missing": flag(F.col(f"lab_{i}_last").isNull()) for i in cfg.lab_items})


def lab_windows(labs: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """AGG3 + AGG4 for labs: ``stay_id, window_id`` + (last, missing) per item.

    Latest value = the non-NULL reading with the greatest time; readings of
    one item at the same time resolve to the larger value, on every run and
    input order.  Two hash aggregations: equal-time readings collapse first
    (keyed by stay, window, item and time, so a hot stay-window spreads over
    many tasks), then ``max_by`` per window with map-side partials.

    The first is also keyed by what the fan-out joined on (admission, and the
    time block of bounded stays), which tells no readings of one stay and time
    apart, as a stay has one admission: where the fan-out is a shuffle join it
    runs on the join's own partitions, and only the windows' partials move.
    """
    w = windowed_labs(labs, stays, cfg)
    joined_on = [c for c in (ADMISSION, BLOCK) if c in w.columns]
    at_time = w.groupBy(*joined_on, STAY, WINDOW, ITEM, TIME).agg(F.max(VALUE).alias(VALUE))
    return at_time.groupBy(STAY, WINDOW).agg(*lab_aggregates(cfg))


def stays_within_vitals(stays: DataFrame, vitals: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Stays that have vitals, with ``n_windows`` up to the window of the last
    one: no Silver row of theirs lies further on, so a left join of lab windows
    to Silver needs none beyond. Readings collapse to a time a stay map-side."""
    last = _prepared(vitals.select(STAY, TIME, ITEM, VALUE), cfg.vital_items).groupBy(STAY).agg(F.max(TIME).alias("_last"))
    reached = stays.drop(BOUND).join(last, STAY, "inner")
    return reached.withColumn(BOUND, window_index(INTIME, "_last", cfg.window_seconds) + F.lit(1)).drop("_last")


def one_per_key(df: DataFrame, key: str = STAY, value: str = LABEL) -> DataFrame:
    """AGG6: one row per key; duplicates resolved by ``max`` (deterministic,
    unlike ``dropDuplicates`` which keeps an arbitrary row)."""
    return df.groupBy(key).agg(F.max(value).alias(value))


def first_window(df: DataFrame, key: str = STAY, time: str = "window_end") -> DataFrame:
    """AGG13: earliest ``window_end`` per stay (orders stays for SPL1)."""
    return df.groupBy(key).agg(F.min(time).alias("first_window_end"))
