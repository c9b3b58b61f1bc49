"""Compositions of the operators into the Silver, Gold, batch-matrix and
feature tables.  Each takes DataFrames and returns a lazy DataFrame: one
Catalyst plan per table, no eager counts in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import ITEM, LABEL, STAY, TIME, VALUE, WINDOW, WindowConfig
from stayframe.operators.aggregates import BOUND, lab_windows, lab_windows_dealt, silver_windows, stays_within_vitals, vitals_by_window
from stayframe.operators.contracts import assert_contract, fill_flags, project
from stayframe.operators.joins import attach_labels, attach_labs, fill_grid, join_blocks
from stayframe.operators.windows import GRID_KEY, deal_by_block, parse_times, temporal_attributes, window_count, window_grid
from stayframe.session import fans_out_far, grid_stays, join_as_dealt, shuffle_width


def gold_table(
    vitals: DataFrame,
    labs: DataFrame,
    stays: DataFrame,
    labels: DataFrame,
    cfg: WindowConfig,
    elapsed_at: str = "mid",
    keep_window: bool = False,
) -> DataFrame:
    """Gold: Silver ⟕ lab windows ⟕ labels, flags filled, temporal
    attributes, exactly the contract's columns (43 for 6 vitals, 4 labs).

    ``keep_window`` also keeps ``window_id`` and ``window_date`` (partition
    key for the sink) after the contract columns.  On large tables the labs
    only fan out to the windows that Silver can hold.
    """
    silver = silver_windows(vitals, stays, cfg)
    if fans_out_far(stays.sparkSession):
        stays = stays_within_vitals(stays, vitals, cfg)
    return gold_from_silver(silver, labs, stays, labels, cfg, elapsed_at, keep_window)


def gold_from_silver(
    silver: DataFrame,
    labs: DataFrame,
    stays: DataFrame,
    labels: DataFrame,
    cfg: WindowConfig,
    elapsed_at: str = "mid",
    keep_window: bool = False,
) -> DataFrame:
    """Gold of a Silver table, computed or read back from where it was stored.
    Labels go on first: Silver still lies by stay then, and only one wide
    table moves.  Stays that carry ``n_windows`` must reach Silver's last
    windows; labs past them take no part."""
    labw = lab_windows(labs, stays, cfg)
    j = attach_labs(attach_labels(silver, labels), labw)
    defaults = {f"lab_{i}_missing": 1 for i in cfg.lab_items}
    defaults[LABEL] = 0
    j = fill_flags(j, defaults)
    j = temporal_attributes(j, cfg, elapsed_at)
    cols = cfg.gold_columns()
    if keep_window:
        return project(j, cols + [WINDOW, "window_date"])
    return assert_contract(project(j, cols), cols, exact=True)


def batch_matrix(
    vitals: DataFrame,
    labs: DataFrame,
    cohort: DataFrame,
    labels: DataFrame | None,
    cfg: WindowConfig,
    elapsed_at: str = "end",
) -> DataFrame:
    """AGG5: dense feature matrix over the window grid (every stay, every
    full window, empty windows kept with missing flags 1; readings after the
    last full window are dropped).

    Grid and both aggregate blocks are keyed by ``(stay_id, window_id)``;
    the batch loop over groups of stays of a single-machine version is not
    needed: the shuffle partitions the work.  On large tables the grid
    stays where its blocks of windows were dealt out, and both aggregate blocks
    come to it, so the exploded grid never moves.
    """
    if labels is None:  # label carried on the cohort, as in a cohort table
        labels = cohort.select(STAY, LABEL)
    # The label rides on the stay through the grid: a row a stay moves for it, not the matrix.
    labelled = attach_labels(cohort.drop(LABEL), labels)
    far = grid_stays(cohort.sparkSession)
    keys = (STAY, GRID_KEY, WINDOW) if far else (STAY, WINDOW)
    grid = window_grid(labelled, cfg, keep=(LABEL,), keep_block=far).select(*keys, "window_end", LABEL)
    # Readings past a stay's last full window never reach the aggregates.
    bounded = cohort.withColumn(BOUND, window_count(cfg))
    v = vitals_by_window(vitals, bounded, cfg).drop("intime")
    if far:
        join_as_dealt(cohort.sparkSession)  # a stay and block share 4,096 windows at most
        width = shuffle_width(cohort.sparkSession)
        v, lw = deal_by_block(v, width), lab_windows_dealt(labs, bounded, cfg, width)
    else:
        lw = lab_windows(labs, bounded, cfg)
    m = join_blocks(fill_grid(grid, v, keys), lw, keys, how="left")
    defaults = {f"vital_{i}_missing": 1 for i in cfg.vital_items}
    defaults.update({f"lab_{i}_missing": 1 for i in cfg.lab_items})
    defaults[LABEL] = 0
    m = fill_flags(m, defaults)
    m = temporal_attributes(m, cfg, elapsed_at)
    cols = cfg.gold_columns()
    return assert_contract(project(m, cols), cols, exact=True)


def bronze_readings(bronze: DataFrame, event_type: str) -> DataFrame:
    """Well-formed readings of one event type from the stored Bronze table,
    with parsed times (WIN1): ``stay_id, charttime, itemid, valuenum``."""
    good = bronze.where((F.col("event_type") == event_type) & ~F.col("is_malformed"))
    return parse_times(good.select(STAY, TIME, ITEM, VALUE))
