"""Lag, delta and missingness-trend features (LAG1-LAG5).

Lags run over the rows that exist for a stay, ordered by elapsed time, in a
single window specification (one sort per stay for all lag columns).  The
window holds one stay's *windows*, not its readings: its size is bounded by
the stay's time span divided by the window length, however many readings a
hot stay has.  Where one stay may hold a large share of all windows,
``slice_hours`` cuts stays into time slices that are sorted by separate tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stayframe.config import LABEL, STAY, WindowConfig


def over_stays(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    needed: Sequence[str],
    key: str = STAY,
    order: str = "icu_hours_elapsed",
    slice_hours: float | None = None,
) -> DataFrame:
    """``df`` with ``columns(window)``, which may look one row of the stay back
    at the columns ``needed``.

    Without ``slice_hours`` the window is the whole stay.  With it, rows are
    dealt out by (stay, slice of ``order``); the last row of each slice goes
    ahead of the stay's next slice that has rows, so a lag sees it, and is
    dropped again.  Only those last rows, one a slice, are ordered by stay.
    Rows with a NULL ``order`` form the first slice, as they sort first.
    Equal orders of a stay are told apart no better than in a plain window.
    """
    if slice_hours is None:
        return df.withColumns(columns(Window.partitionBy(key).orderBy(F.col(order).asc())))
    first = F.lit(-(2**63)).cast("long")
    rows = df.withColumns({"_slice": F.coalesce(F.floor(F.col(order) / F.lit(float(slice_hours))).cast("long"), first), "_own": F.lit(1)})
    held = F.struct(*dict.fromkeys([*needed, order]))
    tails = rows.groupBy(key, "_slice").agg(F.max_by(held, F.struct(order)).alias("_held"))
    after = F.lead("_slice", 1).over(Window.partitionBy(key).orderBy("_slice"))
    tails = tails.withColumn("_slice", after).where(F.col("_slice").isNotNull()).select(key, "_slice", F.lit(0).alias("_own"), "_held.*")
    window = Window.partitionBy(key, "_slice").orderBy(F.col("_own").asc(), F.col(order).asc())
    out = rows.unionByName(tails, allowMissingColumns=True).withColumns(columns(window))
    return out.where(F.col("_own") == 1).drop("_slice", "_own")


def add_lags(
    df: DataFrame,
    cols: Sequence[str],
    key: str = STAY,
    order: str = "icu_hours_elapsed",
    window_hours: float | None = None,
    slice_hours: float | None = None,
) -> DataFrame:
    """LAG1 + LAG2: ``{c}_lag1`` = value on the previous existing row of the
    stay, ``{c}_delta = c - lag1`` (NULL if either is NULL).  With
    ``window_hours`` also ``gap_windows``: how many windows back that
    previous row lies (sparse tables skip empty windows)."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        new = {}
        for c in cols:
            prev = F.lag(c, 1).over(w)
            new[f"{c}_lag1"] = prev
            new[f"{c}_delta"] = F.col(c) - prev
        if window_hours:
            prev = F.lag(order, 1).over(w)
            new["gap_windows"] = F.round((F.col(order) - prev) / F.lit(window_hours))
        return new

    return over_stays(df, columns, cols, key, order, slice_hours)


def missing_trend(
    df: DataFrame,
    flags: Sequence[str],
    key: str = STAY,
    order: str = "icu_hours_elapsed",
    slice_hours: float | None = None,
) -> DataFrame:
    """LAG4: ``n_missing_vitals`` (row sum of the flags), its lag over the
    stay's rows, and ``missing_trend`` = difference (NULL on the first row)."""
    total = None
    for f in flags:
        term = F.coalesce(F.col(f), F.lit(0)).cast("int")
        total = term if total is None else total + term
    # The lag of a count is a float with NULL for the first row (as the
    # single-machine version's shifted column is).
    def columns(w: WindowSpec) -> dict[str, Column]:
        prev = F.lag(total, 1).over(w).cast("double")
        return {"n_missing_vitals": total, "n_missing_vitals_lag1": prev, "missing_trend": total.cast("double") - prev}

    return over_stays(df, columns, flags, key, order, slice_hours)


def lags_from_previous(
    df: DataFrame,
    cfg: WindowConfig,
    map_col: str = "previous_window",
) -> DataFrame:
    """LAG3: lag/delta from a caller-supplied previous window.

    ``map_col`` is a ``map<string,double>`` of the prior window's base
    features (same names as the row's columns).  A key absent from the map
    gives NULL lag and delta; an empty or NULL map means "no previous
    window", so the missing-count lag and trend are NULL too.
    """
    m = F.col(map_col)
    has_prev = m.isNotNull() & (F.size(m) > 0)
    new = {}
    for c in cfg.lag_base_columns():
        prev = F.when(has_prev, F.try_element_at(m, F.lit(c)))
        new[f"{c}_lag1"] = prev
        new[f"{c}_delta"] = F.col(c) - prev
    total = None
    prev_total = None
    for f in cfg.vital_missing_columns():
        cur = F.when(F.col(f) == 1, F.lit(1.0)).otherwise(F.lit(0.0))
        was = F.when(F.try_element_at(m, F.lit(f)) == 1.0, F.lit(1.0)).otherwise(F.lit(0.0))
        total = cur if total is None else total + cur
        prev_total = was if prev_total is None else prev_total + was
    lag_total = F.when(has_prev, prev_total)
    new.update({"n_missing_vitals": total, "n_missing_vitals_lag1": lag_total, "missing_trend": total - lag_total})
    return df.withColumns(new)


def previous_window_map(df: DataFrame, cfg: WindowConfig, key: str = STAY, order: str = "icu_hours_elapsed") -> DataFrame:
    """Build the ``previous_window`` request map from a table: the prior
    row's base features of the same stay (non-NULL entries only)."""
    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    names = cfg.lag_base_columns() + cfg.vital_missing_columns()
    entries = F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).cast("double").alias("v")) for n in names])
    present = F.filter(entries, lambda e: e["v"].isNotNull())
    as_map = F.map_from_entries(present)
    return df.withColumn("previous_window", F.lag(as_map, 1).over(w))


def assemble_v3(
    df: DataFrame,
    cfg: WindowConfig,
    key: str = STAY,
    order: str = "icu_hours_elapsed",
    keep: Sequence[str] = ("window_end", LABEL),
    slice_hours: float | None = None,
) -> DataFrame:
    """LAG5: keys + the v3 feature contract (base, interleaved lag/delta
    pairs, missingness trend) in contract order."""
    out = add_lags(df, cfg.lag_base_columns(), key, order, slice_hours=slice_hours)
    out = missing_trend(out, cfg.vital_missing_columns(), key, order, slice_hours)
    return out.select(key, *keep, *cfg.v3_feature_columns())
