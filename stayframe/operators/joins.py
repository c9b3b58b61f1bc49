"""Equi-joins between measurements, stays, windows and labels (JON1-JON8).

No broadcast hints on data-sized sides: with AQE the planner switches a
shuffle join to a broadcast only after measuring the materialised side, and
splits a skewed join partition (one stay holding a large share of the rows)
across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import ADMISSION, INTIME, LABEL, STAY, SUBJECT, TIME, WINDOW, WindowConfig
from stayframe.functions import elapsed_micros


def attach_stays(events: DataFrame, stays: DataFrame, on: str = STAY, cols: Sequence[str] = (INTIME,)) -> DataFrame:
    """JON1: measurements keyed by stay -> inner join to the stay dimension."""
    return events.join(stays.select(on, *[c for c in cols if c != on]), on, "inner")


def attach_admission_stays(labs: DataFrame, stays: DataFrame, cols: Sequence[str] = (STAY, INTIME)) -> DataFrame:
    """JON2: measurements keyed by admission -> every stay of that admission
    (one-to-many; a later stay keeps only readings after its own start once
    the pre-start filter runs)."""
    return labs.join(stays.select(ADMISSION, *cols), ADMISSION, "inner")


BLOCK = "_block"


def attach_admission_stays_within(
    labs: DataFrame, stays: DataFrame, cfg: WindowConfig, cols: Sequence[str] = (STAY, INTIME), bound: str = "n_windows", span: int = 64, keep_block: bool = False
) -> DataFrame:
    """JON2 as an interval join: every pair of a measurement and a stay of its
    admission with ``start <= time < start + bound * W``.

    Time is cut into blocks of ``span`` windows; a stay stands once in each
    block it touches and a measurement in one, so the join's key is
    (admission, block).  A hot admission is split by time, and a measurement
    outside all stays meets at most those that share its block.  Rows with a
    NULL admission, time, start or bound join nothing.  ``keep_block`` keeps the
    block, a function of the time, so that what follows can use the join's
    partitions."""
    block = F.lit(cfg.window_micros * int(span))
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01'")
    since = lambda c: elapsed_micros(epoch, c)
    length = lambda n: F.col(n).cast("long") * F.lit(cfg.window_micros)
    last = F.floor((since(F.col(INTIME)) + length(bound) - 1) / block)
    # Start and bound move once: under their own names where those are kept, else under names that are dropped.
    start, n = INTIME if INTIME in cols else "_from", bound if bound in cols else "_bound"
    own = [F.col(c).alias(a) for c, a in ((INTIME, start), (bound, n)) if a not in cols]
    held = stays.where(F.col(bound) > 0).select(
        ADMISSION, *cols, *own, F.explode(F.sequence(F.floor(since(F.col(INTIME)) / block), last)).alias(BLOCK)
    )
    timed = labs.withColumn(BLOCK, F.floor(since(F.col(TIME)) / block))
    after = since(F.col(TIME)) - since(F.col(start))
    joined = timed.join(held, [ADMISSION, BLOCK], "inner").where((after >= 0) & (after < length(n)))
    return joined.drop("_from", "_bound", *([] if keep_block else [BLOCK]))


def fill_grid(grid: DataFrame, wide: DataFrame, keys: Sequence[str] = (STAY, WINDOW)) -> DataFrame:
    """JON3: dense grid left-joined with window aggregates (empty windows kept)."""
    return grid.join(wide, list(keys), "left")


def join_blocks(vitals: DataFrame, labs: DataFrame, keys: Sequence[str] = (STAY, WINDOW), how: str = "full_outer") -> DataFrame:
    """JON4: vitals block with labs block on ``(stay, window)``.  When both
    blocks are grid-complete the outer join behaves as an inner join."""
    return vitals.join(labs, list(keys), how)


def attach_labs(silver: DataFrame, lab_windows: DataFrame, keys: Sequence[str] = (STAY, WINDOW)) -> DataFrame:
    """JON5: Silver left-joined with lab windows (lab-only windows dropped)."""
    return silver.join(lab_windows, list(keys), "left")


def attach_labels(df: DataFrame, labels: DataFrame, key: str = STAY, label: str = LABEL) -> DataFrame:
    """JON6: left join of the per-stay label, plus ``label_known``."""
    lab = labels.select(key, F.col(label).alias(label), F.lit(True).alias("label_known"))
    j = df.join(lab, key, "left")
    return j.withColumns({"label_known": F.coalesce(F.col("label_known"), F.lit(False))})


def attach_patients(
    df: DataFrame,
    stays: DataFrame,
    patients: DataFrame,
    patient_cols: Sequence[str] = ("anchor_age",),
    key: str = STAY,
    subject: str = SUBJECT,
) -> DataFrame:
    """JON7: predictions -> stays (subject) -> patients, both left joins."""
    s = stays.select(key, subject)
    p = patients.select(subject, *patient_cols)
    return df.join(s, key, "left").join(p, subject, "left")


def labs_for_stays(labs: DataFrame, stays: DataFrame, ids: DataFrame, key: str = STAY) -> DataFrame:
    """JON8: ids -> their admissions -> the labs of those admissions, each row
    tagged with its stay.  The id set is applied as a semi join."""
    chosen = stays.join(ids.select(key), key, "left_semi").select(ADMISSION, key)
    return labs.join(chosen, ADMISSION, "inner")
