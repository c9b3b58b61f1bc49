"""Time parsing and entity-anchored tumbling windows (WIN1-WIN7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import ADMISSION, INTIME, OUTTIME, STAY, TIME, WINDOW, WindowConfig
from stayframe.functions import add_seconds, elapsed_micros, parse_ntz, window_index
from stayframe.session import shuffle_width


def parse_times(df: DataFrame, columns: Sequence[str] = (TIME,)) -> DataFrame:
    """WIN1: ISO or ``YYYY-MM-DD HH:MM:SS`` text to TIMESTAMP_NTZ; bad text
    becomes NULL rather than failing the job."""
    out = df
    for c in columns:
        if dict(df.dtypes).get(c) == "string":
            out = out.withColumn(c, parse_ntz(c))
    return out


def assign_window(df: DataFrame, cfg: WindowConfig, start: str = INTIME, ts: str = TIME) -> DataFrame:
    """WIN2: ``window_id = floor((ts - start) / W)`` in microseconds, so a
    reading exactly on a boundary goes to the next window."""
    return df.withColumn(WINDOW, window_index(start, ts, cfg.window_seconds))


def window_bounds(df: DataFrame, cfg: WindowConfig, start: str = INTIME, with_start: bool = False) -> DataFrame:
    """WIN3: ``window_end = start + (i+1)W`` (and ``window_start``), plus the
    ``window_date`` partition key (date of the window end)."""
    w = int(cfg.window_seconds)
    i = F.col(WINDOW).cast("long")
    end = add_seconds(start, (i + F.lit(1)) * F.lit(w))
    cols = {"window_start": add_seconds(start, i * F.lit(w))} if with_start else {}
    cols.update({"window_end": end, "window_date": F.to_date(end)})
    return df.withColumns(cols)


GRID_BLOCK = 4096
GRID_KEY = "_blk"


def deal_by_block(df: DataFrame, partitions: int, block: int = GRID_BLOCK) -> DataFrame:
    """Rows of windows on the partitions of a dense grid of the same number of
    partitions: by stay and block of windows, kept as ``GRID_KEY``. What is
    joined to the grid on (stay, block, window) then needs no further move."""
    return df.withColumn(GRID_KEY, F.floor(F.col(WINDOW) / F.lit(block)).cast("int")).repartition(partitions, STAY, GRID_KEY)


def window_count(cfg: WindowConfig, start: str = INTIME, end: str = OUTTIME):
    """Full windows of a stay: ``max(1, floor(LOS / W))``, 1 where the length is unknown."""
    full = F.floor(elapsed_micros(start, end) / F.lit(cfg.window_micros))
    return F.greatest(F.lit(1), F.coalesce(full, F.lit(1)).cast("int"))


def window_grid(cohort: DataFrame, cfg: WindowConfig, block: int = GRID_BLOCK, keep: Sequence[str] = (), keep_block: bool = False) -> DataFrame:
    """WIN4: dense grid, ``n = max(1, floor(LOS / W))`` windows per stay.

    Stays with a NULL length get one window; every stay is kept.  Every stay
    goes the same way, without a join: it is exploded into blocks of window
    indices, the blocks (about one row per stay) are dealt out by (stay,
    block), and each is exploded into its indices, so an enormous length (a
    bad discharge time) is built by many tasks and never as one giant array.
    The count is explicit as AQE would merge the tiny block rows into one task.
    ``keep`` names stay columns that each window repeats; ``keep_block`` keeps
    the block (``GRID_KEY``), by which the rows stay dealt out.
    """
    base = cohort.select(STAY, ADMISSION, INTIME, *keep, window_count(cfg).alias("_n"))
    last = F.floor((F.col("_n") - F.lit(1)) / F.lit(block)).cast("int")
    blocks = base.select("*", F.explode(F.sequence(F.lit(0), last)).alias(GRID_KEY))
    blocks = blocks.repartition(shuffle_width(cohort.sparkSession), STAY, GRID_KEY)
    lo = F.col(GRID_KEY) * F.lit(block)
    hi = F.least(F.col("_n"), lo + F.lit(block)) - F.lit(1)
    keep = (*keep, GRID_KEY) if keep_block else keep
    grid = blocks.select(STAY, ADMISSION, INTIME, *keep, F.explode(F.sequence(lo, hi)).alias(WINDOW))
    return window_bounds(grid, cfg, with_start=True).select(
        STAY, ADMISSION, INTIME, WINDOW, "window_start", "window_end", *keep
    )


def temporal_attributes(df: DataFrame, cfg: WindowConfig, elapsed_at: str = "end") -> DataFrame:
    """WIN5: hours since the start at the window ``end`` (batch matrix) or
    ``mid`` point (Gold), and ``time_of_day = hour(window_end)``."""
    w_h = cfg.window_seconds / 3600.0
    i = F.col(WINDOW).cast("double")
    if elapsed_at == "end":
        hours = (i + F.lit(1.0)) * F.lit(w_h)
    elif elapsed_at == "mid":
        hours = i * F.lit(w_h) + F.lit(w_h / 2.0)
    else:
        raise ValueError("elapsed_at must be 'end' or 'mid'")
    return df.withColumns({"icu_hours_elapsed": hours, "time_of_day": F.hour("window_end").cast("int")})


def calendar_parts(df: DataFrame, column: str = INTIME, prefix: str = "admit") -> DataFrame:
    """WIN6: hour of day and English day name of a timestamp."""
    return df.withColumns({f"{prefix}_hour": F.hour(column).cast("int"), f"{prefix}_dow": F.date_format(column, "EEEE")})


def replay_schedule(
    df: DataFrame,
    speed: float = 100.0,
    ts: str = TIME,
    tiebreak: Sequence[str] = (),
    with_delay: bool = True,
) -> DataFrame:
    """WIN7: emit time of each event when a stream is replayed ``speed``
    times faster than real time.

    Events replay in time order; the wait before an event is
    ``max(0, (t - t_prev) / speed)`` (0 for the first) and the emit offset is
    the running sum of waits, which telescopes to ``(t - t_min) / speed``, so
    only a global minimum is needed.  ``delay_seconds`` needs the previous
    event in global order, computed with the distributed ordering primitive
    (no single-partition window).
    """
    from stayframe.operators.ordering import global_previous, with_scalars

    out = with_scalars(df, df.agg(F.min(ts).alias("_tmin"))).withColumn(
        "emit_offset_seconds",
        elapsed_micros("_tmin", ts).cast("double") / F.lit(1e6 * speed),
    ).drop("_tmin")
    if with_delay:
        order = [F.col(ts).asc()] + [F.col(c).asc() for c in tiebreak]
        out = global_previous(out, order, [ts], prefix="_prev_")
        out = out.withColumn(
            "delay_seconds",
            F.coalesce(
                F.greatest(
                    F.lit(0.0),
                    elapsed_micros(f"_prev_{ts}", ts).cast("double") / F.lit(1e6 * speed),
                ),
                F.lit(0.0),
            ),
        ).drop(f"_prev_{ts}")
    return out
