"""Value helpers: NaN normalisation, flags, guarded division, bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """Missing is NULL only: Spark's avg/min/max would treat NaN as a value."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def flag(cond: Column) -> Column:
    """Boolean condition to an int 1/0 flag (NULL condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def right_closed_bucket(x, edges, labels) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]`` holding ``x``.

    Values outside all intervals, or NULL, get NULL (they fall in no bucket).
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    v = _c(x)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr
