"""Group-preserving splits and class weights (SPL1-SPL3, MDL1).

Whole stays go to one split.  Stays are ranked with the distributed prefix
sum (no single-partition window); cut positions use double arithmetic like
``int(n * 0.70)`` (a decimal literal would round 90 * 0.70 up to 63).  The
input is read twice, to rank the stays and to take their split, so split a
stored table (``splits`` of a Gold table read back), not a plan that computes
one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import LABEL, STAY
from stayframe.functions import safe_div
from stayframe.operators.aggregates import first_window
from stayframe.operators.ordering import global_rank


def _cut(n, frac: float):
    return F.floor(n.cast("double") * F.lit(float(frac)))


def _assign(df: DataFrame, ranked: DataFrame, split_expr, key: str) -> DataFrame:
    assignment = ranked.select(key, split_expr.alias("split"))
    return df.join(assignment, key, "inner")


def temporal_split(
    df: DataFrame,
    key: str = STAY,
    time: str = "window_end",
    fractions: Sequence[float] = (0.70, 0.15),
) -> DataFrame:
    """SPL1: stays ordered by their first ``time`` (tie-break: key); the
    first ``int(.70 n)`` train, the next ``int(.15 n)`` val, the rest test.
    Adds ``split`` to every row."""
    firsts = first_window(df, key, time)
    ranked = global_rank(firsts, [F.col("first_window_end").asc(), F.col(key).asc()], with_count=True)
    n_train = _cut(F.col("n"), fractions[0])
    n_val = _cut(F.col("n"), fractions[1])
    r = F.col("rank")
    split = F.when(r < n_train, "train").when(r < n_train + n_val, "val").otherwise("test")
    return _assign(df, ranked, split, key)


def id_split(df: DataFrame, key: str = STAY, cuts: Sequence[float] = (0.70, 0.85)) -> DataFrame:
    """SPL2: stays ordered by id; cut positions ``int(.70 n)``, ``int(.85 n)``."""
    ids = df.select(key).distinct()
    ranked = global_rank(ids, [F.col(key).asc()], with_count=True)
    r = F.col("rank")
    split = F.when(r < _cut(F.col("n"), cuts[0]), "train").when(r < _cut(F.col("n"), cuts[1]), "val").otherwise("test")
    return _assign(df, ranked, split, key)


def split_summary(df: DataFrame, split: str = "split", label: str = LABEL, key: str = STAY) -> DataFrame:
    """SPL3: rows, stays, positives and % positive per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_stays"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        (F.lit(100.0) * safe_div(F.count_if(F.col(label) == 1), F.count(F.lit(1)))).alias("pct_positive"),
    )


def with_class_weight(
    df: DataFrame,
    label: str = LABEL,
    split: str = "split",
    train_value: str = "train",
    guard: bool = True,
    weight_col: str = "weight",
) -> DataFrame:
    """MDL1: positive-class weight ``neg / pos`` counted on the training
    split, as a per-row ``weight`` (positives get it, negatives 1.0) and as
    ``scale_pos_weight``.  With ``guard`` a split without positives gives
    1.0 instead of NULL."""
    from stayframe.operators.ordering import with_scalars

    tr = df.where(F.col(split) == train_value) if split in df.columns else df
    counts = tr.agg(
        F.count_if(F.col(label) == 0).alias("_neg"),
        F.count_if(F.col(label) == 1).alias("_pos"),
    )
    spw = safe_div("_neg", "_pos")
    if guard:
        spw = F.coalesce(spw, F.lit(1.0))
    counts = counts.select(spw.alias("scale_pos_weight"))
    out = with_scalars(df, counts)
    return out.withColumn(
        weight_col, F.when(F.col(label) == 1, F.col("scale_pos_weight")).otherwise(F.lit(1.0))
    )
