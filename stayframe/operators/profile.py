"""Profiling aggregates (AGG7-AGG12, AGG14).

Exact quantiles are computed without gathering a group: equal values are
collapsed to one row with their count (map-side partials, so a value held by
most rows costs one row per task), the counts are prefix-summed in value
order, and the values whose ranks cover the interpolation positions are kept.
This is the same linear interpolation as ``numpy.percentile`` /
``quantile_cont``.  NaN counts as missing everywhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import ITEM, LABEL, SUBJECT, TIME
from stayframe.functions import nan_to_null, safe_div
from stayframe.operators.ordering import global_prefix, with_scalars

SKETCH, SKETCH_ERROR = 4096, 0.001  # size of a quantile sketch, and how far a rank may be off
TERMS, REACH = 21, 9  # of the density's expansion; cells on either side of a grid point's own


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG7: rows per value (NULL is its own value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def rate_by(df: DataFrame, col: str, label: str = LABEL) -> DataFrame:
    """AGG8: rows and mean label x 100 per value of ``col``."""
    return df.groupBy(col).agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg(F.col(label).cast("double")) * F.lit(100.0)).alias("rate_pct"),
    )


def _value_counts(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    v = df.select(*by, nan_to_null(F.col(value).cast("double")).alias(value)).where(F.col(value).isNotNull())
    return v.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_k"))


def _ranked_counts(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """One row per group and distinct value with its rows ``_k``, the rows up to it ``_k_cum`` and the group's ``_k_total``."""
    return global_prefix(_value_counts(df, value, by), [F.col(value).asc()], ["_k"], by, totals=True)


def _quantiles_of(ranked: DataFrame, value: str, probs: Sequence[float], by: Sequence[str], names: Sequence[str]) -> DataFrame:
    n1 = F.col("_k_total").cast("double") - F.lit(1.0)
    # a value's rows have the 0-based ranks _k_cum - _k .. _k_cum - 1
    holds = lambda at: (F.col("_k_cum") - F.col("_k") <= at) & (at < F.col("_k_cum"))
    keep = F.lit(False)
    parts = []
    for p, name in zip(probs, names):
        pos = n1 * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        keep = keep | holds(lo) | holds(hi)
        parts.append((name, lo, hi, pos))
    picked = ranked.where(keep)
    aggs = []
    for name, lo, hi, pos in parts:
        aggs += [
            F.max(F.when(holds(lo), F.col(value))).alias(f"_{name}_lo"),
            F.max(F.when(holds(hi), F.col(value))).alias(f"_{name}_hi"),
            F.max(pos - lo).alias(f"_{name}_frac"),
        ]
    g = picked.groupBy(*by).agg(*aggs)
    out = [*by]
    for name, *_ in parts:
        lo_v, hi_v, fr = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_frac")
        out.append((lo_v + fr * (hi_v - lo_v)).alias(name))
    return g.select(*out)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles per group, exact and distributed."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    return _quantiles_of(_ranked_counts(df, value, by), value, probs, by, names)


def describe_by(df: DataFrame, value: str, group: str, digits: int = 1) -> DataFrame:
    """AGG9: count, mean, std, min, 25/50/75 %, max of ``value`` per group,
    rounded like a printed summary.  ``df`` is evaluated once: everything comes
    from its counts per distinct value."""
    counts, ranked = _value_counts(df, value, [group]), _ranked_counts(df, value, [group])
    k, x = F.col("_k").cast("double"), F.col(value)
    base = counts.groupBy(group).agg(
        F.sum("_k").alias("count"),
        (F.sum(k * x) / F.sum(k)).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    off = F.col(value) - F.col("mean")
    spread = counts.join(base.select(group, "mean"), group).groupBy(group).agg(F.sum(k * off * off).alias("_ss"))
    q = _quantiles_of(ranked, value, [0.25, 0.5, 0.75], [group], ["p25", "p50", "p75"])
    j = base.join(spread, group).join(q, group).withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1))))
    r = lambda c: F.round(F.col(c), digits).alias(c)
    return j.select(group, F.col("count").cast("double").alias("count"), r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"), r("max"))


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], size: int = SKETCH) -> DataFrame:
    """AGG9 at scale: per group the rows ``n`` and a mergeable quantile sketch
    of ``value`` (a few KB, whatever the rows).  Store them per day; new days
    add rows, nothing is read again."""
    v = df.select(*by, nan_to_null(F.col(value).cast("double")).alias(value)).where(F.col(value).isNotNull())
    return v.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None, size: int = SKETCH) -> DataFrame:
    """AGG9 at scale: quantiles per group from stored sketches.  A value given
    for probability ``p`` has a rank within ``SKETCH_ERROR`` of ``p`` (the
    sketch's bound at 99 % confidence for its size)."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("_s"))
    return merged.select(*by, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(name) for p, name in zip(probs, names)])


def cohort_summary(cohort: DataFrame, label: str = LABEL, age: str = "anchor_age", los: str = "los_icu_hours") -> DataFrame:
    """AGG10: one row: stays, distinct subjects, positives and rate, median /
    min / max age, median length of stay, gender counts (when present).  Both
    medians come from one prefix sum over the values of both columns."""
    aggs = [
        F.count(F.lit(1)).alias("n_stays"),
        F.count_distinct(SUBJECT).alias("n_subjects"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
        F.min(age).cast("double").alias("min_age"),
        F.max(age).cast("double").alias("max_age"),
    ]
    if "gender" in cohort.columns:
        aggs += [F.count_if(F.col("gender") == "M").alias("n_male"), F.count_if(F.col("gender") == "F").alias("n_female")]
    base = cohort.agg(*aggs)
    both = F.array(*[F.struct(F.lit(name).alias("name"), F.col(c).cast("double").alias("value")) for name, c in (("age", age), ("los", los))])
    medians = exact_quantiles(cohort.select(F.inline(both)), "value", [0.5], ["name"], ["median"])
    medians = medians.agg(*[F.max(F.when(F.col("name") == name, F.col("median"))).alias(out) for name, out in (("age", "median_age"), ("los", "median_los_hours"))])
    return with_scalars(base, medians)


def histogram(
    df: DataFrame,
    value: str,
    bins: int = 50,
    clip_upper: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """AGG11: equal-width histogram over the global [min, max] (shared by
    all groups), optional upper clip; the maximum falls in the last bin."""
    x = nan_to_null(F.col(value).cast("double"))
    if clip_upper is not None:
        x = F.least(x, F.lit(float(clip_upper)))
    v = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    rng = v.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    v = with_scalars(v, rng)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    h = v.withColumn("bin", b.cast("int")).groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("_lo").alias("_lo"), F.min("_hi").alias("_hi")
    )
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return h.select(
        *by,
        "bin",
        (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + F.lit(1)) * w).alias("bin_hi"),
        "n",
    )


def density(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    grid_points: int = 1000,
) -> DataFrame:
    """AGG12: Gaussian kernel density per group.

    Each group has its own grid of ``grid_points`` points, from half its range
    below its minimum to half its range above its maximum.  The bandwidth
    follows Scott's rule (``std * n^(-1/5)``).  Groups of one distinct value
    have no bandwidth and a NULL density.  One pass over ``df``: the statistics
    come from the counts.

    Values never meet grid points one by one.  They are folded (map-side
    partials) to the moments of cells one bandwidth wide; with ``u`` and ``t``
    a value's and a point's distance from the cell's centre in bandwidths, the
    kernel is ``exp(-t^2/2) * sum He_k(t) u^k / k!`` (Hermite polynomials), and
    each point reads the ``REACH`` cells on either side of its own.  Error, as
    a share of the greatest density a group of its size could have: below
    ``1.09 * 0.5^21 / sqrt(21!) * 1.2 < 1e-16`` for the ``TERMS`` = 21 terms
    kept (Cramer's bound on He_k), and below ``exp(-8.5^2 / 2) < 3e-16`` for
    the cells left out.  The rows exploded are grid points x 19 a group,
    whatever the number of values."""
    by = list(by)
    v = df.select(*by, nan_to_null(F.col(value).cast("double")).alias("_v")).where(F.col("_v").isNotNull())
    counts = v.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_k"))
    k, x = F.col("_k").cast("double"), F.col("_v")
    first = counts.groupBy(*by).agg(F.sum(k).alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi"), (F.sum(k * x) / F.sum(k)).alias("_mean"))
    with_group = (lambda a, b: a.join(b, by, "inner")) if by else with_scalars
    spread = with_group(counts, first)
    var = F.sum(k * F.pow(x - F.col("_mean"), F.lit(2.0))) / (F.max("_n") - F.lit(1.0))
    stats = spread.groupBy(*by).agg(F.max("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.when(F.max("_n") > 1, F.sqrt(var)).alias("_sd"))
    stats = stats.withColumn("_bw", F.when(F.col("_sd") > 0, F.col("_sd") * F.pow("_n", F.lit(-0.2))))
    pad = (F.col("_hi") - F.col("_lo")) / F.lit(2.0)
    step = F.lit(2.0) * (F.col("_hi") - F.col("_lo")) / F.lit(float(max(grid_points - 1, 1)))
    cells = with_group(counts, stats.select(*by, "_lo", "_bw")).where(F.col("_bw").isNotNull())
    cells = cells.withColumn("_cell", F.floor((F.col("_v") - F.col("_lo")) / F.col("_bw")))
    u = (F.col("_v") - F.col("_lo")) / F.col("_bw") - F.col("_cell") - F.lit(0.5)
    powers = [k]
    for i in range(1, TERMS):
        powers.append(powers[-1] * F.col("_u") / F.lit(float(i)))
    moments = cells.withColumn("_u", u).groupBy(*by, "_cell").agg(F.array(*[F.sum(x) for x in powers]).alias("_m"))

    points = stats.withColumn("grid_index", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
    points = points.withColumn("x", F.col("_lo") - pad + step * F.col("grid_index"))
    at = (F.col("x") - F.col("_lo")) / F.col("_bw")
    points = points.withColumn("_at", at).withColumn("_near", F.coalesce(F.floor("_at"), F.lit(0)))
    points = points.withColumn("_cell", F.explode(F.sequence(F.col("_near") - REACH, F.col("_near") + REACH)))
    met = points.join(moments, [*by, "_cell"], "left")
    t = F.col("_at") - F.col("_cell") - F.lit(0.5)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(1.0).alias("b"), F.lit(0.0).alias("k"), F.lit(0.0).alias("s"))
    hermite = F.aggregate(
        "_m",
        zero,
        lambda h, m: F.struct(h["b"].alias("a"), (F.col("_t") * h["b"] - h["k"] * h["a"]).alias("b"), (h["k"] + F.lit(1.0)).alias("k"), (h["s"] + m * h["b"]).alias("s")),
        lambda h: h["s"],
    )
    met = met.withColumn("_t", t).withColumn("_part", F.exp(F.lit(-0.5) * F.col("_t") * F.col("_t")) * hermite)
    kernel = F.coalesce(F.sum("_part"), F.lit(0.0))
    dens = safe_div(kernel * F.lit(1.0 / math.sqrt(2 * math.pi)), F.max("_n") * F.max("_bw"))
    return met.groupBy(*by, "grid_index").agg(F.max("x").alias("x"), dens.alias("density"))


def item_profile(df: DataFrame, item: str = ITEM, time: str = TIME) -> DataFrame:
    """AGG14: per item: rows, first and last time; plus the number of
    distinct items on every row."""
    per = df.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )
    n_items = per.agg(F.count(F.lit(1)).alias("n_items"))
    return with_scalars(per, n_items)
