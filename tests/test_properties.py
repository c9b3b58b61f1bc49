"""Property checks against numpy / brute force on small generated inputs."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import T0
from stayframe.config import CLINICAL
from stayframe.operators.aggregates import silver_windows
from stayframe.operators.metrics import ranking_metrics
from stayframe.operators.profile import density, exact_quantiles, histogram
from stayframe.plans.medallion import batch_matrix

SLOW = settings(
    max_examples=8,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1)), min_size=2, max_size=60))
def test_auroc_equals_pairwise_probability(spark, pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    df = spark.createDataFrame([(float(s), y) for s, y in pairs], "score double, sepsis_label int")
    r = ranking_metrics(df).collect()[0]
    if not pos or not neg:
        assert r.auroc is None
        return
    expect = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert r.auroc == pytest.approx(expect, abs=1e-12)


@SLOW
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=80)
)
def test_exact_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q25, r.q50, r.q90) for r in exact_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for g in {k for k, _ in rows}:
        vals = np.array([v for k, v in rows if k == g])
        exp = np.percentile(vals, [25, 50, 90])
        assert got[g] == pytest.approx(tuple(exp), rel=1e-9, abs=1e-9)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(50, 10, 2000).round(3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    h = {r.bin: r.n for r in histogram(df, "v", 20).collect()}
    counts, _ = np.histogram(vals, bins=20)
    got = [h.get(i, 0) for i in range(20)]
    # Edge values may sit on the other side of a bin edge by one ulp.
    assert sum(got) == 2000 and np.abs(np.array(got) - counts).sum() <= 4


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(v), int(v > 0)) for v in rng.normal(0, 1, 3000)], "v double, g int")
    d = density(df, "v", ["g"], grid_points=200).toPandas()
    for _, part in d.groupby("g"):
        part = part.sort_values("x")
        area = np.trapezoid(part["density"], part["x"])
        assert 0.8 < area < 1.05


@SLOW
@given(st.lists(st.tuples(st.floats(0, 30), st.floats(1, 200, allow_nan=False)), min_size=1, max_size=25), st.floats(1, 30))
def test_dense_contains_sparse_within_length_of_stay(spark, readings, los):
    stay_len = dt.timedelta(hours=los)  # microsecond resolution, as stored
    cohort = spark.createDataFrame(
        [(1, 100, T0, T0 + stay_len)], "stay_id long, hadm_id long, intime timestamp_ntz, outtime timestamp_ntz"
    )
    v = spark.createDataFrame(
        [(1, T0 + dt.timedelta(hours=h), 220045, val) for h, val in readings],
        "stay_id long, charttime timestamp_ntz, itemid int, valuenum double",
    )
    labs = spark.createDataFrame([], "hadm_id long, charttime timestamp_ntz, itemid int, valuenum double")
    labels = spark.createDataFrame([(1, 0)], "stay_id long, sepsis_label int")
    sparse = {r.window_end: r.vital_220045_mean for r in silver_windows(v, cohort, CLINICAL).collect()}
    dense = {r.window_end: r.vital_220045_mean for r in batch_matrix(v, labs, cohort, labels, CLINICAL).collect()}
    n = max(1, stay_len // dt.timedelta(hours=6))
    assert len(dense) == n
    for end, mean in sparse.items():
        if end <= T0 + dt.timedelta(hours=6 * n):
            assert dense[end] == pytest.approx(mean)
    assert sum(1 for m in dense.values() if m is not None) <= len(sparse)


def test_hot_key_prefix_sum_is_exact(spark):
    # One group holds most rows: results stay exact across many range partitions.
    rows = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        F.col("id").alias("k"),
        F.lit(1).cast("long").alias("v"),
    )
    from stayframe.operators.ordering import global_prefix

    out = global_prefix(rows, [F.col("k").asc()], ["v"], ["g"], partitions=16, totals=True)
    bad = out.where(
        ((F.col("g") == "hot") & (F.col("v_cum") != F.col("k") + 1))
        | ((F.col("g") == "cold") & (F.col("v_cum") != F.col("k") - 14999))
    )
    assert bad.count() == 0
    assert {r.g: r.t for r in out.groupBy("g").agg(F.max("v_total").alias("t")).collect()} == {"hot": 15000, "cold": 5000}
