"""Profiling aggregates: NaN, hot values, densities and distribution of work."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayframe.operators import ordering
from stayframe.operators.ordering import global_position, sort_rows
from stayframe.operators.profile import REACH, SKETCH_ERROR, cohort_summary, density, describe_by, exact_quantiles, histogram, merged_quantiles, quantile_sketches

NAN = float("nan")


def test_nan_is_missing_in_histogram_and_describe(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, NAN, None)], "g string, v double")
    h = sorted((r.bin, r.bin_lo, r.n) for r in histogram(df, "v", 5).collect())
    assert h == [(0, 1.0, 1), (4, pytest.approx(1.8), 1)]
    r = describe_by(df, "v", "g").first()
    assert (r["count"], r["mean"], r["min"], r["p50"], r["max"]) == (2.0, 1.5, 1.0, 1.5, 2.0)


def test_quantiles_with_a_value_held_by_most_rows(spark, monkeypatch):
    rng = random.Random(1)
    values = [5.0] * 8000 + [rng.uniform(0, 10) for _ in range(2000)]
    rng.shuffle(values)
    sizes = []
    plain = ordering._range_split

    def watched(df, *a):
        out = plain(df, *a)
        sizes.append([r["count"] for r in out.groupBy(ordering._PID).count().collect()])
        return out

    monkeypatch.setattr(ordering, "_range_split", watched)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs).first()
    assert list(got) == pytest.approx(np.quantile(values, probs).tolist())
    assert sum(sizes[0]) == len(set(values)) and max(sizes[0]) <= len(set(values))  # distinct values, not rows


def test_density_is_the_exact_sum_on_padded_grids_per_group(spark):
    rng = random.Random(2)
    groups = {"a": [rng.gauss(0, 1) for _ in range(50)] + [0.5] * 30, "b": [float(rng.randrange(1000, 1010)) for _ in range(40)], "c": [3.0, 3.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("a", NAN), ("b", None)], "g string, v double")
    out = {(r.g, r.grid_index): (r.x, r.density) for r in density(df, "v", ["g"], 21).collect()}
    assert len(out) == 63 and out["c", 0] == (3.0, None)
    for g in "ab":
        v = np.array(groups[g])
        bw = v.std(ddof=1) * len(v) ** -0.2
        half = (v.max() - v.min()) / 2
        for i, x in enumerate(np.linspace(v.min() - half, v.max() + half, 21)):
            want = np.exp(-0.5 * ((x - v) / bw) ** 2).sum() / (math.sqrt(2 * math.pi) * len(v) * bw)
            assert out[g, i] == (pytest.approx(x), pytest.approx(want))


def test_position_follows_the_order_of_the_sorted_frame(spark):
    df = spark.range(1000).withColumn("k", F.col("id") * 37 % 1000).repartition(7)
    up = {r.k: r.position for r in global_position(sort_rows(df, "k")).collect()}
    down = {r.k: r.position for r in global_position(sort_rows(df, F.col("k").desc())).collect()}
    assert up == {k: k for k in range(1000)} and down == {k: 999 - k for k in range(1000)}


def test_density_explodes_no_row_for_each_value(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(0, 1, 3000), [40.0], rng.exponential(3, 2000)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    out = density(df, "v", grid_points=200)
    got = {r.grid_index: (r.x, r.density) for r in out.collect()}
    bw = v.std(ddof=1) * len(v) ** -0.2
    most = 1 / (math.sqrt(2 * math.pi) * bw)
    for x, d in got.values():
        want = np.exp(-0.5 * ((x - v) / bw) ** 2).sum() * most / len(v)
        assert abs(d - want) < 1e-13 * most
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(") == 2 and f"- {REACH}" in plan  # grid points, and the cells near each


def test_sketches_of_parts_merge_within_the_rank_error(spark):
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(0, 1, 30_000), np.full(15_000, 0.25), rng.exponential(5, 15_000)])
    df = spark.createDataFrame([("g", i % 9, float(x)) for i, x in enumerate(v)] + [("g", 1, NAN), ("g", 2, None), ("h", 1, 3.0)], "g string, day int, v double").repartition(6)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    rows = {r.g: r for r in merged_quantiles(quantile_sketches(df, "v", ["g", "day"]), probs, ["g"]).collect()}
    assert rows["g"].n == len(v) and tuple(rows["h"])[1:] == (1, 3.0, 3.0, 3.0, 3.0, 3.0)
    for p, q in zip(probs, tuple(rows["g"])[2:]):
        assert (v <= q).mean() >= p - SKETCH_ERROR and (v < q).mean() <= p + SKETCH_ERROR


def test_summaries_evaluate_their_input_once_or_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("a" if i % 3 else "b", float(i % 50)) for i in range(900)], "g string, v double").mapInArrow(count, "g string, v double")
    rows = {r.g: r for r in describe_by(df, "v", "g", 6).collect()}
    assert seen.value == 900
    a = np.array([float(i % 50) for i in range(900) if i % 3])
    assert tuple(rows["a"])[1:] == pytest.approx((len(a), a.mean(), a.std(ddof=1), a.min(), *np.quantile(a, [0.25, 0.5, 0.75]), a.max()), abs=1e-6)
    cohort = spark.createDataFrame([(i // 2, 20 + i % 60, float(i), i % 2) for i in range(101)], "subject_id long, anchor_age int, los_icu_hours double, sepsis_label int")
    r = cohort_summary(cohort).first()
    assert (r.median_age, r.median_los_hours, r.n_stays, r.n_subjects) == (np.median([20 + i % 60 for i in range(101)]), 50.0, 101, 51)


def test_a_thinned_curve_keeps_its_shape(spark):
    from stayframe.operators.metrics import roc_curve, youden_threshold

    rng = random.Random(5)
    rows = [(s / 40, int(rng.random() < s / 40)) for s in range(40) for _ in range(rng.choice([1, 1, 1, 2]))] + [(0.9, None)]
    df = spark.createDataFrame(rows, "score double, sepsis_label int")
    full = sorted(((r.fpr, r.tpr, r.threshold) for r in roc_curve(df).collect()), key=lambda p: -p[2])
    thin = sorted(((r.fpr, r.tpr, r.threshold) for r in roc_curve(df, thin=True).collect()), key=lambda p: -p[2])
    steps = [(b[0] - a[0], b[1] - a[1]) for a, b in zip(full, full[1:])]
    want = full[:2] + [p for k, p in enumerate(full[2:-1], 2) if steps[k - 1] != pytest.approx(steps[k])] + full[-1:]
    assert thin == want and len(thin) < len(full)
    assert {youden_threshold(df).first().threshold} <= {p[2] for p in thin}
