"""Lags, splits, ordering, metrics and the subgroup report, checked against
brute force on small fixtures."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from stayframe.config import CLINICAL
from stayframe.operators.metrics import at_threshold, metrics_table, ranking_metrics, youden_threshold
from stayframe.operators.ordering import global_previous, global_prefix, global_rank
from stayframe.operators.splits import id_split, temporal_split
from stayframe.operators.subgroups import subgroup_membership, subgroup_report
from stayframe.operators.temporal import add_lags, missing_trend


def test_lag_over_gap_and_first_row(spark):
    df = spark.createDataFrame([(1, 3.0, 10.0, 0), (1, 27.0, 14.0, 1)], "stay_id long, icu_hours_elapsed double, x double, f int")
    out = missing_trend(add_lags(df, ["x"], window_hours=6.0), ["f"]).orderBy("icu_hours_elapsed").collect()
    assert out[0].x_lag1 is None and out[0].x_delta is None and out[0].missing_trend is None
    assert out[1].x_lag1 == 10.0 and out[1].x_delta == 4.0 and out[1].gap_windows == 4
    assert out[1].n_missing_vitals_lag1 == 0 and out[1].missing_trend == 1


# The published feature contract, in order.
V3_FEATURES = """
    vital_220045_mean vital_220045_min vital_220045_max vital_220045_std vital_220045_missing vital_220179_mean
    vital_220179_min vital_220179_max vital_220179_std vital_220179_missing vital_220210_mean vital_220210_min
    vital_220210_max vital_220210_std vital_220210_missing vital_220277_mean vital_220277_min vital_220277_max
    vital_220277_std vital_220277_missing vital_223761_mean vital_223761_min vital_223761_max vital_223761_std
    vital_223761_missing vital_223900_mean vital_223900_min vital_223900_max vital_223900_std vital_223900_missing
    lab_50912_last lab_50912_missing lab_50813_last lab_50813_missing lab_51301_last lab_51301_missing lab_50885_last
    lab_50885_missing icu_hours_elapsed time_of_day vital_220045_mean_lag1 vital_220045_mean_delta
    vital_220179_mean_lag1 vital_220179_mean_delta vital_220210_mean_lag1 vital_220210_mean_delta
    vital_220277_mean_lag1 vital_220277_mean_delta vital_223761_mean_lag1 vital_223761_mean_delta
    vital_223900_mean_lag1 vital_223900_mean_delta lab_50912_last_lag1 lab_50912_last_delta lab_50813_last_lag1
    lab_50813_last_delta lab_51301_last_lag1 lab_51301_last_delta lab_50885_last_lag1 lab_50885_last_delta
    n_missing_vitals n_missing_vitals_lag1 missing_trend
""".split()


def test_v3_contract_has_the_63_features_in_order():
    assert len(V3_FEATURES) == 63
    assert CLINICAL.v3_feature_columns() == V3_FEATURES


def test_split_rounding_90_stays(spark):
    rows = [(i, i) for i in range(90)]
    df = spark.createDataFrame(rows, "stay_id long, t long").withColumn("window_end", F.timestamp_seconds("t").cast("timestamp_ntz"))
    t = {r.split: r.n for r in temporal_split(df).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert t == {"train": 62, "val": 13, "test": 15}
    i = {r.split: r.n for r in id_split(df).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert i == {"train": 62, "val": 14, "test": 14}


def test_splits_disjoint_and_complete(spark):
    from stayframe.plans.mappings import lineitem_inputs
    from stayframe.plans.medallion import gold_table

    x = lineitem_inputs(spark, "/root/testdata/sf0.001")
    g = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    s = temporal_split(g)
    assert s.count() == g.count()
    assert s.groupBy("stay_id").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0


def test_global_prefix_and_previous_match_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 50), rnd.randint(1, 9), rnd.choice("ab")) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k long, v long, g string")
    order = [F.col("k").asc(), F.col("id").asc()]
    got = {r.id: (r.v_cum, r.v_total) for r in global_prefix(df, order, ["v"], ["g"], partitions=7, totals=True).collect()}
    prev = {r.id: r.prev_v for r in global_previous(df, order, ["v"], ["g"], partitions=7).collect()}
    rank = {r.id: r.rank for r in global_rank(df, order, partitions=5).collect()}
    for g in "ab":
        part = sorted([r for r in rows if r[3] == g], key=lambda r: (r[1], r[0]))
        total = sum(r[2] for r in part)
        acc = 0
        last = None
        for r in part:
            acc += r[2]
            assert got[r[0]] == (acc, total)
            assert prev[r[0]] == last
            last = r[2]
    allsorted = sorted(rows, key=lambda r: (r[1], r[0]))
    assert [rank[r[0]] for r in allsorted] == list(range(500))


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = 0.0
    for p, n in itertools.product(pos, neg):
        tot += 1.0 if p > n else 0.5 if p == n else 0.0
    return tot / (len(pos) * len(neg))


def brute_ap(pairs):
    thresholds = sorted({s for s, _ in pairs}, reverse=True)
    P = sum(y for _, y in pairs)
    ap, prev_r = 0.0, 0.0
    for t in thresholds:
        tp = sum(1 for s, y in pairs if s >= t and y == 1)
        fp = sum(1 for s, y in pairs if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


@pytest.mark.parametrize("seed", [1, 2])
def test_auroc_ap_match_brute_force_with_ties(spark, seed):
    rnd = random.Random(seed)
    pairs = [(round(rnd.random(), 1), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "score double, sepsis_label int")
    r = ranking_metrics(df).collect()[0]
    assert r.auroc == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert r.auprc == pytest.approx(brute_ap(pairs), abs=1e-12)


def test_tied_scores(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 1), (0.5, 0), (0.5, 0)], "score double, sepsis_label int")
    r = ranking_metrics(df).collect()[0]
    assert r.auroc == 0.5 and r.auprc == 0.5


def test_one_class_metrics(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 0)], "score double, sepsis_label int")
    assert ranking_metrics(df).collect()[0].auroc is None
    t = at_threshold(df, 0.35).collect()[0]
    assert t.recall == 0.0 and t.f1 == 0.0 and t.precision == 0.0


def test_confusion_arithmetic_published_counts(spark):
    counts = {"tp": 198_883, "fp": 321_236, "tn": 383_364, "fn": 31_284}
    n = sum(counts.values())
    idx = F.col("id")
    tp, fp, tn = counts["tp"], counts["fp"], counts["tn"]
    df = spark.range(n).select(
        F.when(idx < tp, 1).when(idx < tp + fp, 0).when(idx < tp + fp + tn, 0).otherwise(1).alias("sepsis_label"),
        F.when(idx < tp + fp, 1).otherwise(0).alias("sepsis_alert"),
    )
    r = at_threshold(df, alert="sepsis_alert").collect()[0]
    assert (r.tp, r.fp, r.tn, r.fn) == (tp, fp, tn, counts["fn"])
    assert round(r.recall, 3) == 0.864 and round(r.precision, 3) == 0.382 and round(r.alert_rate, 3) == 0.556


def test_youden_highest_threshold_on_ties(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "score double, sepsis_label int")
    r = youden_threshold(df).collect()[0]
    assert r.threshold == 0.9 and r.youden_j == pytest.approx(0.5)


def test_metrics_table_rows(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (0.4, 1), (0.1, 0)], "score double, sepsis_label int")
    m = {r.metric: r.value for r in metrics_table(df, 0.35).collect()}
    assert m["auroc"] == 1.0 and m["recall"] == 1.0 and m["n_total"] == 4.0


def test_subgroup_bucket_edges(spark):
    rows = [(45.0, 24.0, 6), (46.0, 24.1, 18), (65.0, 1.0, 12), (80.0, 1.0, 12), (81.0, 1.0, 12), (-3.0, 1.0, 12)]
    df = spark.createDataFrame(rows, "anchor_age double, icu_hours_elapsed double, time_of_day int").withColumn("id", F.monotonically_increasing_id())
    m = subgroup_membership(df).groupBy("anchor_age", "icu_hours_elapsed", "time_of_day").agg(F.collect_set("subgroup").alias("g"))
    got = {(r.anchor_age, r.icu_hours_elapsed, r.time_of_day): set(r.g) for r in m.collect()}
    assert "Age 18-45" in got[(45.0, 24.0, 6)] and "LOS Early (0-24h)" in got[(45.0, 24.0, 6)]
    assert "Shift Day (6am-6pm)" in got[(45.0, 24.0, 6)]
    assert "Age 45-65" in got[(46.0, 24.1, 18)] and "LOS Mid (24-72h)" in got[(46.0, 24.1, 18)]
    assert "Shift Night (6pm-6am)" in got[(46.0, 24.1, 18)]
    assert "Age 45-65" in got[(65.0, 1.0, 12)] and "Age 65-80" in got[(80.0, 1.0, 12)] and "Age 80+" in got[(81.0, 1.0, 12)]
    assert not any(g.startswith("Age") for g in got[(-3.0, 1.0, 12)])


def test_small_subgroups_omitted(spark):
    rows = [(0.9 if i % 2 else 0.1, 1 if i < 9 else 0, 1 if i % 2 else 0, 50.0, 10.0, 12) for i in range(99)]
    df = spark.createDataFrame(
        rows, "sepsis_prob double, sepsis_label int, sepsis_alert int, anchor_age double, icu_hours_elapsed double, time_of_day int"
    )
    assert subgroup_report(df).count() == 0
