"""Hot groups are split across tasks and results stay exact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stayframe.config import CLINICAL
from stayframe.operators.windows import window_grid


def test_long_stay_grid_is_exact_and_spread(spark):
    t0 = dt.datetime(2020, 1, 1)
    cohort = spark.createDataFrame(
        [(1, 1, t0, t0 + dt.timedelta(days=3650)), (2, 2, t0, None), (3, 3, t0, t0 + dt.timedelta(hours=13))],
        "stay_id long, hadm_id long, intime timestamp_ntz, outtime timestamp_ntz",
    )
    g = window_grid(cohort, CLINICAL)
    rows = {
        r.stay_id: (r.n, r.lo, r.hi, r.d)
        for r in g.groupBy("stay_id")
        .agg(F.count("*").alias("n"), F.min("window_id").alias("lo"), F.max("window_id").alias("hi"),
             F.count_distinct("window_id").alias("d"))
        .collect()
    }
    assert rows == {1: (14600, 0, 14599, 14600), 2: (1, 0, 0, 1), 3: (2, 0, 1, 2)}
    tasks = g.where("stay_id = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 2


def test_lags_of_a_hot_stay_are_spread_and_equal_the_plain_window(spark):
    from stayframe.operators.temporal import add_lags, missing_trend

    # no two rows of a stay share an order; one row has none
    rows = spark.range(9000).select(
        F.when(F.col("id") < 3000, 0).otherwise(1 + F.col("id") % 700).cast("long").alias("stay_id"),
        F.when(F.col("id") != 5001, (F.col("id") * 7 % 9001).cast("double") * 4.0).alias("icu_hours_elapsed"),
        F.when(F.col("id") % 5 != 0, F.col("id") * 1.5).alias("a"),
        (F.col("id") % 3 == 0).cast("int").alias("a_missing"),
        F.col("id").alias("extra"),
    )

    def features(hours):
        out = add_lags(rows, ["a"], window_hours=4.0, slice_hours=hours)
        return missing_trend(out, ["a_missing"], slice_hours=hours)

    plain, sliced = features(None), features(400.0)
    assert sliced.columns == plain.columns
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def tasks(hours):
            hot = features(hours).where("stay_id = 0")
            return hot.groupBy(F.spark_partition_id().alias("p")).agg(F.count("a_lag1").alias("n"), F.count("missing_trend").alias("m")).where("n + m > 0").count()

        whole, spread = tasks(None), tasks(400.0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert whole == 1 and spread >= 4


def test_interval_join_splits_a_hot_admission_and_forms_only_pairs_inside(spark):
    from stayframe.operators.joins import attach_admission_stays_within

    t0 = dt.datetime(2019, 12, 31, 23, 0)
    w = CLINICAL.window_seconds
    stays = spark.createDataFrame(
        [(1, 10, t0, 4), (2, 10, t0 + dt.timedelta(days=40), 300), (3, 11, t0, 1), (4, 12, None, 3), (5, 12, t0, None), (None, 13, t0, 2), (6, 14, dt.datetime(1969, 12, 31), 9)],
        "stay_id long, hadm_id long, intime timestamp_ntz, n_windows int",
    )
    start = F.lit("2019-12-31 20:00:00").cast("timestamp_ntz")
    labs = spark.range(6000).select(
        F.when(F.col("id") < 3000, 10).otherwise(10 + F.col("id") % 6).cast("long").alias("hadm_id"),
        F.timestamp_add("SECOND", F.col("id") % 3000 * (w // 7), start).alias("charttime"),
        F.when(F.col("id") % 9 != 0, F.col("id").cast("double")).alias("valuenum"),
    )
    edges = [(10, t0), (10, t0 + dt.timedelta(seconds=4 * w)), (10, t0 + dt.timedelta(seconds=4 * w, microseconds=-1)), (10, None), (14, dt.datetime(1970, 1, 1)), (14, dt.datetime(1969, 12, 30))]
    labs = labs.union(spark.createDataFrame([(h, t, 1.0) for h, t in edges], "hadm_id long, charttime timestamp_ntz, valuenum double"))
    want = []
    for s in stays.collect():
        for r in labs.where(F.col("hadm_id") == s.hadm_id).collect():
            if s.intime and s.n_windows and r.charttime and dt.timedelta(0) <= r.charttime - s.intime < dt.timedelta(seconds=s.n_windows * w):
                want.append((s.hadm_id, r.charttime, r.valuenum, s.stay_id, s.intime))
    for span in (1, 16, 64):
        got = attach_admission_stays_within(labs, stays, CLINICAL, span=span)
        assert got.columns == ["hadm_id", "charttime", "valuenum", "stay_id", "intime"]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = attach_admission_stays_within(labs, stays, CLINICAL, span=16).where("hadm_id = 10")
        assert hot.groupBy(F.spark_partition_id().alias("p")).agg(F.count("stay_id")).count() >= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
