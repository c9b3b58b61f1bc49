"""Prefix sums over stored splitters: right for any bounds, no rows pinned."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stayframe.operators.ordering import OVERSAMPLE, global_prefix, global_previous, global_rank, splitters

SF = "/root/testdata/sf0.001"


def _rows(n=1500):
    rnd = random.Random(7)
    return [(rnd.choice("ab"), rnd.choice([None, *map(float, range(40))]), i, rnd.randint(0, 9)) for i in range(n)]


@pytest.mark.parametrize("falls", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("slices", [1, 8, 150])
def test_sums_and_neighbours_equal_a_plain_loop(spark, falls, by, slices):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, s double, i long, v long")
    order = [F.col("s").desc(), F.col("i").desc()] if falls else [F.col("s").asc(), F.col("i").asc()]
    summed = global_prefix(df, order, ["v"], by, slices, totals=True, following=["v"])
    got = {r.i: (r.v_cum, r.v_total, r.prev_v, r._next_v) for r in global_previous(summed, order, ["v"], by, slices).collect()}
    want = {}
    for group in [[r for r in rows if r[0] == g] for g in "ab"] if by else [rows]:
        ranked = sorted(group, key=lambda r: (r[1] is not None, r[1] or 0.0, r[2]), reverse=falls)
        at = [None, *[r[3] for r in ranked], None]
        for k, r in enumerate(ranked):
            want[r[2]] = (sum(at[1 : k + 2]), sum(at[1:-1]), at[k], at[k + 2])
    assert got == want


def test_splitters_are_bounded_and_balanced(spark):
    row = splitters(spark.range(200_000), ["id"], slices=16).first()
    assert len(row["_bounds"]) <= 16 and row["_bounds"] == sorted(row["_bounds"])
    edges = [0, *row["_bounds"], 200_000]
    assert max(b - a for a, b in zip(edges, edges[1:])) < 5 * 200_000 / 16
    few = splitters(spark.range(3), ["id"], slices=1000).first()
    assert few["_bounds"] == [0, 1, 2]
    assert splitters(spark.range(0), ["id"]).first()["_bounds"] == []
    assert OVERSAMPLE >= 8


def test_empty_and_one_row(spark):
    assert global_rank(spark.range(0), ["id"], with_count=True).collect() == []
    assert [(r.id, r["rank"], r.n) for r in global_rank(spark.range(5, 6), ["id"], with_count=True).collect()] == [(5, 0, 1)]


def test_order_must_have_one_direction_and_plain_columns(spark):
    df = spark.range(3).withColumn("k", F.col("id") % 2)
    with pytest.raises(ValueError):
        global_rank(df, [F.col("k").desc(), F.col("id").asc()])
    with pytest.raises(ValueError):
        global_rank(df, [F.col("k").asc_nulls_last()])


@pytest.mark.parametrize(
    "name",
    ["ORD1_global_prefix_orders", "EVL4_roc_thinned_lineitem", "WIN7_replay_schedule_events", "AGG9_describe_by_lineitem", "AGG10_cohort_summary_events"],
)
def test_no_rows_are_pinned(spark, name):
    import __spark_entry__ as entry

    p = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in p and "ExistingRDD" not in p


def test_an_aggregated_input_is_evaluated_once(spark):
    counts = spark.range(20_000).groupBy((F.col("id") % 900).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    out = global_prefix(counts, ["k"], ["c"])
    out.collect()
    p = out._jdf.queryExecution().executedPlan().toString()
    final = p[: p.index("== Initial Plan ==")]
    assert final.count("Range (") == 1 and "ReusedExchange" in final


def test_a_split_pins_nothing_and_cuts_by_rank(spark):
    from stayframe.operators.splits import temporal_split

    df = spark.range(1000).select(F.col("id").alias("stay_id"), F.timestamp_seconds(F.col("id") * 37 % 1000).cast("timestamp_ntz").alias("window_end"))
    out = temporal_split(df)
    assert "LogicalRDD" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert dict(out.groupBy("split").count().collect()) == {"train": 700, "val": 150, "test": 150}
    assert out.where("split = 'train'").agg(F.max(F.unix_seconds(F.col("window_end").cast("timestamp")))).first()[0] == 699
