"""Physical-plan properties the operators are designed for: pruned scans with
pushed filters, hash (not sort) aggregation, no extra exchange before the
Gold join, no single-partition window over data rows."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from stayframe.plans.mappings import lineitem_inputs
from stayframe.operators.aggregates import lab_windows, silver_windows
from stayframe.plans.medallion import batch_matrix, gold_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def x(spark):
    return lineitem_inputs(spark, SF)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_silver_scan_is_pruned_and_filtered(x):
    p = formatted(silver_windows(x.vitals, x.stays, x.cfg))
    block = p[p.index("lineitem.parquet") - 400 :]
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", block).group(1)
    assert {"IsNotNull(l_extendedprice)", "IsNotNull(l_shipdate)", "IsNotNull(l_orderkey)"} <= set(pushed.split(", "))
    read = re.search(r"ReadSchema: struct<([^>]*)>", block).group(1)
    assert set(c.split(":")[0] for c in read.split(",")) == {
        "l_orderkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
    }


def test_window_aggregates_are_hash_aggregates_with_partials(x):
    for df in (silver_windows(x.vitals, x.stays, x.cfg), lab_windows(x.labs, x.stays, x.cfg)):
        p = plan(df)
        assert "SortAggregate" not in p
        assert "partial_" in p


def test_gold_join_reuses_aggregate_partitioning(spark, x):
    df = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    df.write.format("noop").mode("overwrite").save()
    p = df._jdf.queryExecution().executedPlan().toString()
    # Exchanges: one per aggregate level (vitals: 1, labs: 2) plus input
    # spreading / broadcasts; none is added for the (stay, window) join.
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert all("stay_id" in h for h in hashed)
    assert len([h for h in hashed if "charttime" not in h]) <= 2


def test_global_order_has_no_single_partition_window_over_rows(spark):
    from pyspark.sql import functions as F

    from stayframe.operators.ordering import global_rank

    df = spark.range(5000).withColumn("k", F.col("id") % 97)
    r = global_rank(df, [F.col("k").asc(), F.col("id").asc()])
    p = r._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in p.split("\n") if "Window [" in line]
    # The running count over data rows is partitioned by the range partition
    # id; the only other window runs over the per-partition totals (an
    # aggregate keyed by that id, one row per range partition).
    assert any("windowspecdefinition(_range_pid" in w for w in windows)
    assert len(windows) == 2
    assert r.agg(F.min("rank"), F.max("rank")).first() == (0, 4999)


def test_batch_matrix_bounds_readings_before_the_first_exchange(x):
    p = plan(batch_matrix(x.vitals, x.labs, x.stays, x.labels, x.cfg))
    assert "RoundRobinPartitioning" not in p
    bounds = [at for at in range(len(p)) if p.startswith("n_windows#", at) and "< n_windows#" in p[at - 3 : at + 12]]
    assert len(bounds) >= 2
    lines = p.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if "< n_windows#" in line:  # nothing between the bound and the scans below it deals rows out by window
            below = [q for q in lines[i + 1 :] if depth(q) > depth(line)]
            assert not any("Exchange hashpartitioning" in q and "window_id" in q for q in below[:6])


def test_no_query_reshuffles_a_raw_scan(spark):
    x = lineitem_inputs(spark, SF)
    for df in (silver_windows(x.vitals, x.stays, x.cfg), gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg), x.labs):
        assert "RoundRobinPartitioning" not in plan(df)
