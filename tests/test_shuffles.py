"""What shuffle joins move: lab readings once, wide windows once; the width of shuffles follows the tables read."""

from __future__ import annotations

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from stayframe import session
from stayframe.operators.aggregates import BOUND, lab_windows, silver_windows, stays_within_vitals
from stayframe.operators.windows import window_count
from stayframe.plans import mappings
from stayframe.plans.medallion import batch_matrix, gold_table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def x(spark):
    """Inputs under joins that shuffle, as on large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield mappings.lineitem_inputs(spark, SF)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fanned_out_labs_are_not_shuffled_by_time(x):
    bounded = x.stays.withColumn(BOUND, window_count(x.cfg))
    for stays in (x.stays, bounded):
        hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(lab_windows(x.labs, stays, x.cfg)))
        assert len([h for h in hashed if "stay_id" in h]) == 1 and not any("charttime" in h for h in hashed)


def test_wide_windows_are_not_shuffled_again_for_the_label(x):
    for df in (gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg), batch_matrix(x.vitals, x.labs, x.stays, x.labels, x.cfg)):
        first = next(line for line in plan(df).splitlines() if "Join [" in line)
        assert "window_id" in first


def test_labels_on_the_cohort_or_missing_give_the_same_matrix(spark, x):
    labels = x.labels.where(F.col("stay_id") % 3 != 0)
    m = batch_matrix(x.vitals, x.labs, x.stays, labels, x.cfg)
    known = x.stays.join(labels, "stay_id", "left")
    assert m.exceptAll(batch_matrix(x.vitals, x.labs, known, None, x.cfg)).isEmpty()
    got = {r.stay_id: r.sepsis_label for r in m.select("stay_id", "sepsis_label").distinct().collect()}
    want = {r.stay_id: r.sepsis_label or 0 for r in known.collect()}
    assert got == want


def test_shuffle_width_follows_the_tables_read(spark, monkeypatch):
    session.tune(spark)
    narrow = session.shuffle_width(spark)
    given = spark.conf.get(session.ADVISORY, None)
    monkeypatch.setattr(session, "BYTES_A_PARTITION", 1024)
    mappings.lineitem_inputs(spark, SF).vitals
    one = session.shuffle_width(spark)
    assert one == -(-session.stored_bytes(spark, f"{SF}/lineitem.parquet") // 1024) > narrow
    mappings.lineitem_inputs(spark, SF).stays
    assert session.shuffle_width(spark) > one
    session.tune(spark)
    assert session.shuffle_width(spark) == narrow and spark.conf.get(session.ADVISORY, None) == given


def test_labs_fan_out_no_further_than_silver_on_large_tables(spark, x, monkeypatch):
    args = (x.vitals, x.labs, x.stays, x.labels, x.cfg)
    whole = gold_table(*args)
    monkeypatch.setattr(session, "FAN_OUT_BYTES", 0)
    bounded = gold_table(*args)
    assert "_block" in plan(bounded) and "_block" not in plan(whole)
    assert bounded.exceptAll(whole).isEmpty() and whole.exceptAll(bounded).isEmpty()
    reach = stays_within_vitals(x.stays, x.vitals, x.cfg)
    silver = silver_windows(x.vitals, x.stays, x.cfg).groupBy("stay_id").agg((F.max("window_id") + 1).alias("n"))
    assert reach.where("n_windows > 0").join(silver, "stay_id", "full").where("NOT n_windows <=> n").isEmpty()
    assert lab_windows(x.labs, reach, x.cfg).count() < lab_windows(x.labs, x.stays, x.cfg).count()


def test_stays_without_vitals_or_times_are_bounded_away(spark, x):
    stays = spark.sql("SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2020-01-01'), (2L, TIMESTAMP_NTZ'2020-01-01'), (3L, NULL) t(stay_id, intime)")
    item = x.cfg.vital_items[0]
    vitals = spark.sql(f"SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2020-01-02', '{item}', 1D), (1L, TIMESTAMP_NTZ'2021-01-02', '{item}', NULL), (1L, NULL, '{item}', 1D), (3L, TIMESTAMP_NTZ'2020-01-02', '{item}', 1D) t(stay_id, charttime, itemid, valuenum)")
    got = {r.stay_id: r.n_windows for r in stays_within_vitals(stays, vitals, x.cfg).collect()}
    assert got == {1: 1, 3: None}


@pytest.mark.parametrize("seconds, orders", [(90 * 86400, 2000), (10 * 86400, 2000), (10_000, 100)])
def test_a_dense_grid_on_large_tables_stays_where_it_was_dealt_out(spark, x, monkeypatch, seconds, orders):
    """Windows across two time blocks of the labs' join (10 days) and stays of two grid blocks (10,000 s) included."""
    cfg = dataclasses.replace(x.cfg, window_seconds=seconds)
    args = (x.vitals, x.labs, x.stays.where(F.col("stay_id") <= orders), x.labels, cfg)
    whole = batch_matrix(*args)
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(whole))
    assert any("window_id" in h for h in moved)
    given = spark.conf.get(session.CO_PARTITION)
    monkeypatch.setattr(session, "GRID_BYTES", -1)
    dealt = batch_matrix(*args)
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(dealt))
    assert not any("window_id" in h for h in moved) and len([h for h in moved if "_blk" in h]) == 3
    assert dealt.schema == whole.schema
    dealt, whole = dealt.localCheckpoint(), whole.localCheckpoint()
    assert dealt.count() == whole.count() > 0
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
    session.tune(spark)
    assert spark.conf.get(session.CO_PARTITION) == given
