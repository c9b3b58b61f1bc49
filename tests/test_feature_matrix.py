"""The reference's five batch-matrix cases, plus windowing semantics."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import T0, hours
from stayframe.config import CLINICAL
from stayframe.operators.aggregates import lab_windows, pivot_windows, silver_windows
from stayframe.operators.contracts import ContractError, assert_contract
from stayframe.plans.medallion import batch_matrix, gold_table

HR = 220045
VITALS = CLINICAL.vital_items
LABS = CLINICAL.lab_items


def vit_rows(stay, hrs, value=80.0, items=VITALS):
    return [(stay, hours(h), i, value) for h in hrs for i in items]


def lab_rows(hadm, hrs, value=1.5, items=LABS):
    return [(hadm, hours(h), i, value) for h in hrs for i in items]


def matrix(frames, cohort, vitals=(), labs=()):
    c, v, lab, labels = frames(cohort, vitals, labs)
    return batch_matrix(v, lab, c, labels, CLINICAL).orderBy("stay_id", "window_end").collect()


# -- reference cases ---------------------------------------------------------
def test_row_count_per_length_of_stay(frames):
    rows = matrix(frames, [(1, 100, 13, 0), (2, 200, 3, 0)])
    per = {}
    for r in rows:
        per[r.stay_id] = per.get(r.stay_id, 0) + 1
    assert per == {1: 2, 2: 1}


def test_no_future_leakage(frames):
    v = [(1, hours(h), HR, 60.0) for h in (1, 3, 5)] + [(1, hours(h), HR, 90.0) for h in (7, 9, 11)]
    rows = matrix(frames, [(1, 100, 12, 0)], v)
    assert len(rows) == 2
    assert rows[0].window_end == hours(6) and rows[0][f"vital_{HR}_mean"] == 60.0
    assert rows[1].window_end == hours(12) and rows[1][f"vital_{HR}_mean"] == 90.0


def test_window_without_vitals(frames):
    rows = matrix(frames, [(1, 100, 6, 0)], labs=lab_rows(100, (2, 4)))
    assert len(rows) == 1
    r = rows[0].asDict()
    assert all(r[f"vital_{i}_missing"] == 1 for i in VITALS)
    assert all(r[f"vital_{i}_{s}"] is None for i in VITALS for s in ("mean", "min", "max", "std"))
    assert all(r[f"lab_{i}_missing"] == 0 for i in LABS)


def test_window_without_labs(frames):
    rows = matrix(frames, [(1, 100, 6, 0)], vit_rows(1, (1, 3, 5)))
    r = rows[0].asDict()
    assert all(r[f"lab_{i}_missing"] == 1 and r[f"lab_{i}_last"] is None for i in LABS)
    assert all(r[f"vital_{i}_missing"] == 0 for i in VITALS)


def test_label_carried_per_stay(frames):
    rows = matrix(frames, [(1, 100, 13, 1), (2, 200, 13, 0)], vit_rows(1, (1,)) + vit_rows(2, (1,)))
    labels = {}
    for r in rows:
        labels.setdefault(r.stay_id, set()).add(r.sepsis_label)
    assert labels == {1: {1}, 2: {0}}
    assert len(rows) == 4


# -- added cases ------------------------------------------------------------
def silver(frames, cohort, vitals):
    c, v, _, _ = frames(cohort, vitals)
    return silver_windows(v, c, CLINICAL).orderBy("stay_id", "window_id").collect()


def test_boundary_reading_goes_to_next_window(frames):
    rows = silver(frames, [(1, 100, 24, 0)], [(1, hours(6), HR, 70.0)])
    assert [r.window_id for r in rows] == [1]


def test_sub_second_precision(frames):
    start = T0 + dt.timedelta(microseconds=900_000)
    reading = T0 + dt.timedelta(hours=6, microseconds=100_000)
    rows = silver(frames, [(1, 100, 24, 0, start)], [(1, reading, HR, 70.0)])
    assert [r.window_id for r in rows] == [0]


def test_pre_admission_reading_dropped(frames):
    rows = silver(frames, [(1, 100, 24, 0)], [(1, hours(-1), HR, 70.0), (1, hours(1), HR, 80.0)])
    assert len(rows) == 1 and rows[0][f"vital_{HR}_mean"] == 80.0


def test_tail_reading_sparse_vs_dense(frames):
    v = [(1, hours(12.5), HR, 70.0)]
    assert [r.window_id for r in silver(frames, [(1, 100, 13, 0)], v)] == [2]
    dense = matrix(frames, [(1, 100, 13, 0)], v)
    assert len(dense) == 2 and all(r[f"vital_{HR}_missing"] == 1 for r in dense)


def test_single_reading_std_is_null(frames):
    r = silver(frames, [(1, 100, 6, 0)], [(1, hours(1), HR, 72.0)])[0]
    assert r[f"vital_{HR}_std"] is None and r[f"vital_{HR}_mean"] == 72.0


def test_nan_reading_is_missing(frames):
    r = silver(frames, [(1, 100, 6, 0)], [(1, hours(1), HR, float("nan")), (1, hours(2), 220179, 120.0)])[0]
    assert r[f"vital_{HR}_missing"] == 1 and r[f"vital_{HR}_mean"] is None


def test_all_single_readings_keep_std_column(frames):
    c, v, lab, labels = frames([(1, 100, 12, 0)], [(1, hours(1), HR, 70.0), (1, hours(7), HR, 75.0)])
    m = batch_matrix(v, lab, c, labels, CLINICAL)
    assert f"vital_{HR}_std" in m.columns and len(m.columns) == 43
    assert all(r[f"vital_{HR}_std"] is None for r in m.collect())


def labw(frames, cohort, labs):
    c, _, lab, _ = frames(cohort, (), labs)
    return lab_windows(lab, c, CLINICAL).orderBy("stay_id", "window_id").collect()


def test_interleaved_labs_both_present(frames):
    r = labw(frames, [(1, 100, 6, 0)], [(100, hours(1), 50912, 1.0), (100, hours(2), 50813, 2.0)])[0]
    assert r.lab_50912_last == 1.0 and r.lab_50813_last == 2.0


def test_equal_lab_times_pick_larger_value_in_any_order(frames):
    a = [(100, hours(1), 50912, 1.0), (100, hours(1), 50912, 2.0)]
    for rows in (a, list(reversed(a))):
        assert labw(frames, [(1, 100, 6, 0)], rows)[0].lab_50912_last == 2.0


def test_latest_lab_wins(frames):
    r = labw(frames, [(1, 100, 6, 0)], [(100, hours(1), 50912, 9.0), (100, hours(3), 50912, 1.0)])[0]
    assert r.lab_50912_last == 1.0


def test_two_stays_one_admission_fan_out(frames):
    cohort = [(1, 100, 200, 0), (2, 100, 200, 0, hours(48))]
    rows = labw(frames, cohort, [(100, hours(50), 50912, 3.0)])
    assert {(r.stay_id, r.window_id) for r in rows} == {(1, 8), (2, 0)}


def test_gold_elapsed_midpoint_and_contract(frames):
    c, v, lab, labels = frames([(1, 100, 6, 0)], [(1, hours(1), HR, 70.0)])
    g = gold_table(v, lab, c, labels, CLINICAL)
    assert g.columns == CLINICAL.gold_columns() and len(g.columns) == 43
    r = g.collect()[0]
    assert r.icu_hours_elapsed == 3.0 and r.time_of_day == 6
    b = matrix(frames, [(1, 100, 6, 0)], [(1, hours(1), HR, 70.0)])[0]
    assert b.icu_hours_elapsed == 6.0


def test_unknown_label_is_zero(frames, spark):
    c, v, lab, _ = frames([(1, 100, 6, 1)], [(1, hours(1), HR, 70.0)])
    empty = spark.createDataFrame([], "stay_id long, sepsis_label int")
    assert gold_table(v, lab, c, empty, CLINICAL).collect()[0].sepsis_label == 0


def test_conditional_and_pivot_forms_agree(spark):
    from stayframe.plans.mappings import events_inputs

    x = events_inputs(spark, "/root/testdata/sf0.001")
    a = silver_windows(x.vitals, x.stays, x.cfg)
    b = pivot_windows(x.vitals, x.stays, x.cfg)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_contract_error_names_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "stay_id long")
    with pytest.raises(ContractError, match="window_end"):
        assert_contract(df, ["stay_id", "window_end"])


def test_input_order_does_not_change_gold(spark):
    from stayframe.plans.mappings import lineitem_inputs

    x = lineitem_inputs(spark, "/root/testdata/sf0.001")
    a = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    shuffled = x.labs.orderBy("valuenum").repartition(5)
    b = gold_table(x.vitals, shuffled, x.stays, x.labels, x.cfg)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
