"""Foreign-model scoring and request-style lag features."""

from __future__ import annotations

import numpy as np
import pytest

from stayframe.config import CLINICAL
from stayframe.operators.scoring import score_foreign
from stayframe.operators.temporal import lags_from_previous
from stayframe.plans.queries_scoring import LinearScorer


def test_score_foreign_matches_numpy(spark):
    rows = [(i, float(i) if i % 3 else None, float(10 - i)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(4)
    out = {r.id: r.sepsis_prob for r in score_foreign(df, lambda: LinearScorer({"a": 0.1, "b": -0.2}, 0.3), ["a", "b"]).collect()}
    for i, a, b in rows:
        z = 0.3 + 0.1 * (a or 0.0) - 0.2 * b
        assert out[i] == pytest.approx(1.0 / (1.0 + np.exp(-z)), rel=1e-12)


def test_lags_from_previous_map(spark):
    base = {c: 1.0 for c in CLINICAL.lag_base_columns()}
    flags = {c: 0 for c in CLINICAL.vital_missing_columns()}
    schema = ", ".join(f"{c} double" for c in base) + ", " + ", ".join(f"{c} int" for c in flags) + ", rid int, previous_window map<string,double>"
    prev_full = {**{c: 0.5 for c in base}, **{c: 1.0 for c in flags}}
    prev_partial = {"vital_220045_mean": 0.25}
    data = [
        tuple(base.values()) + tuple(flags.values()) + (1, prev_full),
        tuple(base.values()) + tuple(flags.values()) + (2, {}),
        tuple(base.values()) + tuple(flags.values()) + (3, None),
        tuple(base.values()) + tuple(flags.values()) + (4, prev_partial),
    ]
    df = spark.createDataFrame(data, schema)
    out = {r.rid: r for r in lags_from_previous(df, CLINICAL).collect()}
    assert out[1].vital_220045_mean_lag1 == 0.5 and out[1].vital_220045_mean_delta == 0.5
    assert out[1].n_missing_vitals == 0.0 and out[1].n_missing_vitals_lag1 == 6.0 and out[1].missing_trend == -6.0
    for rid in (2, 3):  # empty or absent map: no previous window
        assert out[rid].vital_220045_mean_lag1 is None and out[rid].missing_trend is None
    assert out[4].vital_220045_mean_lag1 == 0.25 and out[4].lab_50912_last_lag1 is None
    assert out[4].n_missing_vitals_lag1 == 0.0


def test_foreign_models_are_built_once_per_worker_and_kept_apart(spark, tmp_path):
    def factory(bias, folder=str(tmp_path)):
        import os
        import uuid

        open(f"{folder}/{bias}_{os.getpid()}_{uuid.uuid4().hex}", "w").close()
        return LinearScorer({"a": 0.0}, bias)

    df = spark.range(2000).selectExpr("id", "double(id) AS a", "'kept' AS other").repartition(40)
    one = score_foreign(df, lambda: factory(1.0), ["a"], "p1")
    both = score_foreign(one, lambda: factory(-1.0), ["a"], "p2").collect()
    assert {(round(r.p1, 6), round(r.p2, 6), r.other) for r in both} == {(0.731059, 0.268941, "kept")}
    built = [tuple(f.name.split("_")[:2]) for f in tmp_path.iterdir()]
    assert len(built) == len(set(built))  # never twice in one worker
