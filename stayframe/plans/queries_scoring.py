"""Registered query: foreign-model scoring through Arrow batches (SCR1)."""

from __future__ import annotations

from stayframe.config import LABEL, STAY
from stayframe.operators.scoring import score_foreign
from stayframe.plans import oracle as Q
from stayframe.plans.catalog import inputs, register
from stayframe.plans.medallion import gold_table

# Fixed values of the stand-in foreign model (weights per Gold column, bias).
FOREIGN_WEIGHTS = {"vital_AF_mean": 0.00002, "vital_NO_mean": 0.00003, "lab_1_last": -0.00001, "time_of_day": 0.05}
FOREIGN_BIAS = -1.5


class LinearScorer:
    """A small picklable foreign model: logistic score of a linear function of
    features (NULL features count as 0).  Stands in for any object with a
    ``predict_proba(pandas.DataFrame) -> array`` method."""

    def __init__(self, weights: dict, bias: float):
        self.weights = dict(weights)
        self.bias = float(bias)

    def predict_proba(self, pdf):
        import numpy as np

        z = np.full(len(pdf), self.bias)
        for c, w in self.weights.items():
            z = z + w * pdf[c].astype("float64").fillna(0.0).to_numpy()
        p1 = 1.0 / (1.0 + np.exp(-z))
        return np.column_stack([1.0 - p1, p1])


def _make_model():
    return LinearScorer(FOREIGN_WEIGHTS, FOREIGN_BIAS)


def _scr1(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    g = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg).select(STAY, "window_end", LABEL, *FOREIGN_WEIGHTS)
    return score_foreign(g, _make_model, list(FOREIGN_WEIGHTS))


_z = " + ".join(f"{w} * coalesce(CAST({c} AS DOUBLE), 0.0)" for c, w in FOREIGN_WEIGHTS.items())
register(
    "SCR1_foreign_model_scoring_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT stay_id, window_end, sepsis_label, {', '.join(FOREIGN_WEIGHTS)},
       1.0 / (1.0 + exp(-({FOREIGN_BIAS} + {_z}))) AS sepsis_prob
FROM gold""",
    ),
    [c for c in FOREIGN_WEIGHTS if c != "time_of_day"] + ["sepsis_prob"],
)(_scr1)
