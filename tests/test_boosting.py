"""Stop by patience and routing of missing values, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayframe.operators import boosting
from stayframe.operators.scoring import TreeSettings, importances, score, train, train_with_history


def plain_metrics(score, y):
    order = np.argsort(-score, kind="stable")
    s, y = score[order], y[order]
    ends = np.flatnonzero(np.append(s[1:] != s[:-1], True))
    tp, n = np.cumsum(y)[ends], ends + 1
    fp = n - tp
    p, q = tp[-1], fp[-1]
    auroc = np.trapezoid(np.append(0, tp), np.append(0, fp)) / (p * q)
    return auroc, float((np.diff(np.append(0, tp)) * tp / n).sum() / p)


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        a, b = rng.random(), rng.random()
        label = int(a + 0.8 * rng.random() > 0.9)
        rows.append((i, a if i % 6 else None, b, rng.random(), label, "train" if i < 300 else "val" if i < 700 else "test", 1.0 + label))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, sepsis_label int, split string, weight double").checkpoint()


def test_every_round_s_metrics_and_the_best_prefix(spark, noisy):
    settings = TreeSettings(max_iter=90, max_depth=4, step_size=0.3, patience=8, metric="auroc")
    model, history = train_with_history(noisy, ["a", "b", "c"], settings)
    assert [r["round"] for r in history] == list(range(1, len(history) + 1)) and len(history) < 90
    # the whole ensemble's scores of the first k trees, by Spark's own trees
    val = noisy.where("split = 'val'")
    for s in model.stages[:-1]:
        val = s.transform(val)
    val = val.select("sepsis_label", vector_to_array("features").alias("x"), "features").toPandas()
    y, trees = val.sepsis_label.to_numpy(), model.stages[-1].trees
    margin = np.zeros(len(y))
    for k, tree in enumerate(trees):
        margin = margin + np.array([tree.predict(v) for v in val.features]) * model.stages[-1].treeWeights[k]
        auroc, auprc = plain_metrics(margin, y)
        assert abs(history[k].auroc - auroc) < 1e-12 and abs(history[k].auprc - auprc) < 1e-12
    # brute-force choice
    values = [r.auroc for r in history]
    best = 0
    for k, v in enumerate(values):
        if v > values[best]:
            best = k
        if k - best >= 8:
            break
    assert len(trees) == best + 1


def test_the_choice_of_rounds():
    assert boosting.best_round([0.5, 0.6, 0.6, 0.6], 2) == (2, True)
    assert boosting.best_round([0.5, 0.6, 0.55], 2) == (2, False)
    assert boosting.best_round([0.5, 0.4, 0.4, 0.9], 2) == (1, True)  # a later rise beyond the patience is not seen
    assert boosting.best_round([None, None], 2) == (2, False)


def test_only_the_direction_of_missing_separates(spark):
    # values on both sides of the middle are negative, missing is positive, and missing must go with the middle
    rows = []
    for i in range(300):
        kind = i % 3
        rows.append((i, [0.1, None, 0.9][kind] if i % 2 else [0.2, float("nan"), 0.8][kind], float(i % 7), int(kind != 0), "train"))
    low = spark.createDataFrame(rows, "id long, a double, b double, sepsis_label int, split string")
    settings = TreeSettings(max_iter=1, max_depth=1, subsampling_rate=1.0, feature_subset="all")
    for data in (low, low.withColumn("sepsis_label", (F.col("a").isNull() | F.isnan("a") | (F.col("a") < 0.5)).cast("int"))):
        model = train(data, ["a", "b"], settings, weight=None)
        wrong = score(data, model).where((F.col("sepsis_prob") >= 0.5) != (F.col("sepsis_label") == 1)).count()
        assert wrong == 0  # one split is enough in either direction
        top = importances(model, ["a", "b"]).collect()
        assert [r.feature for r in top] == ["a", "b"] and abs(top[0].importance - 1.0) < 1e-9


def test_one_class_validation_keeps_all_rounds(spark, noisy):
    data = noisy.where("split <> 'val' OR sepsis_label = 1")
    model, history = train_with_history(data, ["a", "b"], TreeSettings(max_iter=14, max_depth=2, patience=3))
    assert model.stages[-1].getNumTrees == 14 and all(r.auroc is None for r in history)


def test_no_round_is_fitted_again_for_the_kept_model(spark, noisy, tmp_path):
    from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["b", "c"], outputCol="features").transform(noisy.withColumn("sepsis_label", F.col("sepsis_label").cast("double"))).select("features", "sepsis_label", "split").checkpoint()
    train_rows, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    fitted = []

    class Counted(GBTClassifier):
        def fit(self, *args):
            fitted.append(self.getMaxIter())
            return super().fit(*args)

    learner = Counted(labelCol="sepsis_label", maxIter=60, maxDepth=2, stepSize=0.3, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
    model, history = boosting.fit_with_patience(learner, train_rows, val, "sepsis_label", "auroc", 8)
    best = model.getNumTrees
    assert len(history) == fitted[-1] > best and best not in fitted  # each fit goes beyond the one before
    assert fitted == sorted(set(fitted))
    again = GBTClassifier(labelCol="sepsis_label", maxIter=best, maxDepth=2, stepSize=0.3, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42).fit(train_rows)
    shape = lambda m: m.toDebugString.split("\n", 1)[1]
    assert shape(model) == shape(again) and model.treeWeights == again.treeWeights
    model.write().save(str(tmp_path / "model"))
    loaded = GBTClassificationModel.load(str(tmp_path / "model"))
    p = [m.transform(val).select(vector_to_array("probability")[1]).collect() for m in (model, again, loaded)]
    assert p[0] == p[1] == p[2]
    assert dict(zip(range(2), again.featureImportances.toArray())) == dict(zip(range(2), model.featureImportances.toArray()))


def test_the_size_of_the_next_fit():
    assert boosting.next_rounds(60, 19, 50) == 69  # the rest of the patience
    assert boosting.next_rounds(60, 55, 50) == 120  # still rising
    assert boosting.next_rounds(10, 10, 50) == 60
