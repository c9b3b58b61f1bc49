"""Boosted trees round by round: staged margins, ranking metrics of every round, stop by patience (MDL2, MDL3).

A fitted forest's trees are read once as node tables; one pass over the
validation rows adds up each row's tree outputs and folds the running sums to
counts per (round, margin), so the exact AUROC and average precision of every
round come from the same distributed prefix sums as all other ranking metrics.
Boosting is deterministic for a seed and a stored frame: the first trees of a
longer fit are those of a shorter one. So rounds are fitted in growing chunks,
each folded from where the one before ended, until the best round lies the
patience back, and the kept model is the last fit's first trees: nothing is
fitted again for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.operators.metrics import ranking_of_counts
from stayframe.session import remove_scratch, scratch_path

BLOCK = 8192  # rows whose running sums a task holds at once


@dataclass(frozen=True)
class Trees:
    """Node tables of a forest, one row for each tree: split feature, threshold, children, output; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Running sums over the trees, a row for each row of ``x``."""
        tree, row = np.arange(len(self.weight))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.weight)), np.int32)
        for _ in range(self.depth):
            low = x[row, self.feature[tree, node]] <= self.threshold[tree, node]
            node = np.where(low, self.left[tree, node], self.right[tree, node])
        return np.cumsum(self.value[tree, node] * self.weight, axis=1)


def read_trees(model) -> Trees:
    """Node tables of a fitted ``GBTClassificationModel``, read from the form in which Spark saves it (bounded by trees x nodes)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    remove_scratch(spark, path)
    shape = (model.getNumTrees, max(r.id for r in rows) + 1)
    feature, left, right = (np.zeros(shape, np.int32) for _ in range(3))
    threshold, value = np.zeros(shape), np.zeros(shape)
    for r in rows:
        at = r.treeID, r.id
        leaf = r.leftChild < 0
        value[at] = r.prediction
        left[at], right[at] = (r.id, r.id) if leaf else (r.leftChild, r.rightChild)
        if not leaf:
            feature[at], threshold[at] = r.split.featureIndex, r.split.leftCategoriesOrThreshold[0]
    return Trees(feature, threshold, left, right, value, np.array(model.treeWeights), max(t.depth for t in model.trees))


def _folded(batches, trees, after: int):
    import pyarrow as pa

    for b in batches:
        x = np.array(b.column("x").flatten()).reshape(b.num_rows, -1)
        label = b.column("label").to_numpy()
        for at in range(0, len(x), BLOCK):
            y = label[at : at + BLOCK]
            for k, margin in enumerate(trees.value.margins(x[at : at + BLOCK])[:, after:].T, after):
                score, where = np.unique(margin, return_inverse=True)
                pos, n = np.bincount(where, weights=y == 1), np.bincount(where)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k + 1, np.int32)), pa.array(score), pa.array(pos.astype(np.int64)), pa.array(n - pos.astype(np.int64))], ["round", "score", "pos", "neg"])


def staged_metrics(rows: DataFrame, model, label: str, features: str = "features", after: int = 0) -> DataFrame:
    """round, n_pos, n_neg, auroc, auprc of every prefix of more than ``after`` trees over rows with a feature vector (labels 0 and 1)."""
    from pyspark.ml.functions import vector_to_array

    shared = rows.sparkSession.sparkContext.broadcast(read_trees(model))
    x = rows.where(F.col(label).isin(0, 1)).select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("label"))
    folded = x.mapInArrow(partial(_folded, trees=shared, after=after), "round int, score double, pos long, neg long")
    counts = folded.groupBy("round", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return ranking_of_counts(counts, "score", ["round"])


def best_round(values: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """The round (from 1) to keep and whether the search is over: the first maximum before ``patience`` rounds without a greater value."""
    best, at = None, 0
    for k, v in enumerate(values, 1):
        if v is not None and (best is None or v > best):
            best, at = v, k
        elif at and k - at >= patience:
            return at, True
    return (at or len(values)), False


def next_rounds(rounds: int, at: int, patience: int) -> int:
    """Rounds of the next fit when ``rounds`` are tried and the best, ``at``, lies less than the patience back.

    A best round far back only needs the rest of its patience. One found since
    means that the metric still rises: rounds double then. A fit that ran up to
    a patience's end has a new best in its last half patience or is the last,
    so every second fit doubles and all fits together stay within a few times
    the rounds needed.
    """
    return at + patience if 2 * (rounds - at) >= patience else max(2 * rounds, at + patience)


def first_trees(model, n: int):
    """The classifier of a fitted ``GBTClassificationModel``'s first ``n`` trees: what a fit of ``n`` rounds gives."""
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel

    if n == model.getNumTrees:
        return model
    gateway, whole = SparkContext._active_spark_context._gateway, model._java_obj
    package = gateway.jvm.org.apache.spark.ml
    trees, weights = gateway.new_array(package.regression.DecisionTreeRegressionModel, n), gateway.new_array(gateway.jvm.double, n)
    every, given = whole.trees(), model.treeWeights
    for k in range(n):
        trees[k], weights[k] = every[k], given[k]
    kept = GBTClassificationModel(package.classification.GBTClassificationModel(model.uid, trees, weights))
    return model._copyValues(kept)


def fit_with_patience(learner, train: DataFrame, validation: DataFrame, label: str, metric: str, patience: int):
    """``(model, history)``: the best prefix of at most the learner's ``maxIter`` trees and the metrics of every round tried.

    ``train`` and ``validation`` must be stored frames (checkpointed), so that
    every fit sees the same rows in the same order. Without both classes in
    ``validation`` all rounds are kept.
    """
    most = learner.getMaxIter()
    rounds, history = min(most, patience + 10), []
    while True:
        model = learner.copy({learner.maxIter: rounds}).fit(train)
        history += sorted(staged_metrics(validation, model, label, after=len(history)).collect(), key=lambda r: r["round"])  # a row for each round
        known = [r[metric] for r in history]
        if not any(v is not None for v in known):
            return (model if rounds == most else learner.fit(train)), history
        at, over = best_round(known, patience)
        if over or rounds == most:
            return first_trees(model, at), history
        rounds = min(most, next_rounds(rounds, at, patience))
