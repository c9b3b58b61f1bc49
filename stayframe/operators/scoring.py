"""Model training, scoring and prediction checks (MDL2-MDL6, SCR1-SCR3).

The boosted-tree learner is MLlib's ``GBTClassifier`` (distributed over the
cluster, no single-machine library): the reference settings map onto its
parameters as closely as MLlib allows.  MLlib trees reject NaN, so a feature
that is missing in training rows enters twice, with missing below and with
missing above all values: every split on it may send missing rows either way.
Rounds stop by patience on the validation rows (``boosting``).  Scoring is a
JVM ``transform``; probabilities are taken from the vector column without
Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import LABEL
from stayframe.functions import flag
from stayframe.operators.boosting import fit_with_patience
from stayframe.operators.ordering import with_scalars
from stayframe.session import checkpoint_dir

MISSING = 1e300  # beyond all values; with both signs


@dataclass(frozen=True)
class TreeSettings:
    """Boosted-tree settings.  ``v1``: 500 trees, depth 6, learning rate
    0.05, row and feature sampling 0.8, seed 42, stop after 20 rounds without a
    better validation AP.  ``v3``: 1000 trees, depth 5, at least 3 rows per
    leaf, stop after 50 rounds without a better AUROC."""

    max_iter: int = 500
    max_depth: int = 6
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    min_instances_per_node: int = 1
    seed: int = 42
    metric: str = "auprc"
    patience: int = 20


# Reference tree settings.
V1_SETTINGS = TreeSettings()
V3_SETTINGS = TreeSettings(max_iter=1000, max_depth=5, min_instances_per_node=3, metric="auroc", patience=50)


def assembler(features: Sequence[str], out: str = "features", paired: Sequence[str] | None = None):
    """MDL4: pipeline stages that cast features to double and gather them in
    one vector column, with NULL and NaN below all values; the ``paired``
    features (all by default) follow once more with NULL and NaN above all
    values.  The filled copies are added beside the raw columns, so a fitted
    pipeline scores any frame that carries the features, whatever else it
    holds."""
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    twice = set(features if paired is None else paired)
    copies = [(f"_low_{i}", c, -MISSING) for i, c in enumerate(features)] + [(f"_high_{i}", c, MISSING) for i, c in enumerate(features) if c in twice]
    fill = ", ".join(f"CASE WHEN `{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) THEN DOUBLE({v}) ELSE CAST(`{c}` AS DOUBLE) END AS `{name}`" for name, c, v in copies)
    return [
        SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__"),
        VectorAssembler(inputCols=[name for name, *_ in copies], outputCol=out),
    ]


def sometimes_missing(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that are NULL or NaN in some row (one aggregation)."""
    seen = df.agg(*[F.max(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [c for i, c in enumerate(features) if seen[f"m{i}"]]


def train_with_history(
    df: DataFrame,
    features: Sequence[str],
    settings: TreeSettings = V1_SETTINGS,
    label: str = LABEL,
    weight: str | None = "weight",
    split: str | None = "split",
):
    """MDL2/MDL3: ``(model, history)``.  Fits on the ``split == 'train'`` rows
    (all rows without a split column); the ``'val'`` rows choose the number of
    rounds by patience (without any, all rounds are kept and the history is
    empty).  The model is a ``PipelineModel`` (assembler + trees) that scores
    raw feature columns; the history has the validation metrics of each round."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import GBTClassifier

    checkpoint_dir(df.sparkSession)
    has_split = bool(split) and split in df.columns
    data = df.where(F.col(split) == "train") if has_split else df
    weighted = bool(weight) and weight in df.columns
    stages = Pipeline(stages=assembler(features, paired=sometimes_missing(data, features))).fit(df).stages

    def stored(rows: DataFrame) -> DataFrame:
        """Feature vectors in few partitions (AQE sizes them), read again by every round."""
        for s in stages:
            rows = s.transform(rows)
        cols = ["features", F.col(label).cast("double").alias(label), *([weight] if weighted else [])]
        return rows.select(*cols).hint("rebalance").checkpoint()

    gbt = GBTClassifier(
        featuresCol="features",
        labelCol=label,
        maxIter=settings.max_iter,
        maxDepth=settings.max_depth,
        stepSize=settings.step_size,
        subsamplingRate=settings.subsampling_rate,
        featureSubsetStrategy=settings.feature_subset,
        minInstancesPerNode=settings.min_instances_per_node,
        seed=settings.seed,
    )
    if weighted:
        gbt.setWeightCol(weight)
    rows = stored(data)
    validation = stored(df.where(F.col(split) == "val")) if has_split else None
    if validation is None or validation.isEmpty():
        trees, history = gbt.fit(rows), []
    else:
        trees, history = fit_with_patience(gbt, rows, validation, label, settings.metric, settings.patience)
    return PipelineModel([*stages, trees]), history


def train(
    df: DataFrame,
    features: Sequence[str],
    settings: TreeSettings = V1_SETTINGS,
    label: str = LABEL,
    weight: str | None = "weight",
    split: str | None = "split",
):
    """MDL2/MDL3: the model of ``train_with_history``."""
    return train_with_history(df, features, settings, label, weight, split)[0]


def importances(model, features: Sequence[str], k: int = 15) -> DataFrame:
    """MDL5: top-k named feature importances, descending (ties by name); a
    feature's two copies count together."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    names, trees = list(features), model.stages[-1]
    total = dict.fromkeys(names, 0.0)
    for copy, value in zip(model.stages[-2].getInputCols(), trees.featureImportances.toArray().tolist()):
        total[names[int(copy.rsplit("_", 1)[1])]] += float(value)
    df = spark.createDataFrame(list(total.items()), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(int(k))


def save_model(model, features: Sequence[str], path: str) -> str:
    """MDL6: model and its feature contract side by side."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(i, c) for i, c in enumerate(features)], "position int, feature string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/features")
    return path


def load_model(spark, path: str):
    """MDL6: returns ``(PipelineModel, feature list in contract order)``."""
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(f"{path}/model")
    cols = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    return model, cols


def score(df: DataFrame, model, prob: str = "sepsis_prob") -> DataFrame:
    """SCR1: probability of the positive class per row (JVM transform; the
    probability vector is unpacked with ``vector_to_array``)."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    keep = [c for c in df.columns if c != prob]
    return out.withColumn(prob, vector_to_array("probability")[1]).select(*keep, prob)


def score_foreign(
    df: DataFrame,
    model_factory,
    features: Sequence[str],
    prob: str = "sepsis_prob",
    model_key: str | None = None,
) -> DataFrame:
    """SCR1 for models Spark cannot run natively: an iterator Pandas UDF over
    Arrow batches of the feature columns only (never row-at-a-time; other
    columns stay in the JVM).  ``model_factory()`` builds the model once per
    Python worker, whatever the number of tasks; by default the key it is kept
    under is a digest of the factory, so two models never meet."""
    from pyspark import cloudpickle

    packed = cloudpickle.dumps(model_factory)
    key = model_key or hashlib.sha256(packed).hexdigest()
    cols = list(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        from stayframe.operators.worker_models import model

        held = model(key, cloudpickle.loads(packed))
        for pdf in batches:
            yield pd.Series(held.predict_proba(pdf[cols])[:, 1] if len(pdf) else [], dtype="float64")

    scored = F.pandas_udf(run, "double")
    return df.withColumn(prob, scored(F.struct(*[F.col(c) for c in cols])))


def alert(df: DataFrame, threshold: float, prob: str = "sepsis_prob", out: str = "sepsis_alert", stamp: bool = True) -> DataFrame:
    """SCR2: ``alert = prob >= threshold`` (inclusive) and ``predicted_at``."""
    res = df.withColumn(out, flag(F.col(prob) >= F.lit(float(threshold))))
    if stamp:
        res = res.withColumn("predicted_at", F.current_timestamp())
    return res


def check_predictions(
    scored: DataFrame,
    expected: DataFrame | None = None,
    prob: str = "sepsis_prob",
    alert_col: str = "sepsis_alert",
    rate_bounds: tuple[float, float] = (0.05, 0.95),
) -> DataFrame:
    """SCR3: every check in one aggregation pass (no cache, no repeated
    jobs): row count vs ``expected`` (a one-row frame with ``count``),
    probability range, alert values and alert rate.  Empty input gives
    NULL-safe results."""
    p = F.col(prob)
    a = F.col(alert_col)
    agg = scored.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.min(p).alias("prob_min"),
        F.max(p).alias("prob_max"),
        (F.count_if(~p.between(0.0, 1.0)) == 0).alias("prob_range_ok"),
        (F.count_if(~a.isin(0, 1)) == 0).alias("alert_values_ok"),
        F.count_if(a == 1).alias("n_alerts"),
        F.avg(a).alias("alert_rate"),
    )
    if expected is not None:
        agg = with_scalars(agg, expected.select(F.col("count").alias("n_expected")))
    else:
        agg = agg.withColumn("n_expected", F.col("n_predictions"))
    lo, hi = rate_bounds
    return agg.select(
        "n_predictions",
        "n_expected",
        (F.col("n_predictions") == F.col("n_expected")).alias("row_count_ok"),
        "prob_min",
        "prob_max",
        "prob_range_ok",
        "alert_values_ok",
        "n_alerts",
        "alert_rate",
        F.coalesce(F.col("alert_rate").between(lo, hi), F.lit(False)).alias("alert_rate_ok"),
    )
