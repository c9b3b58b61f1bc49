"""Exact, tie-aware ranking and threshold metrics (EVL1-EVL7).

Rows collapse first to a histogram of distinct scores with positive and
negative counts (partial aggregation, so a popular score costs one row per
task).  Cumulative counts in descending score order come from the
distributed prefix sum, never from a single-partition window.  From them:

* AUROC = Σ neg_s · (TP_before_s + pos_s / 2) / (P · N)  (ties count 1/2),
* average precision = Σ (pos_s / P) · precision_s  (step sum, ties grouped;
  not the trapezoid area),
* the ROC curve with thresholds at the distinct scores (plus +inf) and the
  Youden threshold argmax(TPR - FPR), highest threshold on ties.

Every function takes ``by`` columns to compute the same metrics for many
groups in one pass.  One-class groups give NULL AUROC / AP.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.config import LABEL
from stayframe.functions import safe_div
from stayframe.operators.ordering import global_prefix, union_parts


def score_histogram(
    df: DataFrame,
    score: str = "score",
    label: str = LABEL,
    by: Sequence[str] = (),
    alert: Column | None = None,
) -> DataFrame:
    """Counts per distinct score: ``pos``, ``neg`` and, with an ``alert``
    condition, the alerted ``pos_alert``, ``neg_alert`` (so threshold metrics
    come from the same pass as the ranking metrics)."""
    pos = F.col(label) == 1
    neg = F.col(label) == 0
    aggs = [F.count_if(pos).alias("pos"), F.count_if(neg).alias("neg")]
    if alert is not None:
        aggs += [F.count_if(pos & alert).alias("pos_alert"), F.count_if(neg & alert).alias("neg_alert")]
    return df.groupBy(*by, score).agg(*aggs)


def cumulative_counts(
    df: DataFrame,
    score: str = "score",
    label: str = LABEL,
    by: Sequence[str] = (),
    alert: Column | None = None,
) -> DataFrame:
    """Per distinct score (descending): pos, neg, tp = positives with score
    >= s, fp likewise, and group totals P, N (plus alerted counts)."""
    extra = ["pos_alert", "neg_alert"] if alert is not None else []
    return cumulative_of_counts(score_histogram(df, score, label, by, alert), score, by, extra)


def cumulative_of_counts(h: DataFrame, score: str = "score", by: Sequence[str] = (), extra: Sequence[str] = (), following: Sequence[str] = ()) -> DataFrame:
    """``cumulative_counts`` from counts ``pos``, ``neg`` per distinct score; ``following`` adds the next lower score's as ``_next_{c}``."""
    c = global_prefix(h, [F.col(score).desc()], ["pos", "neg"], by, totals=True, following=following)
    return c.select(
        *by,
        score,
        "pos",
        "neg",
        *extra,
        F.col("pos_cum").alias("tp"),
        F.col("neg_cum").alias("fp"),
        F.col("pos_total").alias("P"),
        F.col("neg_total").alias("N"),
        *[f"_next_{c}" for c in following],
    )


def _ranking_aggs() -> list[Column]:
    auc_term = F.col("neg").cast("double") * (
        (F.col("tp") - F.col("pos")).cast("double") + F.col("pos").cast("double") / F.lit(2.0)
    )
    ap_term = F.col("pos").cast("double") * safe_div("tp", F.col("tp") + F.col("fp"))
    return [
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(auc_term).alias("_auc"),
        F.sum(ap_term).alias("_ap"),
    ]


def _ranking_cols() -> list[Column]:
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return [
        F.when(both, safe_div("_auc", F.col("n_pos") * F.col("n_neg"))).alias("auroc"),
        F.when(both, safe_div("_ap", "n_pos")).alias("auprc"),
    ]


def ranking_metrics(df: DataFrame, score: str = "score", label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """EVL2 + EVL3: ``n_pos, n_neg, auroc, auprc`` per group."""
    return ranking_of_counts(score_histogram(df, score, label, by), score, by)


def ranking_of_counts(h: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """``ranking_metrics`` from counts ``pos``, ``neg`` per distinct score."""
    c = cumulative_of_counts(h, score, by)
    return c.groupBy(*by).agg(*_ranking_aggs()).select(*by, "n_pos", "n_neg", *_ranking_cols())


def report_metrics(
    df: DataFrame,
    score: str = "score",
    label: str = LABEL,
    by: Sequence[str] = (),
    threshold: float | None = None,
    alert: str | None = None,
) -> DataFrame:
    """Ranking and threshold metrics per group from ONE pass over the rows:
    the score histogram carries alerted counts, so nothing upstream is
    evaluated twice.  Alert = ``alert == 1`` or ``score >= threshold``.

    Columns: ``n, n_pos, n_neg, auroc, auprc, tp, fp, tn, fn, precision,
    recall, f1, alert_rate``; zero divisions in the threshold metrics are 0.
    """
    cond = (F.col(alert) == 1) if alert else (F.col(score) >= F.lit(float(threshold)))
    c = cumulative_counts(df, score, label, by, cond)
    agg = c.groupBy(*by).agg(
        *_ranking_aggs(), F.sum("pos_alert").alias("tp"), F.sum("neg_alert").alias("fp")
    )

    def zdiv(num, den):
        return F.coalesce(safe_div(num, den), F.lit(0.0))

    n = F.col("n_pos") + F.col("n_neg")
    fn = F.col("n_pos") - F.col("tp")
    tn = F.col("n_neg") - F.col("fp")
    return agg.select(
        *by,
        n.alias("n"),
        "n_pos",
        "n_neg",
        *_ranking_cols(),
        "tp",
        "fp",
        tn.alias("tn"),
        fn.alias("fn"),
        zdiv("tp", F.col("tp") + F.col("fp")).alias("precision"),
        zdiv("tp", F.col("n_pos")).alias("recall"),
        zdiv(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + fn).alias("f1"),
        zdiv(F.col("tp") + F.col("fp"), n).alias("alert_rate"),
    )


def roc_curve(df: DataFrame, score: str = "score", label: str = LABEL, by: Sequence[str] = (), thin: bool = False) -> DataFrame:
    """EVL4: ``threshold, tpr, fpr`` at every distinct score plus the
    starting point (+inf, 0, 0); NULL rates for one-class groups.

    ``thin`` leaves out the inner points on a straight line between their
    neighbours with equal steps, as a curve drawn by the reference does: a
    point whose next step adds the same numbers of positives and negatives as
    its own.  The first and the last score always stay."""
    c = cumulative_of_counts(score_histogram(df, score, label, by), score, by, following=["pos", "neg"] if thin else [])
    if thin:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        c = c.where(first | F.col("_next_pos").isNull() | (F.col("_next_pos") != F.col("pos")) | (F.col("_next_neg") != F.col("neg")))
    pts = c.select(
        *by,
        F.col(score).cast("double").alias("threshold"),
        safe_div("tp", "P").alias("tpr"),
        safe_div("fp", "N").alias("fpr"),
    )
    start = c.groupBy(*by).agg(F.max("P").alias("P"), F.max("N").alias("N")).select(
        *by,
        F.lit(float("inf")).alias("threshold"),
        F.when(F.col("P") > 0, F.lit(0.0)).alias("tpr"),
        F.when(F.col("N") > 0, F.lit(0.0)).alias("fpr"),
    )
    return union_parts(start, pts)


def youden_threshold(df: DataFrame, score: str = "score", label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """EVL4: threshold maximising TPR - FPR (first, i.e. highest, on ties)."""
    r = roc_curve(df, score, label, by).withColumn("j", F.col("tpr") - F.col("fpr")).where(F.col("j").isNotNull())
    return r.groupBy(*by).agg(
        F.max_by("threshold", F.struct("j", "threshold")).alias("threshold"),
        F.max("j").alias("youden_j"),
    )


def at_threshold(
    df: DataFrame,
    threshold: float | None = None,
    score: str = "score",
    label: str = LABEL,
    by: Sequence[str] = (),
    alert: str | None = None,
) -> DataFrame:
    """EVL1/EVL5/EVL7 in one pass: confusion counts, precision, recall, F1
    and alert rate with alert = ``score >= threshold`` (inclusive) or an
    existing ``alert`` column.  Zero division gives 0 (precision/recall/F1)."""
    a = (F.col(alert) == 1) if alert else (F.col(score) >= F.lit(threshold))
    pos = F.col(label) == 1
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(a & pos).alias("tp"),
        F.count_if(a & ~pos).alias("fp"),
        F.count_if(~a & ~pos).alias("tn"),
        F.count_if(~a & pos).alias("fn"),
    )

    def zdiv(num, den):
        return F.coalesce(safe_div(num, den), F.lit(0.0))

    return agg.select(
        *by,
        "n",
        "tp",
        "fp",
        "tn",
        "fn",
        zdiv("tp", F.col("tp") + F.col("fp")).alias("precision"),
        zdiv("tp", F.col("tp") + F.col("fn")).alias("recall"),
        zdiv(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        zdiv(F.col("tp") + F.col("fp"), "n").alias("alert_rate"),
    )


def confusion(df: DataFrame, label: str = LABEL, alert: str = "sepsis_alert") -> DataFrame:
    """EVL1: count per (label, alert)."""
    return df.groupBy(label, alert).agg(F.count(F.lit(1)).alias("n"))


def recall_at(df: DataFrame, threshold: float, score: str = "score", label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """EVL7: share of positives alerted at the threshold."""
    return at_threshold(df, threshold, score, label, by).select(*by, "recall")


def metrics_table(df: DataFrame, threshold: float, score: str = "score", label: str = LABEL) -> DataFrame:
    """EVL6: ``(metric, value)`` rows: AUROC, AUPRC, precision/recall/F1 at
    the threshold, the threshold, and the class composition."""
    both = report_metrics(df, score, label, threshold=threshold)
    n_total = F.col("n_pos") + F.col("n_neg")
    pairs = [
        ("auroc", F.col("auroc")),
        ("auprc", F.col("auprc")),
        ("precision", F.col("precision")),
        ("recall", F.col("recall")),
        ("f1", F.col("f1")),
        ("threshold", F.lit(float(threshold))),
        ("n_positive", F.col("n_pos").cast("double")),
        ("n_negative", F.col("n_neg").cast("double")),
        ("n_total", n_total.cast("double")),
        ("pct_positive", F.lit(100.0) * safe_div("n_pos", n_total)),
        ("pct_negative", F.lit(100.0) * safe_div("n_neg", n_total)),
    ]
    wide = both.select(*[c.cast("double").alias(f"m{i}") for i, (_, c) in enumerate(pairs)])
    stack = ", ".join(f"'{name}', m{i}" for i, (name, _) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (metric, value)")
