"""Subgroup performance report (SUB1).

Each row is exploded into the subgroups it belongs to (Overall, one age
bucket, one length-of-stay bucket, one shift), then every metric is computed
grouped by subgroup in a single pass: the ranking metrics from the shared
score histogram, the threshold metrics from one conditional aggregation.
Subgroups under ``min_rows`` rows or ``min_positives`` positives are omitted
(Overall included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import LABEL
from stayframe.functions import right_closed_bucket, safe_div
from stayframe.operators.metrics import report_metrics

# Bucket edges (right-closed intervals) and labels of the
# subgroup report, in report order.
AGE_EDGES = (0, 45, 65, 80, 120)
AGE_LABELS = ("Age 18-45", "Age 45-65", "Age 65-80", "Age 80+")
LOS_EDGES = (-1, 24, 72, 99999)
LOS_LABELS = ("LOS Early (0-24h)", "LOS Mid (24-72h)", "LOS Extended (72h+)")
SHIFT_LABELS = ("Shift Day (6am-6pm)", "Shift Night (6pm-6am)")
DAY_START, DAY_END = 6, 18

REPORT_ORDER = ("Overall",) + AGE_LABELS + LOS_LABELS + SHIFT_LABELS


def subgroup_membership(
    df: DataFrame,
    age: str = "anchor_age",
    elapsed: str = "icu_hours_elapsed",
    hour: str = "time_of_day",
) -> DataFrame:
    """One row per (input row, subgroup it belongs to); rows with an age or
    elapsed time outside every bucket join only the other subgroups."""
    shift = F.when((F.col(hour) >= DAY_START) & (F.col(hour) < DAY_END), F.lit(SHIFT_LABELS[0])).otherwise(
        F.lit(SHIFT_LABELS[1])
    )
    groups = F.array(
        F.lit("Overall"),
        right_closed_bucket(age, AGE_EDGES, AGE_LABELS),
        right_closed_bucket(elapsed, LOS_EDGES, LOS_LABELS),
        shift,
    )
    return df.withColumn("subgroup", F.explode(groups)).where(F.col("subgroup").isNotNull())


def subgroup_report(
    df: DataFrame,
    threshold: float = 0.35,
    prob: str = "sepsis_prob",
    label: str = LABEL,
    alert: str = "sepsis_alert",
    age: str = "anchor_age",
    elapsed: str = "icu_hours_elapsed",
    hour: str = "time_of_day",
    min_rows: int = 100,
    min_positives: int = 10,
) -> DataFrame:
    """Columns: ``subgroup, report_order, n_windows, sepsis_rate, auroc,
    auprc, recall, precision, alert_rate`` (numeric; see
    ``format_report`` for the percentage text view)."""
    m = subgroup_membership(df.select(prob, label, alert, age, elapsed, hour), age, elapsed, hour)
    j = report_metrics(m, prob, label, ["subgroup"], alert=alert)
    positives = F.col("n_pos")
    order = F.array_position(F.array(*[F.lit(x) for x in REPORT_ORDER]), F.col("subgroup")).cast("int")
    out = j.where((F.col("n") >= min_rows) & (positives >= min_positives)).select(
        "subgroup",
        order.alias("report_order"),
        F.col("n").alias("n_windows"),
        safe_div(positives, "n").alias("sepsis_rate"),
        "auroc",
        "auprc",
        "recall",
        "precision",
        "alert_rate",
    )
    return out


def format_report(report: DataFrame, threshold: float = 0.35) -> DataFrame:
    """Text view of the report as it is usually published: rates as
    percentages with one decimal, AUROC/AUPRC with three."""
    pct = lambda c: F.format_string("%.1f%%", F.col(c) * F.lit(100.0))
    return report.orderBy("report_order").select(
        F.col("subgroup").alias("Subgroup"),
        F.col("n_windows"),
        pct("sepsis_rate").alias("sepsis_rate"),
        F.format_string("%.3f", "auroc").alias("AUROC"),
        F.format_string("%.3f", "auprc").alias("AUPRC"),
        pct("recall").alias(f"Recall@{threshold}"),
        pct("precision").alias(f"Precision@{threshold}"),
        pct("alert_rate").alias("Alert_rate"),
    )
