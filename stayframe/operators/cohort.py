"""Cohort table and code-based stay labels (COH1, COH2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.config import ADMISSION, INTIME, LABEL, OUTTIME, STAY, SUBJECT
from stayframe.functions import elapsed_micros

# Diagnosis codes that mark a positive admission, by coding
# version: ICD-10 codes starting A40 or A41; ICD-9 codes 99591 and 99592.
SEPSIS_CODE_RULES = {10: ("A40", "A41"), 9: ("99591", "99592")}


def build_cohort(
    stays: DataFrame,
    patients: DataFrame | None = None,
    labels: DataFrame | None = None,
    patient_cols: Sequence[str] = ("anchor_age",),
) -> DataFrame:
    """COH1: one row per stay with ``los_icu_hours``, demographics and the
    label (0 when unknown)."""
    c = stays.withColumn("los_icu_hours", elapsed_micros(INTIME, OUTTIME).cast("double") / F.lit(3.6e9))
    if patients is not None:
        c = c.join(patients.select(SUBJECT, *patient_cols), SUBJECT, "left")
    if labels is not None:
        c = c.join(labels.select(STAY, LABEL), STAY, "left")
        c = c.withColumn(LABEL, F.coalesce(F.col(LABEL).cast("int"), F.lit(0)))
    return c


def label_by_code(
    diagnoses: DataFrame,
    admissions: DataFrame,
    rules: Mapping[int, Sequence[str]] = SEPSIS_CODE_RULES,
    code: str = "icd_code",
    version: str = "icd_version",
    key: str = ADMISSION,
) -> DataFrame:
    """COH2: label 1 for an admission with any diagnosis code starting with
    a listed prefix of its coding version, else 0.  The matching admissions
    are de-duplicated (a shuffle of admission keys only) and left-joined to
    the admission table."""
    cond = None
    for ver, prefixes in rules.items():
        starts = None
        for p in prefixes:
            s = F.col(code).startswith(p)
            starts = s if starts is None else (starts | s)
        term = (F.col(version) == F.lit(ver)) & starts
        cond = term if cond is None else (cond | term)
    positive = diagnoses.where(cond).select(key).distinct().withColumn("_pos", F.lit(1))
    return (
        admissions.select(key)
        .join(positive, key, "left")
        .select(key, F.coalesce(F.col("_pos"), F.lit(0)).cast("int").alias(LABEL))
    )
