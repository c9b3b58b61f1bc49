"""Item lists, window length and the column contracts derived from them.

Canonical column names used by every operator:

* stays:        ``stay_id, hadm_id, subject_id, intime, outtime``
* vitals:       ``stay_id, charttime, itemid, valuenum`` (keyed by stay)
* labs:         ``hadm_id, charttime, itemid, valuenum`` (keyed by admission)
* labels:       ``stay_id, sepsis_label``
* patients:     ``subject_id, anchor_age``

Mappings in ``stayframe.plans.mappings`` rename other tables into these roles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

STAY = "stay_id"
ADMISSION = "hadm_id"
SUBJECT = "subject_id"
TIME = "charttime"
ITEM = "itemid"
VALUE = "valuenum"
INTIME = "intime"
OUTTIME = "outtime"
LABEL = "sepsis_label"
WINDOW = "window_id"

VITAL_STATS = ("mean", "min", "max", "std", "missing")
LAB_STATS = ("last", "missing")

# Fixed values that must equal the reference's for the clinical setting:
# vital item ids in order (heart rate, systolic BP, respiratory rate, SpO2,
# temperature F, GCS), lab item ids in order (creatinine, lactate, WBC,
# bilirubin), window of 6 hours, alert thresholds 0.35 (v1) and 0.49 (v3).
CLINICAL_VITALS = (220045, 220179, 220210, 220277, 223761, 223900)
CLINICAL_LABS = (50912, 50813, 51301, 50885)
CLINICAL_WINDOW_SECONDS = 6 * 3600
THRESHOLD_V1 = 0.35
THRESHOLD_V3 = 0.49

# Plausible range per vital item, inclusive at both ends.
CLINICAL_RANGES = {
    220045: (20.0, 300.0),
    220179: (40.0, 300.0),
    220210: (4.0, 60.0),
    220277: (50.0, 100.0),
    223761: (95.0, 107.0),
    223900: (1.0, 15.0),
}


@dataclass(frozen=True)
class WindowConfig:
    """Items to featurise and the tumbling-window length (seconds)."""

    vital_items: tuple = CLINICAL_VITALS
    lab_items: tuple = CLINICAL_LABS
    window_seconds: int = CLINICAL_WINDOW_SECONDS
    threshold: float = THRESHOLD_V1
    ranges: dict = field(default_factory=lambda: dict(CLINICAL_RANGES))

    # -- column contracts -------------------------------------------------
    def vital_columns(self) -> list[str]:
        return [f"vital_{i}_{s}" for i in self.vital_items for s in VITAL_STATS]

    def lab_columns(self) -> list[str]:
        return [f"lab_{i}_{s}" for i in self.lab_items for s in LAB_STATS]

    def vital_missing_columns(self) -> list[str]:
        return [f"vital_{i}_missing" for i in self.vital_items]

    def lag_base_columns(self) -> list[str]:
        """Columns that get lag-1 and delta: vital means, then lab lasts."""
        return [f"vital_{i}_mean" for i in self.vital_items] + [
            f"lab_{i}_last" for i in self.lab_items
        ]

    def gold_columns(self) -> list[str]:
        """The Gold / batch-matrix contract (43 columns for 6 vitals, 4 labs)."""
        return (
            [STAY, "window_end"]
            + self.vital_columns()
            + self.lab_columns()
            + ["icu_hours_elapsed", "time_of_day", LABEL]
        )

    def base_feature_columns(self) -> list[str]:
        return self.vital_columns() + self.lab_columns() + ["icu_hours_elapsed", "time_of_day"]

    def lag_feature_columns(self) -> list[str]:
        out = []
        for c in self.lag_base_columns():
            out += [f"{c}_lag1", f"{c}_delta"]
        return out

    def v3_feature_columns(self) -> list[str]:
        """Base features, interleaved (lag1, delta) pairs, then missingness trend."""
        return (
            self.base_feature_columns()
            + self.lag_feature_columns()
            + ["n_missing_vitals", "n_missing_vitals_lag1", "missing_trend"]
        )

    @property
    def window_micros(self) -> int:
        return int(self.window_seconds) * 1_000_000

    @property
    def window_hours(self) -> float:
        return self.window_seconds / 3600.0


CLINICAL = WindowConfig()
