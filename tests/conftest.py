from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

T0 = dt.datetime(2020, 1, 1, 0, 0, 0)

COHORT_SCHEMA = (
    "subject_id long, hadm_id long, stay_id long, gender string, anchor_age int, admittime timestamp_ntz, "
    "intime timestamp_ntz, outtime timestamp_ntz, los_icu_hours double, sepsis_label int"
)
VITALS_SCHEMA = "stay_id long, charttime timestamp_ntz, itemid int, valuenum double"
LABS_SCHEMA = "hadm_id long, charttime timestamp_ntz, itemid int, valuenum double"


@pytest.fixture(scope="session")
def spark():
    from stayframe.session import local_session

    s = local_session("*", 8, "8g")
    yield s


def hours(h: float) -> dt.datetime:
    return T0 + dt.timedelta(hours=h)


def cohort_rows(specs):
    """specs: (stay_id, hadm_id, los_hours, label[, intime])."""
    rows = []
    for spec in specs:
        sid, hid, los, label = spec[:4]
        start = spec[4] if len(spec) > 4 else T0
        rows.append(
            (sid * 10, hid, sid, "M", 55, start - dt.timedelta(hours=2), start, start + dt.timedelta(hours=los), float(los), label)
        )
    return rows


@pytest.fixture
def frames(spark):
    def make(cohort_specs, vitals=(), labs=()):
        c = spark.createDataFrame(cohort_rows(cohort_specs), COHORT_SCHEMA)
        v = spark.createDataFrame(list(vitals), VITALS_SCHEMA)
        lab = spark.createDataFrame(list(labs), LABS_SCHEMA)
        labels = c.select("stay_id", "sepsis_label")
        return c, v, lab, labels

    return make
