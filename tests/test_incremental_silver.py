"""Silver kept up by batches equals a rebuild, after late rows and restarts."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stayframe.config import CLINICAL
from stayframe.operators.aggregates import silver_windows
from stayframe.plans.medallion import bronze_readings
from stayframe.streaming.silver import compact, fold_batch, start_silver

T0 = dt.datetime(2020, 1, 1)
ITEMS = CLINICAL.vital_items


@pytest.fixture()
def world(spark, tmp_path):
    stays = spark.createDataFrame([(s, T0 + dt.timedelta(hours=s)) for s in range(4)], "stay_id long, intime timestamp_ntz")

    def event(n, day):
        t = T0 + dt.timedelta(days=day, minutes=37 * (n % 40))
        return (n % 4, t.strftime("%Y-%m-%dT%H:%M:%S"), int(ITEMS[n % len(ITEMS)]), 60.0 + n * 0.37 % 11, "vital", n % 23 == 0)

    def rows(*numbers_and_days):
        return spark.createDataFrame([event(n, d) for n, d in numbers_and_days], "stay_id long, charttime string, itemid int, valuenum double, event_type string, is_malformed boolean")

    return stays, rows, str(tmp_path)


def same(kept, bronze, stays):
    want = silver_windows(bronze_readings(bronze, "vital"), stays, CLINICAL)
    form = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*want.columns).collect())
    assert form(kept) == form(want) and want.count() > 0


def test_late_rows_a_replay_and_untouched_dates(spark, world):
    stays, rows, root = world
    batches = [rows(*[(n, n % 5) for n in range(300)]), rows(*[(n, 2) for n in range(300, 420)]), rows((7, 0), (23, 1))]
    fold_batch(batches[0], 0, stays, CLINICAL, root)
    untouched = {f: os.stat(f"{root}/silver/{f}").st_mtime_ns for f in os.listdir(f"{root}/silver") if f.startswith("window_date=2020-01-05")}
    dates = fold_batch(batches[1], 1, stays, CLINICAL, root)
    assert untouched and dt.date(2020, 1, 5) not in dates
    assert all(os.stat(f"{root}/silver/{f}").st_mtime_ns == at for f, at in untouched.items())
    fold_batch(batches[1], 1, stays, CLINICAL, root)  # the batch runs again
    fold_batch(batches[2], 2, stays, CLINICAL, root)
    whole = batches[0].union(batches[1]).union(batches[2])
    same(spark.read.parquet(f"{root}/silver"), whole, stays)
    # folded states go on taking batches, the last of the old ones included
    new = compact(spark, root, f"{root}/new", CLINICAL)
    same(spark.read.parquet(f"{new}/silver"), whole, stays)
    fold_batch(batches[2], 2, stays, CLINICAL, new)
    fold_batch(batches[1], 3, stays, CLINICAL, new)
    same(spark.read.parquet(f"{new}/silver"), whole.union(batches[1]), stays)


def test_a_batch_without_readings_changes_nothing(spark, world):
    stays, rows, root = world
    assert fold_batch(rows((0, 0)).where("false"), 0, stays, CLINICAL, root) == []
    fold_batch(rows((1, 1), (2, 1)), 1, stays, CLINICAL, root)
    same(spark.read.parquet(f"{root}/silver"), rows((1, 1), (2, 1)), stays)


def test_the_stream_goes_on_where_it_stopped(spark, world):
    stays, rows, root = world
    bronze = f"{root}/bronze"
    for part in (range(0, 200), range(150, 260)):
        rows(*[(n, n % 3) for n in part]).repartition(3).write.mode("append").parquet(bronze)
        for _ in range(2):  # the second run finds nothing new
            start_silver(spark, bronze, stays, CLINICAL, f"{root}/kept", f"{root}/checkpoint", files_per_batch=2).awaitTermination()
        same(spark.read.parquet(f"{root}/kept/silver"), spark.read.parquet(bronze), stays)
    assert spark.read.parquet(f"{root}/kept/states").select(F.max("batch")).first()[0] >= 3
