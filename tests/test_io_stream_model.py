"""Sources, sinks, the streaming Bronze restart, malformed messages, the
model round trip and the driver contract."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from stayframe.config import CLINICAL
from stayframe.operators.aggregates import silver_windows
from stayframe.operators.filters import range_drop_report
from stayframe.session import scratch_path
from stayframe.sources.events import EVENT_SCHEMA, parse_events, to_event_json
from stayframe.streaming.bronze import ingest


def test_malformed_json_kept_flagged_and_absent_from_silver(spark):
    raw = spark.createDataFrame(
        [
            ('{"stay_id": 1, "charttime": "2020-01-01T01:00:00", "itemid": 220045, "valuenum": 80.0, "event_type": "vital"}',),
            ("not json",),
            ('{"stay_id": 1, "charttime": "2020-01-01T02:00:00", "itemid": 220045, "valuenum": NaN, "event_type": "vital"}',),
        ],
        "value string",
    )
    p = parse_events(raw, EVENT_SCHEMA)
    rows = p.collect()
    assert [r.is_malformed for r in rows] == [False, True, False]
    assert rows[1]._raw == "not json" and rows[2].valuenum is None
    stays = spark.createDataFrame([(1, 100, "2020-01-01 00:00:00")], "stay_id long, hadm_id long, t string").select(
        "stay_id", "hadm_id", F.col("t").cast("timestamp_ntz").alias("intime")
    )
    v = p.where(~F.col("is_malformed")).withColumn("charttime", F.col("charttime").cast("timestamp_ntz"))
    s = silver_windows(v, stays, CLINICAL).collect()
    assert len(s) == 1 and s[0].vital_220045_mean == 80.0


def test_stream_restart_appends_only_new_files(spark):
    root = scratch_path(spark, "test-stream")
    msgs = to_event_json(
        spark.createDataFrame([(1, "2020-01-01 01:00:00", 220045, 80.0)], "stay_id long, t string, itemid int, valuenum double")
        .withColumn("charttime", F.col("t").cast("timestamp_ntz")),
        "vital",
    )
    msgs.select("value").write.mode("overwrite").text(f"{root}/landing/a")
    q = ingest(spark, f"{root}/landing/*", f"{root}/bronze", f"{root}/chk")
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 1
    msgs.select("value").union(msgs.select("value")).write.mode("overwrite").text(f"{root}/landing/b")
    q = ingest(spark, f"{root}/landing/*", f"{root}/bronze", f"{root}/chk")
    q.awaitTermination()
    b = spark.read.parquet(f"{root}/bronze")
    assert b.count() == 3
    assert "ingestion_timestamp" in b.columns


def test_range_report_counts(spark):
    df = spark.createDataFrame(
        [(220045, 10.0), (220045, 80.0), (220045, 400.0), (999, 1.0)], "itemid int, valuenum double"
    )
    r = {x.item: (x.n_before, x.n_kept) for x in range_drop_report(df, {220045: (20.0, 300.0)}).collect()}
    assert r == {"220045": (3, 1), "total": (4, 1)}


def test_partitioned_sink_and_read_back(spark):
    from stayframe.plans.mappings import events_inputs
    from stayframe.sources.sinks import verify_written, write_table

    x = events_inputs(spark, "/root/testdata/sf0.001")
    s = silver_windows(x.vitals, x.stays, x.cfg)
    path = scratch_path(spark, "test-silver")
    write_table(s, path, partition_by="window_date")
    assert os.path.isdir(path.replace("file:", "")) or path.startswith("hdfs")
    v = verify_written(spark, path, expected_columns=s.columns).collect()[0]
    assert v.n_rows == s.count() and v.columns_ok


def test_driver_contract_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    from stayframe.plans.mappings import EVENTS_CFG

    assert set(E.oracle_sql()) <= set(E.queries())
    assert df.columns == EVENTS_CFG.gold_columns()


def test_half_bad_messages_are_flagged(spark):
    good = '{"stay_id": 1, "charttime": "2020-01-01T01:00:00", "itemid": 220045, "valuenum": 80.0, "event_type": "vital"}'
    raw = spark.createDataFrame(
        [(good,), (good.replace("220045", '"abc"'),), (good.replace("80.0", '"x"'),), (good.replace(', "itemid": 220045', ""),), ("{}",), (None,)],
        "value string",
    )
    assert [r.is_malformed for r in parse_events(raw, EVENT_SCHEMA).collect()] == [False, True, True, False, True, True]


def test_model_roundtrip_scores_identically(spark):
    import random

    from stayframe.operators.scoring import TreeSettings, importances, load_model, save_model, score, train
    from stayframe.session import remove_scratch

    rng = random.Random(1)
    rows = [(i, float(i % 7) if i % 5 else None, rng.random(), int(i % 7 > 3), "train" if i < 240 else "test", 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, sepsis_label int, split string, weight double")
    model = train(df, ["a", "b"], TreeSettings(max_iter=7, max_depth=3))
    assert model.stages[-1].getNumTrees == 7  # every round is trained
    path = scratch_path(spark, "test-model")
    save_model(model, ["a", "b"], path)
    loaded, names = load_model(spark, path)
    assert names == ["a", "b"] and importances(model, names).first().feature == "a"
    a = {r.id: r.sepsis_prob for r in score(df, model).collect()}
    b = {r.id: r.sepsis_prob for r in score(df, loaded).collect()}
    assert a == b and all(0.0 <= v <= 1.0 for v in a.values())
    remove_scratch(spark, path)
