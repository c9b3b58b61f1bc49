"""Registered queries: profiling (AGG7-AGG12, AGG14), cohort and labels
(COH1, COH2), sources and sinks (SRC1-SRC8, SNK1-SNK5), streaming Bronze and
the model (MDL2-MDL6, SCR1).

Queries that write (sinks, streaming, model) use fresh folders under the
shared ``spark.checkpoint.dir``; their SQL twin checks what is read back.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stayframe.config import ADMISSION, INTIME, ITEM, LABEL, STAY, TIME, VALUE
from stayframe.functions import flag
from stayframe.operators.cohort import build_cohort, label_by_code
from stayframe.operators.profile import (
    cohort_summary,
    density,
    describe_by,
    histogram,
    item_profile,
    merged_quantiles,
    quantile_sketches,
    SKETCH_ERROR,
    rate_by,
    value_counts,
)
from stayframe.operators.scoring import (
    V1_SETTINGS,
    V3_SETTINGS,
    alert,
    check_predictions,
    importances,
    load_model,
    save_model,
    score,
    train_with_history,
)
from stayframe.operators.splits import temporal_split, with_class_weight
from stayframe.operators.subgroups import format_report, subgroup_report
from stayframe.operators.aggregates import silver_windows
from stayframe.operators.joins import attach_patients, labs_for_stays
from stayframe.operators.metrics import at_threshold, ranking_metrics, youden_threshold
from stayframe.operators.ordering import union_parts, with_scalars
from stayframe.operators.temporal import assemble_v3
from stayframe.operators.windows import calendar_parts
from stayframe.plans import oracle as Q
from stayframe.plans.catalog import REGISTRY, gold_doubles, inputs, register, silver_doubles
from stayframe.plans.mappings import EVENTS_CFG, LINEITEM_CFG, SCORE_SCALE, rule_score, table
from stayframe.plans.medallion import bronze_readings, gold_from_silver, gold_table
from stayframe.plans.queries_eval import TEMPORAL_CUTS, THRESHOLD, _score_sql, scored_gold
from stayframe.plans.queries_features import _iso_sql
from stayframe.session import remove_scratch, scratch_path
from stayframe.sources.events import EVENT_SCHEMA, parse_events, to_event_json
from stayframe.sources.sinks import verify_written, write_report_csv, write_table
from stayframe.sources.tables import land_measurements, read_csv, read_table
from stayframe.streaming.bronze import event_schema, ingest
from stayframe.streaming.silver import start_silver


def sround(expr: str, digits: int) -> str:
    """SQL rounding that agrees with Spark's at decimal ties."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def _taken(spark, df, path):
    """What was read back from a scratch folder, pinned by a checkpoint (which
    Spark removes with its last reference); the folder goes at once."""
    pinned = df.checkpoint()
    remove_scratch(spark, path)
    return pinned


# AGG7 / AGG8 / AGG9 / AGG10 / AGG11 / AGG12 / AGG14 ----------------------------
def _agg7(spark, sf_dir):
    return value_counts(inputs(spark, sf_dir, "lineitem").vitals, ITEM)


register(
    "AGG7_value_counts_lineitem",
    Q.with_mapping("lineitem", "SELECT itemid, count(*) AS n FROM vitals GROUP BY itemid", pipeline=False),
)(_agg7)


def _cohort_a(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    return build_cohort(x.stays, x.patients, x.labels), x


def _agg8(spark, sf_dir):
    c, _ = _cohort_a(spark, sf_dir)
    return rate_by(calendar_parts(c, INTIME), "admit_hour", LABEL)


_COHORT_A_SQL = """
cohort AS (
  SELECT s.*, datediff('microsecond', s.intime, s.outtime) / 3600000000.0 AS los_icu_hours, p.anchor_age,
         CAST(coalesce(l.sepsis_label, 0) AS INTEGER) AS sepsis_label
  FROM stays s LEFT JOIN patients p ON s.subject_id = p.subject_id LEFT JOIN labels l ON s.stay_id = l.stay_id)"""

register(
    "AGG8_rate_by_events",
    Q.with_mapping(
        "events",
        "SELECT CAST(hour(intime) AS INTEGER) AS admit_hour, count(*) AS n, avg(sepsis_label) * 100.0 AS rate_pct "
        "FROM cohort GROUP BY 1",
        _COHORT_A_SQL,
        pipeline=False,
    ),
    ["rate_pct"],
)(_agg8)


def _agg9(spark, sf_dir):
    return describe_by(inputs(spark, sf_dir, "lineitem").vitals, VALUE, ITEM)


register(
    "AGG9_describe_by_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT itemid, CAST(count(valuenum) AS DOUBLE) AS count, {sround('avg(valuenum)', 1)} AS mean,
       {sround('stddev_samp(valuenum)', 1)} AS std, {sround('min(valuenum)', 1)} AS min,
       {sround('quantile_cont(valuenum, 0.25)', 1)} AS p25, {sround('quantile_cont(valuenum, 0.5)', 1)} AS p50,
       {sround('quantile_cont(valuenum, 0.75)', 1)} AS p75, {sround('max(valuenum)', 1)} AS max
FROM vitals WHERE valuenum IS NOT NULL GROUP BY itemid""",
        pipeline=False,
    ),
    ["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
)(_agg9)


def _agg10(spark, sf_dir):
    c, _ = _cohort_a(spark, sf_dir)
    return cohort_summary(c)


register(
    "AGG10_cohort_summary_events",
    Q.with_mapping(
        "events",
        """SELECT count(*) AS n_stays, count(DISTINCT subject_id) AS n_subjects,
       count(*) FILTER (WHERE sepsis_label = 1) AS n_positive, avg(sepsis_label) AS positive_rate,
       min(anchor_age) AS min_age, max(anchor_age) AS max_age,
       quantile_cont(anchor_age, 0.5) AS median_age, quantile_cont(los_icu_hours, 0.5) AS median_los_hours
FROM cohort""",
        _COHORT_A_SQL,
        pipeline=False,
    ),
    ["positive_rate", "min_age", "max_age", "median_age", "median_los_hours"],
)(_agg10)


def _agg11(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    v = x.vitals.join(x.labels, STAY, "inner")
    return histogram(v, VALUE, 50, clip_upper=80000.0, by=[LABEL])


register(
    "AGG11_histogram_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT sepsis_label, bin, lo + bin * ((hi - lo) / 50.0) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 50.0) AS bin_hi,
       count(*) AS n
FROM (
  SELECT sepsis_label, lo, hi,
         CAST(CASE WHEN (hi - lo) / 50.0 > 0 THEN least(floor((x - lo) / ((hi - lo) / 50.0)), 49) ELSE 0 END AS INTEGER) AS bin
  FROM (SELECT lb.sepsis_label, least(CAST(v.valuenum AS DOUBLE), 80000.0) AS x
        FROM vitals v JOIN labels lb ON v.stay_id = lb.stay_id) t
  CROSS JOIN (SELECT min(least(CAST(v.valuenum AS DOUBLE), 80000.0)) AS lo, max(least(CAST(v.valuenum AS DOUBLE), 80000.0)) AS hi
              FROM vitals v JOIN labels lb ON v.stay_id = lb.stay_id) r
  WHERE x IS NOT NULL) b
GROUP BY sepsis_label, bin, lo, hi""",
        pipeline=False,
    ),
    ["bin_lo", "bin_hi"],
)(_agg11)


def _agg12(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    return density(x.vitals, VALUE, [ITEM], GRID_POINTS)


# Points of a density grid, as published.
GRID_POINTS = 1000
register(
    "AGG12_density_events",
    Q.with_mapping(
        "events",
        f"""SELECT p.itemid, p.grid_index, p.x,
       sum(c.k * exp(-0.5 * power((p.x - c.v) / p.bw, 2))) * {1.0 / math.sqrt(2 * math.pi)!r} / (max(p.n) * max(p.bw)) AS density
FROM points p JOIN counts c USING (itemid) GROUP BY p.itemid, p.grid_index, p.x""",
        f"""
counts AS (
  SELECT itemid, CAST(valuenum AS DOUBLE) AS v, CAST(count(*) AS DOUBLE) AS k FROM vitals
  WHERE valuenum IS NOT NULL AND NOT isnan(valuenum) GROUP BY 1, 2),
stats AS (
  SELECT itemid, count(*) AS n, min(valuenum) AS lo, max(valuenum) AS hi,
         stddev_samp(valuenum) * power(count(*), -0.2) AS bw
  FROM vitals WHERE valuenum IS NOT NULL AND NOT isnan(valuenum) GROUP BY itemid),
points AS (
  SELECT itemid, n, bw, CAST(g AS INTEGER) AS grid_index,
         lo - (hi - lo) / 2.0 + 2.0 * (hi - lo) / {float(GRID_POINTS - 1)} * g AS x
  FROM stats, range({GRID_POINTS}) r(g))""",
        pipeline=False,
    ),
    ["x", "density"],
)(_agg12)



def _agg14(spark, sf_dir):
    return item_profile(inputs(spark, sf_dir, "lineitem").vitals)


register(
    "AGG14_item_profile_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT itemid, count(*) AS n_rows, min(charttime) AS first_time, max(charttime) AS last_time,
       count(*) OVER () AS n_items
FROM vitals GROUP BY itemid""",
        pipeline=False,
    ),
)(_agg14)


# COH1 / COH2 -------------------------------------------------------------------
def _coh1(spark, sf_dir):
    c, _ = _cohort_a(spark, sf_dir)
    return c


register(
    "COH1_cohort_events",
    Q.with_mapping("events", "SELECT * FROM cohort", _COHORT_A_SQL, pipeline=False),
    ["los_icu_hours", "anchor_age"],
)(_coh1)


def _coh2(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_custkey", "o_orderpriority"])
    version = F.when(F.col("o_custkey") % 2 == 0, 10).otherwise(9)
    diag = o.select(F.col("o_custkey").alias(ADMISSION), F.col("o_orderpriority").alias("icd_code"), version.alias("icd_version"))
    adm = table(spark, sf_dir, "customer", ["c_custkey"]).select(F.col("c_custkey").alias(ADMISSION))
    return label_by_code(diag, adm, {10: ("1-", "2-"), 9: ("3-",)})


register(
    "COH2_label_by_code_orders",
    """SELECT c.c_custkey AS hadm_id,
       CAST(CASE WHEN c.c_custkey IN (
              SELECT o_custkey FROM orders
              WHERE CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%'
                         ELSE o_orderpriority LIKE '3-%' END)
                 THEN 1 ELSE 0 END AS INTEGER) AS sepsis_label
FROM customer c""",
)(_coh2)


# SRC / SNK ---------------------------------------------------------------------
def _src58(spark, sf_dir):
    li = read_table(spark, f"{sf_dir}/lineitem.parquet", columns=["l_orderkey", "l_shipdate", "l_extendedprice", "l_returnflag"])
    return li.where(F.col("l_returnflag") == "R")


register(
    "SRC5_SRC8_pruned_scan_lineitem",
    "SELECT l_orderkey, l_shipdate, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag = 'R'",
    ["l_extendedprice"],
)(_src58)


def _src6(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "csv-events")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    writer = ev.write.option("header", "true").option("compression", "gzip").option("timestampNTZFormat", fmt)
    writer.csv(path)  # .csv.gz files
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return _taken(spark, read_csv(spark, path, schema, timestamp_ntz_format=fmt), path)


register("SRC6_csv_roundtrip_events", "SELECT * FROM events", ["value"])(_src6)


def _src7(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    keep = x.labels.where(F.col(LABEL) == 1)
    path = scratch_path(spark, "landed")
    return _taken(spark, land_measurements(x.vitals, keep, x.cfg.vital_items, path), path)


register(
    "SRC7_land_measurements_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT * FROM vitals WHERE itemid IN ({Q.in_list(LINEITEM_CFG.vital_items)}) AND valuenum IS NOT NULL
  AND stay_id IN (SELECT stay_id FROM labels WHERE sepsis_label = 1)""",
        pipeline=False,
    ),
    ["valuenum"],
)(_src7)


def _lab_events(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate", "l_linenumber", "l_extendedprice"])
    return li.select(
        F.col("l_orderkey").alias(STAY),
        F.col("l_shipdate").alias(TIME),
        F.col("l_linenumber").alias(ITEM),
        F.col("l_extendedprice").alias(VALUE),
    )


def _src2(spark, sf_dir):
    msgs = to_event_json(_lab_events(spark, sf_dir), "lab")
    return parse_events(msgs, EVENT_SCHEMA, keep_raw=False)


register(
    "SRC2_json_roundtrip_lineitem",
    f"""SELECT l_orderkey AS stay_id, {_iso_sql('l_shipdate')} AS charttime, l_linenumber AS itemid,
       l_extendedprice AS valuenum, 'lab' AS event_type, false AS is_malformed FROM lineitem""",
    ["valuenum"],
)(_src2)


def _snk4(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")
    return to_event_json(x.vitals, "vital")


register(
    "SNK4_event_json_events",
    Q.with_mapping(
        "events",
        f"""SELECT CAST(stay_id AS VARCHAR) AS key,
       '{{"stay_id":' || stay_id || ',"charttime":"' || {_iso_sql('charttime')} || '","itemid":"' || itemid
       || '","valuenum":' || CAST(valuenum AS VARCHAR) || ',"event_type":"vital"}}' AS value
FROM vitals""",
        pipeline=False,
    ),
)(_snk4)


def _snk1(spark, sf_dir):
    x = inputs(spark, sf_dir, "events")

    path = scratch_path(spark, "silver")
    write_table(silver_windows(x.vitals, x.stays, x.cfg), path, partition_by="window_date")
    return _taken(spark, spark.read.parquet(path), path)


register(
    "SNK1_partitioned_write_events",
    REGISTRY["AGG1_silver_events"].sql,
    silver_doubles(EVENTS_CFG),
    ["window_date"],
)(_snk1)


def _snk2(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "gold")
    write_table(gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg), path)
    return _taken(spark, spark.read.parquet(path), path)


register("SNK2_write_read_lineitem", REGISTRY["GOLD_lineitem"].sql, gold_doubles(LINEITEM_CFG))(_snk2)


# The published report: eight columns, rates as text.
REPORT_COLUMNS = ["Subgroup", "n_windows", "sepsis_rate", "AUROC", "AUPRC", f"Recall@{THRESHOLD}", f"Precision@{THRESHOLD}", "Alert_rate"]
REPORT_SCHEMA = ", ".join(f"`{c}` {'long' if c == 'n_windows' else 'string'}" for c in REPORT_COLUMNS)


def _published(spark, report):
    """A subgroup report written in its published form and read back."""
    path = scratch_path(spark, "report")
    write_report_csv(format_report(report, THRESHOLD), path)
    return _taken(spark, read_csv(spark, path, REPORT_SCHEMA), path)


def published_sql(report_sql: str) -> str:
    pct = lambda c: f"format('{{:.1f}}%', {sround(f'{c} * 100.0', 1)})"
    three = lambda c: f"format('{{:.3f}}', {sround(c, 3)})"
    return f"""SELECT subgroup AS "Subgroup", n_windows, {pct('sepsis_rate')} AS sepsis_rate,
       {three('auroc')} AS "AUROC", {three('auprc')} AS "AUPRC", {pct('recall')} AS "Recall@{THRESHOLD}",
       {pct('precision')} AS "Precision@{THRESHOLD}", {pct('alert_rate')} AS "Alert_rate"
FROM ({report_sql}) report"""


def _snk3(spark, sf_dir):
    p, x = scored_gold(spark, sf_dir, "lineitem")
    return _published(spark, subgroup_report(attach_patients(p, x.stays, x.patients), THRESHOLD))


register("SNK3_report_csv_lineitem", published_sql(REGISTRY["SUB1_subgroup_report_lineitem"].sql))(_snk3)


def _gold_types(cfg):
    kinds = {c: "int" if c.endswith("_missing") or c in ("time_of_day", LABEL) else "double" for c in cfg.gold_columns()}
    return {**kinds, STAY: "bigint", "window_end": "timestamp_ntz"}


def _snk5(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "gold-check")
    write_table(gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg), path)
    checked = verify_written(spark, path, expected_columns=x.cfg.gold_columns(), expected_types=_gold_types(x.cfg), label=LABEL)
    return _taken(spark, checked, path)


register(
    "SNK5_verify_written_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT count(*) AS n_rows, {len(LINEITEM_CFG.gold_columns())} AS n_columns, true AS columns_ok, true AS types_ok,
       count(*) FILTER (WHERE sepsis_label = 0) AS n_label_0, count(*) FILTER (WHERE sepsis_label = 1) AS n_label_1,
       count(*) FILTER (WHERE sepsis_label IS NULL) AS n_label_null FROM gold""",
    ),
)(_snk5)


# Streaming Bronze (SRC1, SRC3, SRC4) --------------------------------------------
def _bronze(spark, x, root):
    """Event messages of a mapping land as text files, labs resolved to stays
    first; the stream ingests them to Bronze with an ``availableNow`` trigger."""
    labs = labs_for_stays(x.labs, x.stays, x.stays)
    msgs = to_event_json(x.vitals, "vital").unionByName(to_event_json(labs, "lab"))
    msgs.select("value").write.text(f"{root}/landing")
    q = ingest(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", schema=event_schema(StringType()))
    q.awaitTermination()
    return spark.read.parquet(f"{root}/bronze").withColumn("is_stamped", F.col("ingestion_timestamp").isNotNull())


def _bronze_rows(spark, sf_dir):
    root = scratch_path(spark, "bronze-run")
    rows = _bronze(spark, inputs(spark, sf_dir, "events"), root)
    return _taken(spark, rows.select(STAY, TIME, ITEM, VALUE, "event_type", "is_malformed", "is_stamped"), root)


_BRONZE_SQL = f"""SELECT stay_id, {_iso_sql('charttime')} AS charttime, itemid, valuenum, 'vital' AS event_type,
       false AS is_malformed, true AS is_stamped
FROM vitals
UNION ALL
SELECT s.stay_id, {_iso_sql('l.charttime')}, l.itemid, l.valuenum, 'lab', false, true
FROM labs l JOIN stays s ON l.hadm_id = s.hadm_id"""
for _name in ("SRC1_SRC3_stream_decode_events", "SRC4_bronze_stream_events"):
    register(_name, Q.with_mapping("events", _BRONZE_SQL, pipeline=False), ["valuenum"])(_bronze_rows)


def _medallion(spark, sf_dir):
    """Landed messages to stored Bronze, stored Silver by date, and Gold of what was stored."""
    x = inputs(spark, sf_dir, "events")
    root = scratch_path(spark, "medallion")
    bronze = _bronze(spark, x, root)
    silver_path = f"{root}/silver"
    write_table(silver_windows(bronze_readings(bronze, "vital"), x.stays, x.cfg), silver_path, partition_by="window_date")
    silver = spark.read.parquet(silver_path)
    gold = gold_from_silver(silver, bronze_readings(bronze, "lab"), x.stays, x.labels, x.cfg)
    return _taken(spark, gold, root)


register("MEDALLION_bronze_silver_gold_events", REGISTRY["GOLD_events"].sql, gold_doubles(EVENTS_CFG))(_medallion)


def _kept_up(spark, sf_dir):
    """Silver kept up by batches: messages land in two waves, the second of
    which holds rows that come late; each wave is ingested to Bronze and folded
    into Silver by a stream that starts again."""
    x = inputs(spark, sf_dir, "events")
    root = scratch_path(spark, "silver-run")
    messages = to_event_json(x.vitals, "vital").select("value")
    for wave in range(2):
        messages.where(F.pmod(F.xxhash64("value"), F.lit(2)) == wave).write.mode("append").text(f"{root}/landing")
        ingest(spark, f"{root}/landing", f"{root}/bronze", f"{root}/bronze-checkpoint", schema=event_schema(StringType())).awaitTermination()
        start_silver(spark, f"{root}/bronze", x.stays, x.cfg, f"{root}/kept", f"{root}/silver-checkpoint").awaitTermination()
    silver = spark.read.parquet(f"{root}/kept/silver")
    return _taken(spark, silver.select(STAY, "window_id", "window_end", *x.cfg.vital_columns(), "window_date"), root)


register("AGG1_SRC4_incremental_silver_events", REGISTRY["AGG1_silver_events"].sql, silver_doubles(EVENTS_CFG), ["window_date"])(_kept_up)


def _predictions(spark, sf_dir):
    """The predictions job: stored Gold, score, alert and stamp, checks, sink, read back."""
    x = inputs(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "predictions")
    write_table(gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg), f"{root}/gold")
    gold = spark.read.parquet(f"{root}/gold")
    scored = alert(rule_score(gold, x.cfg, SCORE_SCALE["lineitem"]), THRESHOLD)
    write_table(scored.withColumn("sepsis_prob", F.round("sepsis_prob", 6)), f"{root}/predictions")
    stored = spark.read.parquet(f"{root}/predictions")
    checks = check_predictions(stored, gold.groupBy().count()).select("row_count_ok", "prob_range_ok", "alert_values_ok")
    out = with_scalars(stored, checks).withColumn("is_stamped", F.col("predicted_at").isNotNull())
    return _taken(spark, out.select(STAY, "window_end", LABEL, "sepsis_prob", "sepsis_alert", "is_stamped", "row_count_ok", "prob_range_ok", "alert_values_ok"), root)


register(
    "PREDICTIONS_job_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT stay_id, window_end, sepsis_label, round(sepsis_prob, 6) AS sepsis_prob, sepsis_alert, true AS is_stamped,
       true AS row_count_ok, true AS prob_range_ok, true AS alert_values_ok FROM pred""",
        _score_sql("lineitem"),
    ),
    ["sepsis_prob"],
)(_predictions)


def _sketched(spark, sf_dir):
    """Quantiles of each item from stored sketches per item and day, and
    whether each one's rank among all values is where it should be."""
    x = inputs(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "sketches")
    quantile_sketches(x.vitals.withColumn("day", F.to_date(TIME)), VALUE, [ITEM, "day"]).write.parquet(path)
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = merged_quantiles(spark.read.parquet(path), list(probs.values()), [ITEM], list(probs))
    value = F.col(VALUE).cast("double")
    rows = x.vitals.where(F.col(VALUE).isNotNull()).join(found, ITEM)
    ranks = rows.groupBy(ITEM, "n").agg(
        *[((F.count_if(value <= F.col(c)) >= (p - SKETCH_ERROR) * F.col("n")) & (F.count_if(value < F.col(c)) <= (p + SKETCH_ERROR) * F.col("n"))).alias(f"{c}_ok") for c, p in probs.items()]
    )
    return _taken(spark, ranks, path)


register(
    "AGG9_quantile_sketches_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT itemid, count(valuenum) AS n, true AS p25_ok, true AS p50_ok, true AS p75_ok FROM vitals WHERE valuenum IS NOT NULL GROUP BY itemid",
        pipeline=False,
    ),
)(_sketched)


# Model (MDL2-MDL6, SCR1) ---------------------------------------------------------
def _training_frame(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    g = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    features = assemble_v3(g, x.cfg).checkpoint()  # read again by the ranks, the split and every round of training
    return with_class_weight(temporal_split(features)).checkpoint(), x.cfg.v3_feature_columns()


def _model_rows(spark, sf_dir, settings):
    """Train with the full settings, save model and training frame, and run the
    scoring job on what is stored: reload the model, score every row, alert and
    stamp, write, read back and check.  States what must hold of the model, of
    the round kept, of the importances and of the written predictions."""
    f, cols = _training_frame(spark, sf_dir)
    model, history = train_with_history(f, cols, settings)
    n_trees, values = model.stages[-1].getNumTrees, [r[settings.metric] for r in history]
    upto = n_trees + settings.patience if len(values) >= n_trees + settings.patience else len(values)
    stop_ok = n_trees <= settings.max_iter and (not values or values.index(max(values[:upto])) == n_trees - 1)
    root = scratch_path(spark, "model")
    save_model(model, cols, root)
    write_table(f, f"{root}/gold")
    gold = spark.read.parquet(f"{root}/gold")
    loaded, names = load_model(spark, root)
    both = alert(score(score(gold, model, "prob_trained"), loaded), THRESHOLD)
    write_table(both.select(STAY, "window_end", "split", LABEL, "sepsis_prob", "sepsis_alert", "predicted_at", "prob_trained"), f"{root}/predictions")
    stored = spark.read.parquet(f"{root}/predictions")
    checks = check_predictions(stored, gold.groupBy().count()).select("row_count_ok", "prob_range_ok", "alert_values_ok")
    top = importances(model, cols, 15).withColumn("at", F.monotonically_increasing_id())
    known = F.count_if(F.col("feature").isin(cols)) == 15
    top = top.agg(
        (known & (F.count_distinct("feature") == 15)).alias("top_known"),
        (F.array_sort(F.collect_list(F.struct("at", "importance")))["importance"] == F.sort_array(F.collect_list("importance"), asc=False)).alias("top_ordered"),
    )
    rows = with_scalars(with_scalars(stored, top), checks).select(
        STAY,
        "window_end",
        "split",
        LABEL,
        F.col("sepsis_prob").between(0.0, 1.0).alias("prob_ok"),
        (F.col("sepsis_alert") == (F.col("sepsis_prob") >= THRESHOLD).cast("int")).alias("alert_ok"),
        F.col("predicted_at").isNotNull().alias("is_stamped"),
        (F.col("sepsis_prob") == F.col("prob_trained")).alias("reload_ok"),
        F.lit(names == cols).alias("contract_ok"),
        F.lit(stop_ok).alias("stop_ok"),
        "top_known",
        "top_ordered",
        "row_count_ok",
        "prob_range_ok",
        "alert_values_ok",
    )
    return _taken(spark, rows, root)


for _version, _settings in (("MDL2_MDL4_MDL5_MDL6_v1", V1_SETTINGS), ("MDL3_MDL4_MDL5_MDL6_v3", V3_SETTINGS)):
    register(
        f"{_version}_lineitem",
        Q.with_mapping(
            "lineitem",
            """SELECT stay_id, window_end, split, sepsis_label, true AS prob_ok, true AS alert_ok, true AS is_stamped, true AS reload_ok,
       true AS contract_ok, true AS stop_ok, true AS top_known, true AS top_ordered, true AS row_count_ok, true AS prob_range_ok,
       true AS alert_values_ok FROM sp""",
            TEMPORAL_CUTS,
        ),
    )(lambda spark, sf_dir, s=_settings: _model_rows(spark, sf_dir, s))


def _trained_report(spark, sf_dir):
    """Held-out evaluation of the trained v3 model: rounds kept, validation and
    test ranking metrics, the Youden threshold of the test curve and the recall
    there, and the recall on the test rows at the validation rows' threshold."""
    f, cols = _training_frame(spark, sf_dir)
    model, history = train_with_history(f, cols, V3_SETTINGS)
    rows = score(f, model).select("split", LABEL, "sepsis_prob").checkpoint()
    test = rows.where(F.col("split") == "test")
    ranks = ranking_metrics(rows, "sepsis_prob", LABEL, ["split"]).where(F.col("split").isin("val", "test"))
    parts = [
        ranks.selectExpr("stack(2, concat(split, '_auroc'), auroc, concat(split, '_auprc'), auprc) AS (metric, value)"),
        spark.range(1).select(F.lit("rounds").alias("metric"), F.lit(float(model.stages[-1].getNumTrees)).alias("value")),
    ]
    for name, chosen in (("test", test), ("val", rows.where(F.col("split") == "val"))):
        at = youden_threshold(chosen, "sepsis_prob", LABEL)
        alerted = with_scalars(test, at).withColumn("sepsis_alert", flag(F.col("sepsis_prob") >= F.col("threshold")))
        seen = with_scalars(at_threshold(alerted, None, "sepsis_prob", LABEL, alert="sepsis_alert"), at)
        parts.append(seen.selectExpr(f"stack(3, '{name}_threshold', threshold, 'test_recall_at_{name}_threshold', recall, 'test_precision_at_{name}_threshold', precision) AS (metric, value)"))
    return union_parts(*parts)


# What the trees score can't be said in SQL: rows only, tests/test_boosting.py has the brute force.
register("MDL3_EVL2_EVL4_trained_report_lineitem")(_trained_report)
