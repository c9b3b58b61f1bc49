"""Registered queries for splits, class weights, scoring checks, metrics and
the subgroup report (SPL1-SPL3, MDL1, SCR2, SCR3, EVL1-EVL7, SUB1, JON7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.config import LABEL, STAY
from stayframe.functions import flag
from stayframe.operators.joins import attach_patients
from stayframe.operators.metrics import (
    at_threshold,
    confusion,
    metrics_table,
    ranking_metrics,
    recall_at,
    roc_curve,
    youden_threshold,
)
from stayframe.operators.ordering import with_scalars
from stayframe.operators.scoring import alert, check_predictions
from stayframe.operators.splits import id_split, split_summary, temporal_split, with_class_weight
from stayframe.operators.subgroups import REPORT_ORDER, subgroup_report
from stayframe.plans import oracle as Q
from stayframe.plans.catalog import inputs, register
from stayframe.plans.mappings import SCORE_SCALE, reading_scores, rule_score
from stayframe.plans.medallion import gold_table

THRESHOLD = 0.35


def scored_gold(spark, sf_dir, m):
    """Gold of a mapping with the stand-in score and the alert flag."""
    x = inputs(spark, sf_dir, m)
    g = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg)
    return alert(rule_score(g, x.cfg, SCORE_SCALE[m]), THRESHOLD, stamp=False), x


def _stored_gold(spark, sf_dir, m):
    """Keys and label of Gold, stored once, as splits read their input more than once."""
    g, _ = scored_gold(spark, sf_dir, m)
    return g.select(STAY, "window_end", LABEL).checkpoint()


def _score_sql(m) -> str:
    cfg = Q.MAPPING_CFG[m]
    mean = "coalesce(" + ", ".join(f"vital_{i}_mean" for i in cfg.vital_items) + ", 0.0)"
    return f"""
scored AS (
  SELECT *, floor(1000.0 * {mean} / ({mean} + {SCORE_SCALE[m]})) / 1000.0 AS sepsis_prob FROM gold),
pred AS (
  SELECT *, CAST(CASE WHEN sepsis_prob >= {THRESHOLD} THEN 1 ELSE 0 END AS INTEGER) AS sepsis_alert FROM scored)"""


def _reading_sql(m) -> str:
    return f"""
rs AS (
  SELECT v.stay_id, floor(1000.0 * v.valuenum / (v.valuenum + {SCORE_SCALE[m]})) / 1000.0 AS score, lb.sepsis_label
  FROM vitals v JOIN labels lb ON v.stay_id = lb.stay_id WHERE v.valuenum IS NOT NULL)"""


def _rank_metrics_sql(src: str, score: str, label: str, group: str | None) -> str:
    """AUROC by the mid-rank (Mann-Whitney) formula and AP by sklearn's step
    definition; independent of the histogram form used on the Spark side."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    part_s = f"PARTITION BY {group}, {score}" if group else f"PARTITION BY {score}"
    gb = f"GROUP BY {group}" if group else ""
    return f"""
rk AS (
  SELECT {g}{label} AS y,
         (rank() OVER (w) + rank() OVER (w) + count(*) OVER ({part_s}) - 1) / 2.0 AS midrank
  FROM {src} WINDOW w AS ({part} ORDER BY {score})),
auc AS (
  SELECT {g}count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg,
         sum(midrank) FILTER (WHERE y = 1) AS rsum
  FROM rk {gb}),
hist AS (
  SELECT {g}{score} AS s, count(*) FILTER (WHERE {label} = 1) AS pos, count(*) FILTER (WHERE {label} = 0) AS neg
  FROM {src} {gb}{', ' if group else 'GROUP BY '}{score}),
cum AS (
  SELECT *, sum(pos) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
            sum(neg) OVER ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM hist),
ap AS (SELECT {g}sum(pos * tp / (tp + fp)) AS apsum FROM cum {gb}),
ranking AS (
  SELECT {'a.' + group + ', ' if group else ''}a.n_pos, a.n_neg,
         CASE WHEN a.n_pos > 0 AND a.n_neg > 0
              THEN (a.rsum - a.n_pos * (a.n_pos + 1) / 2.0) / (a.n_pos * a.n_neg) END AS auroc,
         CASE WHEN a.n_pos > 0 AND a.n_neg > 0 THEN p.apsum / a.n_pos END AS auprc
  FROM auc a {'JOIN ap p ON a.' + group + ' = p.' + group if group else 'CROSS JOIN ap p'})"""


for _m in ("events", "lineitem"):

    def _spl1(spark, sf_dir, m=_m):
        return temporal_split(_stored_gold(spark, sf_dir, m))

    register(
        f"SPL1_temporal_split_{_m}",
        Q.with_mapping(
            _m,
            """SELECT g.stay_id, g.window_end, g.sepsis_label, c.split FROM gold g JOIN cuts c ON g.stay_id = c.stay_id""",
            """
firsts AS (SELECT stay_id, min(window_end) AS first_end FROM gold GROUP BY stay_id),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY first_end, stay_id) - 1 AS rnk, count(*) OVER () AS n FROM firsts),
cuts AS (
  SELECT stay_id, CASE WHEN rnk < floor(n * 0.7::DOUBLE) THEN 'train'
                       WHEN rnk < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val'
                       ELSE 'test' END AS split
  FROM ranked)""",
        ),
    )(_spl1)

    def _sub1(spark, sf_dir, m=_m):
        p, x = scored_gold(spark, sf_dir, m)
        p = attach_patients(p, x.stays, x.patients)
        return subgroup_report(p, THRESHOLD)

    order_list = "[" + ", ".join(f"'{s}'" for s in REPORT_ORDER) + "]"
    register(
        f"SUB1_subgroup_report_{_m}",
        Q.with_mapping(
            _m,
            f"""
SELECT t.subgroup, CAST(list_position({order_list}, t.subgroup) AS INTEGER) AS report_order,
       t.n AS n_windows, t.pos / t.n AS sepsis_rate, r.auroc, r.auprc,
       COALESCE(t.recall, 0.0) AS recall, t.precision, t.alert_rate
FROM thr t JOIN ranking r ON t.subgroup = r.subgroup
WHERE t.n >= 100 AND t.pos >= 10""",
            _score_sql(_m)
            + """,
pa AS (
  SELECT p.*, pt.anchor_age FROM pred p LEFT JOIN stays st ON p.stay_id = st.stay_id
  LEFT JOIN patients pt ON st.subject_id = pt.subject_id),
mem AS (
  SELECT 'Overall' AS subgroup, sepsis_prob, sepsis_label, sepsis_alert FROM pa
  UNION ALL
  SELECT CASE WHEN anchor_age > 0 AND anchor_age <= 45 THEN 'Age 18-45'
              WHEN anchor_age > 45 AND anchor_age <= 65 THEN 'Age 45-65'
              WHEN anchor_age > 65 AND anchor_age <= 80 THEN 'Age 65-80'
              WHEN anchor_age > 80 AND anchor_age <= 120 THEN 'Age 80+' END,
         sepsis_prob, sepsis_label, sepsis_alert FROM pa WHERE anchor_age > 0 AND anchor_age <= 120
  UNION ALL
  SELECT CASE WHEN icu_hours_elapsed > -1 AND icu_hours_elapsed <= 24 THEN 'LOS Early (0-24h)'
              WHEN icu_hours_elapsed > 24 AND icu_hours_elapsed <= 72 THEN 'LOS Mid (24-72h)'
              WHEN icu_hours_elapsed > 72 AND icu_hours_elapsed <= 99999 THEN 'LOS Extended (72h+)' END,
         sepsis_prob, sepsis_label, sepsis_alert FROM pa WHERE icu_hours_elapsed > -1 AND icu_hours_elapsed <= 99999
  UNION ALL
  SELECT CASE WHEN time_of_day >= 6 AND time_of_day < 18 THEN 'Shift Day (6am-6pm)' ELSE 'Shift Night (6pm-6am)' END,
         sepsis_prob, sepsis_label, sepsis_alert FROM pa),
thr AS (
  SELECT subgroup, count(*) AS n, count(*) FILTER (WHERE sepsis_label = 1) AS pos,
         avg(sepsis_alert) FILTER (WHERE sepsis_label = 1) AS recall,
         CASE WHEN sum(sepsis_alert) > 0 THEN avg(sepsis_label) FILTER (WHERE sepsis_alert = 1) ELSE 0.0 END AS precision,
         avg(sepsis_alert) AS alert_rate
  FROM mem GROUP BY subgroup),"""
            + _rank_metrics_sql("mem", "sepsis_prob", "sepsis_label", "subgroup"),
        ),
        ["sepsis_rate", "auroc", "auprc", "recall", "precision", "alert_rate"],
    )(_sub1)

    def _evl23(spark, sf_dir, m=_m):
        x = inputs(spark, sf_dir, m)
        return ranking_metrics(reading_scores(x, SCORE_SCALE[m]), "score", LABEL)

    register(
        f"EVL2_EVL3_ranking_{_m}",
        Q.with_mapping(
            _m,
            "SELECT n_pos, n_neg, auroc, auprc FROM ranking",
            _reading_sql(_m) + "," + _rank_metrics_sql("rs", "score", "sepsis_label", None),
            pipeline=False,
        ),
        ["auroc", "auprc"],
    )(_evl23)


def _spl2(spark, sf_dir):
    return id_split(_stored_gold(spark, sf_dir, "lineitem"))


register(
    "SPL2_id_split_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT g.stay_id, g.window_end, g.sepsis_label, c.split FROM gold g JOIN cuts c ON g.stay_id = c.stay_id",
        """
ids AS (SELECT DISTINCT stay_id FROM gold),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY stay_id) - 1 AS rnk, count(*) OVER () AS n FROM ids),
cuts AS (
  SELECT stay_id, CASE WHEN rnk < floor(n * 0.7::DOUBLE) THEN 'train'
                       WHEN rnk < floor(n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM ranked)""",
    ),
)(_spl2)


TEMPORAL_CUTS = """
firsts AS (SELECT stay_id, min(window_end) AS first_end FROM gold GROUP BY stay_id),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY first_end, stay_id) - 1 AS rnk, count(*) OVER () AS n FROM firsts),
cuts AS (
  SELECT stay_id, CASE WHEN rnk < floor(n * 0.7::DOUBLE) THEN 'train'
                       WHEN rnk < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val'
                       ELSE 'test' END AS split
  FROM ranked),
sp AS (SELECT g.*, c.split FROM gold g JOIN cuts c ON g.stay_id = c.stay_id)"""


def _spl3(spark, sf_dir):
    g, _ = scored_gold(spark, sf_dir, "lineitem")
    return split_summary(temporal_split(g))


register(
    "SPL3_split_summary_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT split, count(*) AS n_rows, count(DISTINCT stay_id) AS n_stays,
       count(*) FILTER (WHERE sepsis_label = 1) AS n_positive,
       100.0 * count(*) FILTER (WHERE sepsis_label = 1) / count(*) AS pct_positive
FROM sp GROUP BY split""",
        TEMPORAL_CUTS,
    ),
    ["pct_positive"],
)(_spl3)


def _mdl1(spark, sf_dir):
    return with_class_weight(temporal_split(_stored_gold(spark, sf_dir, "lineitem")))


register(
    "MDL1_class_weight_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT s.stay_id, s.window_end, s.sepsis_label, s.split, w.spw AS scale_pos_weight,
       CASE WHEN s.sepsis_label = 1 THEN w.spw ELSE 1.0 END AS weight
FROM sp s CROSS JOIN w""",
        TEMPORAL_CUTS
        + """,
w AS (
  SELECT COALESCE(CAST(count(*) FILTER (WHERE sepsis_label = 0) AS DOUBLE)
                  / NULLIF(count(*) FILTER (WHERE sepsis_label = 1), 0), 1.0) AS spw
  FROM sp WHERE split = 'train')""",
    ),
    ["scale_pos_weight", "weight"],
)(_mdl1)


def _pred_cols(p):
    return p.select(STAY, "window_end", LABEL, "sepsis_prob", "sepsis_alert")


def _scr2(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return _pred_cols(p)


register(
    "SCR2_alert_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT stay_id, window_end, sepsis_label, sepsis_prob, sepsis_alert FROM pred",
        _score_sql("lineitem"),
    ),
    ["sepsis_prob"],
)(_scr2)


def _scr3(spark, sf_dir):
    x = inputs(spark, sf_dir, "lineitem")
    gold = gold_table(x.vitals, x.labs, x.stays, x.labels, x.cfg).checkpoint()
    scored = alert(rule_score(gold, x.cfg, SCORE_SCALE["lineitem"]), THRESHOLD, stamp=False)
    return check_predictions(scored, gold.groupBy().count())


register(
    "SCR3_prediction_checks_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT count(*) AS n_predictions, (SELECT count(*) FROM gold) AS n_expected,
       count(*) = (SELECT count(*) FROM gold) AS row_count_ok,
       min(sepsis_prob) AS prob_min, max(sepsis_prob) AS prob_max,
       coalesce(bool_and(sepsis_prob BETWEEN 0 AND 1), true) AS prob_range_ok,
       coalesce(bool_and(sepsis_alert IN (0, 1)), true) AS alert_values_ok,
       CAST(count(*) FILTER (WHERE sepsis_alert = 1) AS BIGINT) AS n_alerts,
       avg(sepsis_alert) AS alert_rate,
       coalesce(avg(sepsis_alert) BETWEEN 0.05 AND 0.95, false) AS alert_rate_ok
FROM pred""",
        _score_sql("lineitem"),
    ),
    ["prob_min", "prob_max", "alert_rate"],
)(_scr3)


def _evl1(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return confusion(p, LABEL, "sepsis_alert")


register(
    "EVL1_confusion_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT sepsis_label, sepsis_alert, count(*) AS n FROM pred GROUP BY sepsis_label, sepsis_alert",
        _score_sql("lineitem"),
    ),
)(_evl1)


def _evl4(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return youden_threshold(p, "sepsis_prob", LABEL)


register(
    "EVL4_youden_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT arg_max(threshold, (j, threshold)) AS threshold, max(j) AS youden_j FROM roc""",
        _score_sql("lineitem")
        + """,
h AS (SELECT sepsis_prob AS s, count(*) FILTER (WHERE sepsis_label = 1) AS pos,
             count(*) FILTER (WHERE sepsis_label = 0) AS neg FROM pred GROUP BY sepsis_prob),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM h),
c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM h),
roc AS (
  SELECT 'inf'::DOUBLE AS threshold, 0.0 AS j
  UNION ALL
  SELECT c.s, c.tp / tot.P - c.fp / tot.N FROM c CROSS JOIN tot)""",
    ),
    ["threshold", "youden_j"],
)(_evl4)


def _roc(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return roc_curve(p, "sepsis_prob", LABEL)


register(
    "EVL4_roc_curve_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT 'inf'::DOUBLE AS threshold, 0.0 AS tpr, 0.0 AS fpr
UNION ALL
SELECT c.s, c.tp / tot.P, c.fp / tot.N FROM c CROSS JOIN tot""",
        _score_sql("lineitem")
        + """,
h AS (SELECT sepsis_prob AS s, count(*) FILTER (WHERE sepsis_label = 1) AS pos,
             count(*) FILTER (WHERE sepsis_label = 0) AS neg FROM pred GROUP BY sepsis_prob),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM h),
c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM h)""",
    ),
    ["threshold", "tpr", "fpr"],
)(_roc)


def _roc_thin(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return roc_curve(p, "sepsis_prob", LABEL, thin=True)


register(
    "EVL4_roc_thinned_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT 'inf'::DOUBLE AS threshold, 0.0 AS tpr, 0.0 AS fpr
UNION ALL
SELECT c.s, c.tp / tot.P, c.fp / tot.N FROM c CROSS JOIN tot
WHERE before IS NULL OR after_pos IS NULL OR after_pos <> pos OR after_neg <> neg""",
        _score_sql("lineitem")
        + """,
h AS (SELECT sepsis_prob AS s, count(*) FILTER (WHERE sepsis_label = 1) AS pos,
             count(*) FILTER (WHERE sepsis_label = 0) AS neg FROM pred GROUP BY sepsis_prob),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM h),
c AS (SELECT s, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, lag(s) OVER w AS before,
             lead(pos) OVER w AS after_pos, lead(neg) OVER w AS after_neg FROM h WINDOW w AS (ORDER BY s DESC))""",
    ),
    ["threshold", "tpr", "fpr"],
)(_roc_thin)


def _evl5(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return at_threshold(p, THRESHOLD, "sepsis_prob", LABEL)


_AT_SQL = f"""
atc AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE sepsis_prob >= {THRESHOLD} AND sepsis_label = 1) AS tp,
         count(*) FILTER (WHERE sepsis_prob >= {THRESHOLD} AND sepsis_label <> 1) AS fp,
         count(*) FILTER (WHERE sepsis_prob < {THRESHOLD} AND sepsis_label <> 1) AS tn,
         count(*) FILTER (WHERE sepsis_prob < {THRESHOLD} AND sepsis_label = 1) AS fn
  FROM pred),
atm AS (
  SELECT *, coalesce(tp / NULLIF(tp + fp, 0), 0.0) AS precision,
            coalesce(tp / NULLIF(tp + fn, 0), 0.0) AS recall,
            coalesce(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0.0) AS f1,
            coalesce((tp + fp) / NULLIF(n, 0), 0.0) AS alert_rate
  FROM atc)"""

register(
    "EVL5_at_threshold_lineitem",
    Q.with_mapping("lineitem", "SELECT * FROM atm", _score_sql("lineitem") + "," + _AT_SQL),
    ["precision", "recall", "f1", "alert_rate"],
)(_evl5)


def _evl7(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "events")
    return recall_at(p, THRESHOLD, "sepsis_prob", LABEL)


register(
    "EVL7_recall_events",
    Q.with_mapping(
        "events",
        f"SELECT coalesce(avg(CASE WHEN sepsis_prob >= {THRESHOLD} THEN 1.0 ELSE 0.0 END) FILTER (WHERE sepsis_label = 1), 0.0) AS recall FROM pred",
        _score_sql("events"),
    ),
    ["recall"],
)(_evl7)


def _evl6(spark, sf_dir):
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    return metrics_table(p, THRESHOLD, "sepsis_prob", LABEL)


register(
    "EVL6_metrics_table_lineitem",
    Q.with_mapping(
        "lineitem",
        f"""SELECT metric, value FROM (
  SELECT 'auroc' AS metric, r.auroc AS value, 1 AS o FROM ranking r
  UNION ALL SELECT 'auprc', r.auprc, 2 FROM ranking r
  UNION ALL SELECT 'precision', a.precision, 3 FROM atm a
  UNION ALL SELECT 'recall', a.recall, 4 FROM atm a
  UNION ALL SELECT 'f1', a.f1, 5 FROM atm a
  UNION ALL SELECT 'threshold', {THRESHOLD}, 6
  UNION ALL SELECT 'n_positive', CAST(r.n_pos AS DOUBLE), 7 FROM ranking r
  UNION ALL SELECT 'n_negative', CAST(r.n_neg AS DOUBLE), 8 FROM ranking r
  UNION ALL SELECT 'n_total', CAST(r.n_pos + r.n_neg AS DOUBLE), 9 FROM ranking r
  UNION ALL SELECT 'pct_positive', 100.0 * r.n_pos / (r.n_pos + r.n_neg), 10 FROM ranking r
  UNION ALL SELECT 'pct_negative', 100.0 * r.n_neg / (r.n_pos + r.n_neg), 11 FROM ranking r) t""",
        _score_sql("lineitem") + "," + _AT_SQL + "," + _rank_metrics_sql("pred", "sepsis_prob", "sepsis_label", None),
    ),
    ["value"],
)(_evl6)


def _jon7(spark, sf_dir):
    p, x = scored_gold(spark, sf_dir, "lineitem")
    return attach_patients(_pred_cols(p), x.stays, x.patients).select(
        STAY, "window_end", "subject_id", "anchor_age", "sepsis_prob"
    )


register(
    "JON7_attach_patients_lineitem",
    Q.with_mapping(
        "lineitem",
        """SELECT p.stay_id, p.window_end, st.subject_id, pt.anchor_age, p.sepsis_prob
FROM pred p LEFT JOIN stays st ON p.stay_id = st.stay_id LEFT JOIN patients pt ON st.subject_id = pt.subject_id""",
        _score_sql("lineitem"),
    ),
    ["anchor_age", "sepsis_prob"],
)(_jon7)


def _d13(spark, sf_dir):
    """The threshold is chosen on the validation stays and reported on the test stays."""
    p, _ = scored_gold(spark, sf_dir, "lineitem")
    rows = temporal_split(p.select(STAY, "window_end", LABEL, "sepsis_prob").checkpoint()).checkpoint()
    chosen = youden_threshold(rows.where(F.col("split") == "val"), "sepsis_prob", LABEL)
    test = with_scalars(rows.where(F.col("split") == "test"), chosen)
    test = test.withColumn("sepsis_alert", flag(F.col("sepsis_prob") >= F.col("threshold")))
    out = with_scalars(at_threshold(test, None, "sepsis_prob", LABEL, alert="sepsis_alert"), chosen)
    return with_scalars(out, ranking_metrics(test, "sepsis_prob", LABEL).select("auroc", "auprc"))


register(
    "EVAL_validation_threshold_lineitem",
    Q.with_mapping(
        "lineitem",
        "SELECT m.*, t.threshold, t.youden_j, r.auroc, r.auprc FROM atm m CROSS JOIN th t CROSS JOIN ranking r",
        _score_sql("lineitem")
        + ","
        + TEMPORAL_CUTS
        + """,
parts AS (SELECT p.*, c.split FROM pred p JOIN cuts c ON p.stay_id = c.stay_id),
h AS (SELECT sepsis_prob AS s, count(*) FILTER (WHERE sepsis_label = 1) AS pos,
             count(*) FILTER (WHERE sepsis_label = 0) AS neg FROM parts WHERE split = 'val' GROUP BY sepsis_prob),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM h),
c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM h),
roc AS (
  SELECT 'inf'::DOUBLE AS threshold, 0.0 AS j
  UNION ALL
  SELECT c.s, c.tp / tot.P - c.fp / tot.N FROM c CROSS JOIN tot),
th AS (SELECT threshold, j AS youden_j FROM roc ORDER BY j DESC, threshold DESC LIMIT 1),
test AS (SELECT parts.*, th.threshold FROM parts CROSS JOIN th WHERE split = 'test'),"""
        + _AT_SQL.replace(f">= {THRESHOLD}", ">= threshold").replace(f"< {THRESHOLD}", "< threshold").replace("FROM pred", "FROM test")
        + ","
        + _rank_metrics_sql("test", "sepsis_prob", "sepsis_label", None).replace("cum AS", "cumu AS").replace("FROM cum ", "FROM cumu ").replace("hist AS", "histo AS").replace("FROM hist)", "FROM histo)"),
    ),
    ["precision", "recall", "f1", "alert_rate", "threshold", "youden_j", "auroc", "auprc"],
)(_d13)
