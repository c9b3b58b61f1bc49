"""Role mappings from the driver's tables onto the canonical inputs.

The test tables hold no clinical data, so every operator is parameterised by
items and window length and runs on two mappings:

* ``events`` (mapping A): stay = ``user_id``; admission = ``user_id div 2``
  (two stays per admission); start = hour of the first event + 12 h (so some
  readings precede the start); end = last event; vitals = click/view/purchase
  values, labs = signup/error values keyed by admission; window 6 h; label =
  any ``error`` above 200.
* ``orders`` + ``lineitem`` (mapping B): stay = order; admission and subject =
  customer; start = order date, end = start + 720 days; vitals = line price by
  ``returnflag||linestatus``; labs = line price by line number keyed by
  customer (numbers 1-4 are the lab items); window 90 days; label = priority ``1-*`` or ``2-*``.

All stays/labels tables are derived by Spark from the given tables, so the
work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.config import (
    ADMISSION,
    INTIME,
    ITEM,
    LABEL,
    OUTTIME,
    STAY,
    SUBJECT,
    TIME,
    VALUE,
    WindowConfig,
)
from stayframe.functions import add_seconds, truncate_hour
from stayframe.session import widen
from stayframe.sources.tables import read_table

# Fixed values of the test mappings.
EVENTS_VITALS = ("click", "view", "purchase")
EVENTS_LABS = ("signup", "error")
EVENTS_WINDOW_SECONDS = 6 * 3600
EVENTS_START_OFFSET_HOURS = 12
EVENTS_LABEL_THRESHOLD = 200.0
LINEITEM_VITALS = ("AF", "AO", "NF", "NO", "RF", "RO")
LINEITEM_LABS = (1, 2, 3, 4)
LINEITEM_WINDOW_SECONDS = 90 * 86400
ORDERS_STAY_DAYS = 720
ORDERS_LABEL_PREFIXES = ("1", "2")

EVENTS_CFG = WindowConfig(
    vital_items=EVENTS_VITALS,
    lab_items=EVENTS_LABS,
    window_seconds=EVENTS_WINDOW_SECONDS,
    threshold=0.35,
    ranges={"click": (1.0, 300.0), "view": (1.0, 300.0), "purchase": (5.0, 250.0)},
)
LINEITEM_CFG = WindowConfig(
    vital_items=LINEITEM_VITALS,
    lab_items=LINEITEM_LABS,
    window_seconds=LINEITEM_WINDOW_SECONDS,
    threshold=0.35,
    ranges={
        "AF": (1000.0, 80000.0),
        "AO": (1000.0, 80000.0),
        "NF": (5000.0, 90000.0),
        "NO": (5000.0, 90000.0),
        "RF": (2000.0, 100000.0),
    },
)


class Inputs:
    """Role tables of a mapping, each built on first use (a query plans only
    the tables it reads):

    * ``stays``: stay_id, hadm_id, subject_id, intime, outtime
    * ``vitals``: stay_id, charttime, itemid, valuenum
    * ``labs``: hadm_id, charttime, itemid, valuenum
    * ``labels``: stay_id, sepsis_label
    * ``patients``: subject_id, anchor_age
    """

    ROLES = ("stays", "vitals", "labs", "labels", "patients")

    def __init__(self, cfg: WindowConfig, **builders):
        self.cfg = cfg
        self._builders = builders
        self._built: dict = {}

    def __getattr__(self, name: str):
        builders = self.__dict__.get("_builders", {})
        if name not in builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = builders[name]()
        return self._built[name]


def _once(fn):
    """Memoise a zero-argument builder."""
    box: list = []

    def get():
        if not box:
            box.append(fn())
        return box[0]

    return get


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Scan of a driver table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    widen(spark, path)
    return read_table(spark, path, columns=columns)


def patients_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age-like attribute: account balance / 100 (some fall in no bucket)."""
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    return c.select(F.col("c_custkey").alias(SUBJECT), (F.col("c_acctbal") / F.lit(100.0)).alias("anchor_age"))


def events_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    ev = _once(lambda: table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"]))

    @_once
    def per_user():
        err = (F.col("event_type") == "error") & (F.col("value") > EVENTS_LABEL_THRESHOLD)
        return ev().groupBy("user_id").agg(
            F.min("ts").alias("_first"),
            F.max("ts").alias("_last"),
            F.max(F.when(err, 1).otherwise(0)).alias(LABEL),
        )

    def stays():
        return per_user().select(
            F.col("user_id").alias(STAY),
            F.floor(F.col("user_id") / 2).cast("long").alias(ADMISSION),
            F.col("user_id").alias(SUBJECT),
            add_seconds(truncate_hour("_first"), EVENTS_START_OFFSET_HOURS * 3600).alias(INTIME),
            F.col("_last").alias(OUTTIME),
        )

    def labels():
        return per_user().select(F.col("user_id").alias(STAY), F.col(LABEL).cast("int").alias(LABEL))

    def vitals():
        return ev().where(F.col("event_type").isin(*EVENTS_VITALS)).select(
            F.col("user_id").alias(STAY), F.col("ts").alias(TIME), F.col("event_type").alias(ITEM), F.col("value").alias(VALUE)
        )

    def labs():
        return ev().where(F.col("event_type").isin(*EVENTS_LABS)).select(
            F.floor(F.col("user_id") / 2).cast("long").alias(ADMISSION),
            F.col("ts").alias(TIME),
            F.col("event_type").alias(ITEM),
            F.col("value").alias(VALUE),
        )

    return Inputs(
        EVENTS_CFG, stays=stays, vitals=vitals, labs=labs, labels=labels,
        patients=lambda: patients_from_customer(spark, sf_dir),
    )


def lineitem_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    o = _once(lambda: table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]))
    li = _once(
        lambda: table(
            spark,
            sf_dir,
            "lineitem",
            ["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"],
        )
    )

    def stays():
        return o().select(
            F.col("o_orderkey").alias(STAY),
            F.col("o_custkey").alias(ADMISSION),
            F.col("o_custkey").alias(SUBJECT),
            F.col("o_orderdate").alias(INTIME),
            add_seconds("o_orderdate", ORDERS_STAY_DAYS * 86400).alias(OUTTIME),
        )

    def labels():
        positive = F.substring("o_orderpriority", 1, 1).isin(*ORDERS_LABEL_PREFIXES)
        return o().select(F.col("o_orderkey").alias(STAY), F.when(positive, 1).otherwise(0).cast("int").alias(LABEL))

    def vitals():
        return li().select(
            F.col("l_orderkey").alias(STAY),
            F.col("l_shipdate").alias(TIME),
            F.concat("l_returnflag", "l_linestatus").alias(ITEM),
            F.col("l_extendedprice").alias(VALUE),
        )

    def labs():
        return (
            li()
            .join(o().select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "inner")
            .select(
                F.col("o_custkey").alias(ADMISSION),
                F.col("l_shipdate").alias(TIME),
                F.col("l_linenumber").alias(ITEM),
                F.col("l_extendedprice").alias(VALUE),
            )
        )

    return Inputs(
        LINEITEM_CFG, stays=stays, vitals=vitals, labs=labs, labels=labels,
        patients=lambda: patients_from_customer(spark, sf_dir),
    )


MAPPINGS = {"events": events_inputs, "lineitem": lineitem_inputs}

# Deterministic stand-in score of the test mappings,
# prob = floor(1000 * m / (m + scale)) / 1000 with m the first non-NULL vital
# mean (0 when none); quantised so that tied scores occur.
SCORE_SCALE = {"events": 50.0, "lineitem": 50000.0}


def rule_score(df: DataFrame, cfg: WindowConfig, scale: float, prob: str = "sepsis_prob") -> DataFrame:
    """Attach a deterministic score computed from a window's vital means."""
    m = F.coalesce(*[F.col(f"vital_{i}_mean") for i in cfg.vital_items], F.lit(0.0))
    return df.withColumn(prob, F.floor(F.lit(1000.0) * m / (m + F.lit(scale))) / F.lit(1000.0))


def reading_scores(x: Inputs, scale: float) -> DataFrame:
    """Per-reading scores with the stay's label: ``stay_id, score, sepsis_label``."""
    v = x.vitals.where(F.col(VALUE).isNotNull())
    s = v.select(STAY, (F.floor(F.lit(1000.0) * F.col(VALUE) / (F.col(VALUE) + F.lit(scale))) / F.lit(1000.0)).alias("score"))
    return s.join(x.labels, STAY, "inner")
