"""Silver kept up from Bronze, a micro-batch at a time (AGG1 over SRC4).

Every micro-batch of new Bronze rows is folded to mergeable states, one row
per (stay, window, item): count, mean, sum of squared deviations, least and
greatest value. The states of a batch are a folder of their own, partitioned
by window date. Then only the dates that the batch touched are rewritten in
Silver, from the states of all batches for those dates. A reading may come as
late as it likes: no watermark drops it, as the state is a table.

A batch that runs again after a failure overwrites its own states and
rewrites the same dates, so every reading counts once. Windows of a date that
was not touched are not read.

``compact`` folds the states of all batches to one folder, so a date's states
don't grow with the number of batches for ever. Run it between runs of the
stream, not beside one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayframe.config import INTIME, ITEM, STAY, VALUE, WINDOW, WindowConfig
from stayframe.functions import flag
from stayframe.operators.aggregates import windowed_vitals
from stayframe.operators.windows import window_bounds
from stayframe.plans.medallion import bronze_readings
from stayframe.sources.sinks import write_table

DATE = "window_date"
KEYS = (STAY, WINDOW, INTIME, DATE, ITEM)


def reading_states(vitals: DataFrame, stays: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Mergeable states of readings: ``stay_id, window_id, intime,
    window_date, itemid, n, mean, m2, low, high``; map-side partials."""
    rows = window_bounds(windowed_vitals(vitals, stays, cfg), cfg)
    value = F.col(VALUE).cast("double")
    return rows.groupBy(*KEYS).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"), F.min(value).alias("low"), F.max(value).alias("high")
    )


def _merged(parts: Column) -> Column:
    """(n, mean, m2) of an array of states, added one after the other."""

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        gap = b["mean"] - a["mean"]
        share = b["n"] / n
        return F.struct(n.alias("n"), (a["mean"] + gap * share).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["n"] * share).alias("m2"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, zero, add)


def merge_states(states: DataFrame) -> DataFrame:
    """One state per key from any number of them (one a batch at most); the
    order in which batches came doesn't change the result."""
    parts = F.array_sort(F.collect_list(F.struct("n", "mean", "m2")))
    one = states.groupBy(*KEYS).agg(parts.alias("_parts"), F.min("low").alias("low"), F.max("high").alias("high"))
    return one.withColumn("_all", _merged(F.col("_parts"))).select(*KEYS, "_all.*", "low", "high")


def silver_of_states(states: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Silver rows (the columns of ``silver_windows``) of merged states."""
    out = []
    for i in cfg.vital_items:
        is_item = F.col(ITEM) == F.lit(i)
        std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
        values = {"mean": F.col("mean"), "min": F.col("low"), "max": F.col("high"), "std": std}
        out += [F.max(F.when(is_item, v)).alias(f"vital_{i}_{name}") for name, v in values.items()]
        out.append(flag(F.count_if(is_item) == 0).alias(f"vital_{i}_missing"))
    wide = states.groupBy(STAY, WINDOW, INTIME).agg(*out)
    return window_bounds(wide, cfg).select(STAY, WINDOW, "window_end", *cfg.vital_columns(), DATE)


def fold_batch(bronze: DataFrame, batch: int, stays: DataFrame, cfg: WindowConfig, root: str) -> Sequence:
    """Fold one batch of Bronze rows into ``root/states`` and rewrite its
    dates in ``root/silver``; returns these dates. Safe to run again."""
    spark = bronze.sparkSession
    own = f"{root}/states/batch={int(batch)}"
    write_table(reading_states(bronze_readings(bronze, "vital"), stays, cfg), own, partition_by=DATE)
    dates = [r[0] for r in spark.read.schema(f"{DATE} date").parquet(own).select(DATE).distinct().collect()]  # a row a calendar day
    if dates:
        states = spark.read.parquet(f"{root}/states").where(F.col(DATE).isin(dates))
        silver = silver_of_states(merge_states(states), cfg)
        silver.hint("rebalance", DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(DATE).parquet(f"{root}/silver")
    return sorted(dates)


def start_silver(
    spark: SparkSession,
    bronze: str,
    stays: DataFrame,
    cfg: WindowConfig,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Follow the Bronze table at ``bronze`` and keep ``root/silver`` up
    (``root`` also holds the states). The default trigger takes what is
    there, in batches, and stops."""
    reader = spark.readStream.schema(spark.read.parquet(bronze).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def fold(rows: DataFrame, batch: int) -> None:
        fold_batch(rows, batch, stays, cfg, root)

    writer = reader.parquet(bronze).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def compact(spark: SparkSession, root: str, into: str, cfg: WindowConfig) -> str:
    """Write the new root ``into``: the states of ``root`` folded to one
    folder, and their Silver. Start the stream there with the old checkpoint;
    the old root may go. The last batch's states stay apart, as that batch may
    run again."""
    states = spark.read.parquet(f"{root}/states")
    last = states.agg(F.max("batch")).first()[0]
    write_table(merge_states(states.where(F.col("batch") < last)), f"{into}/states/batch=-1", partition_by=DATE)
    write_table(states.where(F.col("batch") == last).drop("batch"), f"{into}/states/batch={last}", partition_by=DATE)
    write_table(silver_of_states(merge_states(spark.read.parquet(f"{into}/states")), cfg), f"{into}/silver", partition_by=DATE)
    return into
