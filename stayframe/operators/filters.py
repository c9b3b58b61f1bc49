"""Row filters (FLT1-FLT6).  All are plain predicates or semi joins, so
Catalyst pushes them into the Parquet scan where the column allows it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stayframe.config import INTIME, ITEM, STAY, TIME, VALUE
from stayframe.functions import safe_div


def keep_items(df: DataFrame, items: Sequence, col: str = ITEM) -> DataFrame:
    """FLT1: item whitelist (``IN`` list, pushed to the scan)."""
    return df.where(F.col(col).isin(list(items)))


def keep_measured(df: DataFrame, col: str = VALUE) -> DataFrame:
    """FLT2: drop readings without a value (NaN counts as no value)."""
    return df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))


def drop_before_start(df: DataFrame, start: str = INTIME, ts: str = TIME) -> DataFrame:
    """FLT3: keep readings at or after the entity's start time."""
    return df.where(F.col(ts) >= F.col(start))


def restrict_to(df: DataFrame, ids: DataFrame, key: str = STAY) -> DataFrame:
    """FLT4: keep rows whose key is in ``ids`` (a left-semi join, so the id
    set never passes through the driver)."""
    return df.join(ids.select(key), key, "left_semi")


def ranges_frame(spark, ranges: Mapping, item_type) -> DataFrame:
    """Small ``(itemid, lo, hi)`` table from a mapping ``item -> (lo, hi)``."""
    schema = StructType(
        [
            StructField(ITEM, item_type, False),
            StructField("lo", DoubleType(), False),
            StructField("hi", DoubleType(), False),
        ]
    )
    rows = [(k, float(lo), float(hi)) for k, (lo, hi) in ranges.items()]
    return spark.createDataFrame(rows, schema)


def _ranges(df: DataFrame, ranges, item: str) -> DataFrame:
    """A range table; one built from a mapping has a row per listed item and is
    broadcast, a caller's own table is left to the planner."""
    if isinstance(ranges, DataFrame):
        return ranges
    return F.broadcast(ranges_frame(df.sparkSession, ranges, df.schema[item].dataType))


def clean_ranges(df: DataFrame, ranges, item: str = ITEM, value: str = VALUE) -> DataFrame:
    """FLT5: keep readings inside their item's ``[lo, hi]`` (both ends
    inclusive); items without a range are dropped."""
    r = _ranges(df, ranges, item)
    return (
        df.join(r, item, "inner")
        .where(F.col(value).between(F.col("lo"), F.col("hi")))
        .drop("lo", "hi")
    )


def range_drop_report(df: DataFrame, ranges, item: str = ITEM, value: str = VALUE) -> DataFrame:
    """FLT6: per listed item and in total: rows before, rows kept, % dropped.

    One ``ROLLUP`` aggregation gives the per-item rows and the grand total in
    a single pass.  The total counts every row (unlisted items included) as
    rows before cleaning.  0/0 gives a NULL percentage.
    """
    r = _ranges(df, ranges, item)
    j = df.select(item, value).join(r, item, "left").withColumn("_listed", F.when(F.col("lo").isNotNull() | F.col("hi").isNotNull(), True))
    kept = F.coalesce(F.col("_listed"), F.lit(False)) & F.col(value).between(F.col("lo"), F.col("hi"))
    agg = j.rollup(item).agg(
        F.grouping(item).alias("_g"),
        F.count(F.lit(1)).alias("_all"),
        F.count_if(kept).alias("n_kept"),
        F.max("_listed").alias("_listed"),
    )
    agg = agg.where((F.col("_g") == 1) | F.col("_listed"))
    return agg.select(
        F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.col(item).cast("string")).alias("item"),
        F.col("_all").cast("long").alias("n_before"),
        F.col("n_kept").cast("long").alias("n_kept"),
        F.round(F.lit(100.0) * (F.lit(1.0) - safe_div("n_kept", "_all")), 6).alias("pct_dropped"),
    )
