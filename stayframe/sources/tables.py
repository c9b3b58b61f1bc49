"""Batch table scans (SRC5, SRC6, SRC7, SRC8).

Scans always take an explicit column list so Parquet reads only those
columns, and filters applied afterwards reach the scan as pushed filters.
CSV is read with a declared schema: ``inferSchema`` costs a full extra pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayframe.config import STAY, TIME


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    columns: Sequence[str] | None = None,
    schema: StructType | str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Load a table and project it (SRC5 / SRC8); Spark alone decides the
    input splits (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``)."""
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    if columns:
        df = df.select(*columns)
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    columns: Sequence[str] | None = None,
    header: bool = True,
    timestamp_ntz_format: str | None = None,
) -> DataFrame:
    """Header CSV with a declared schema (SRC6).  ``.gz`` input is not
    splittable: land it to Parquet once (``land_measurements``) before
    scanning it repeatedly."""
    opts = {"header": str(header).lower(), "mode": "PERMISSIVE"}
    if timestamp_ntz_format:
        opts["timestampNTZFormat"] = timestamp_ntz_format
    return read_table(spark, path, "csv", columns, schema, opts)


def land_measurements(
    events: DataFrame,
    keep: DataFrame | None,
    items: Sequence | None,
    path: str,
    key: str = STAY,
    item_col: str = "itemid",
    value_col: str = "valuenum",
    time_col: str = TIME,
    partitions: int | None = None,
) -> DataFrame:
    """Scan-and-filter a large raw table once and land it as Parquet
    clustered by ``key`` and time (SRC7), in ranges of both, so a key with
    very many rows is written by several tasks.

    ``keep`` is a DataFrame of wanted keys: applied as a left-semi join, never
    as a driver-side id set.  Returns the landed table read back.
    """
    df = events
    if items is not None:
        df = df.where(F.col(item_col).isin(list(items)))
    df = df.where(F.col(value_col).isNotNull())
    if keep is not None:
        df = df.join(keep.select(key), key, "left_semi")
    order = [key, time_col]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
