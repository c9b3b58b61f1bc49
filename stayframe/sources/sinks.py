"""Batch sinks and read-back checks (SNK1, SNK2, SNK3, SNK5).

Date-partitioned writes are rebalanced on the partition column first, so each
date directory is written by one or a few tasks: no small-file explosion and
no task holding an open writer per date (the cause of the driver running out
of memory with thousands of output partitions), and AQE splits a date that
holds too many rows across several writers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | str | None = None,
    format: str = "parquet",
    mode: str = "overwrite",
) -> str:
    """Overwrite (or append) a table, optionally partitioned (SNK1 / SNK2)."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    writer_df = df
    if parts:
        # Rows of one partition value go to few tasks (few files per date);
        # AQE splits a value that holds too many rows and merges small ones,
        # so a hot date never lands in one writer.
        writer_df = df.hint("rebalance", *parts)
    w = writer_df.write.format(format).mode(mode)
    if format == "parquet":
        w = w.option("compression", "zstd")
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path


def write_report_csv(df: DataFrame, path: str) -> str:
    """Small report table as one header CSV file (SNK3).  Reports are
    aggregates with a bounded row count, so one output file is fine."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def verify_written(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    expected_columns: Sequence[str] | None = None,
    expected_types: Mapping[str, str] | None = None,
    label: str | None = None,
) -> DataFrame:
    """Read a written table back and return one summary row (SNK5):
    ``n_rows``, ``n_columns``, ``columns_ok`` and ``types_ok`` against the
    expectation and, with ``label``, the rows per label value (0, 1, NULL)."""
    df = spark.read.format(format).load(path)
    cols, types = df.columns, dict(df.dtypes)
    ok = expected_columns is None or list(expected_columns) == [
        c for c in cols if c in set(expected_columns)
    ]
    types_ok = all(types.get(c) == t for c, t in (expected_types or {}).items())
    counts = [F.count(F.lit(1)).alias("n_rows")]
    if label:
        counts += [
            F.count_if(F.col(label) == 0).alias("n_label_0"),
            F.count_if(F.col(label) == 1).alias("n_label_1"),
            F.count_if(F.col(label).isNull()).alias("n_label_null"),
        ]
    return df.agg(*counts).withColumns(
        {"n_columns": F.lit(len(cols)), "columns_ok": F.lit(bool(ok)), "types_ok": F.lit(types_ok)}
    )
