"""JSON event messages (SRC1, SRC2, SRC3, SNK4).

A message is one JSON object with a fixed five-field schema.  Sources differ
(a Kafka topic where the connector is installed, a folder of text files for
tests) but all of them yield a ``value`` column that is decoded here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from stayframe.config import ITEM, STAY, TIME, VALUE
from stayframe.functions import iso_string, nan_to_null

EVENT_SCHEMA = StructType(
    [
        StructField(STAY, LongType(), True),
        StructField(TIME, StringType(), True),
        StructField(ITEM, IntegerType(), True),
        StructField(VALUE, DoubleType(), True),
        StructField("event_type", StringType(), True),
    ]
)


def read_events(
    spark: SparkSession,
    format: str = "text",
    options: dict | None = None,
    path: str | None = None,
    stream: bool = True,
) -> DataFrame:
    """Subscribe to an event source (SRC1).

    ``format="kafka"`` needs ``kafka.bootstrap.servers`` and ``subscribe`` in
    ``options`` and the connector jar; ``startingOffsets`` defaults to
    ``latest`` on the first run, after which the checkpoint decides.  File
    formats (``text``) read new files from ``path``.  The result always has a
    ``value`` column.
    """
    opts = dict(options or {})
    reader = spark.readStream if stream else spark.read
    reader = reader.format(format)
    if format == "kafka":
        opts.setdefault("startingOffsets", "latest")
    for k, v in opts.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path is not None else reader.load()
    if format == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"))
    return df


def parse_events(df: DataFrame, schema: StructType = EVENT_SCHEMA, keep_raw: bool = True) -> DataFrame:
    """Decode the ``value`` text with a fixed schema and flatten it (SRC2).

    A message that is no JSON object, has no field of the schema, or holds a
    field that does not fit its type is kept with what could be read, its raw
    text in ``_raw`` and ``is_malformed`` set, so nothing is silently lost.
    A bare ``NaN`` number becomes NULL.
    """
    raw = F.col("value").cast("string")
    corrupt = "_corrupt"
    full = StructType([*schema.fields, StructField(corrupt, StringType(), True)])
    parsed = df.select(raw.alias("_raw"), F.from_json(raw, full, {"columnNameOfCorruptRecord": corrupt}).alias("_d"))
    fields = []
    for f in schema.fields:
        c = F.col(f"_d.{f.name}")
        if isinstance(f.dataType, DoubleType):
            c = nan_to_null(c)
        fields.append(c.alias(f.name))
    all_null = None
    for f in schema.fields:
        term = F.col(f"_d.{f.name}").isNull()
        all_null = term if all_null is None else (all_null & term)
    bad = F.col("_d").isNull() | F.col(f"_d.{corrupt}").isNotNull() | all_null
    out = parsed.select(*fields, bad.alias("is_malformed"), "_raw")
    if not keep_raw:
        out = out.drop("_raw")
    return out


def stamp_ingestion(df: DataFrame, column: str = "ingestion_timestamp") -> DataFrame:
    """Audit column with the micro-batch's processing time (SRC3)."""
    return df.withColumn(column, F.current_timestamp())


def to_event_json(
    df: DataFrame,
    event_type: str,
    fields: Sequence[str] = (STAY, TIME, ITEM, VALUE),
) -> DataFrame:
    """Encode rows as event messages (SNK4): ``key`` (the stay) and ``value``
    (JSON text).  Timestamps are written as ISO-8601 text.  Any sink that
    takes a ``value`` column (Kafka, text files) can write the result."""
    cols = []
    for name in fields:
        c = F.col(name)
        if name == TIME:
            c = iso_string(c)
        cols.append(c.alias(name))
    cols.append(F.lit(event_type).alias("event_type"))
    return df.select(
        F.col(STAY).cast("string").alias("key"),
        F.to_json(F.struct(*cols)).alias("value"),
    )
