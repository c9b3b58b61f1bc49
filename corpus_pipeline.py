"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents.

Null or empty texts: the quality stage scores them by the sample's share of
good rows; those kept form one group of near duplicates (fingerprint zero),
hold no leak and no personal data, and are packed as the closing id alone.
Rows with a null doc_id and repeated rows go through like any other (of equal
rows one stays). Empty tables give empty tables. Extra columns of documents
stay with their rows up to packing, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayframe.llm import decontaminate, packing, pii, quality, simhash
from stayframe.llm.common import table
from stayframe.session import remove_scratch, scratch_path, tune


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labelled ones."""
    return quality.keep_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints linked at two or fewer differing bits (3-word shingles)."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), decontaminate.whole_seeds)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(packing.cut_pieces(docs, public_tokenizers.path(packing.VOCABULARY)))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# Fitted models decide two stages, which SQL can't express; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_scratch(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
