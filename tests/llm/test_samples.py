"""Bounds of the samples that fit classifiers, with repeated rows, hot and null keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.llm import language, quality
from stayframe.llm.common import bounded_sample

from .test_operators import documents


def test_a_sample_is_bounded_whatever_the_keys(spark):
    rows = [(None, f"n{k}") for k in range(3000)] + [(1, "same")] * 3000 + [(2, f"t{k}") for k in range(3000)] + [(k, "x") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bounded_sample(df, "doc_id", 400).collect()
    assert len(got) == len(set(got)) < 800 and all(r.doc_id is not None for r in got) and sum(r.doc_id == 2 for r in got) > 50
    assert len(bounded_sample(df.where("doc_id <> 2"), "doc_id", 10**6).collect()) == 100  # ids 0..99 less 2, and the repeated row once


def test_documents_of_one_labelled_id_are_bounded(spark):
    docs = documents(spark, [f"text {k}" for k in range(2000)], [5] * 2000)
    labels = spark.createDataFrame([(5, 1, 0)] * 50, "doc_id long, quality int, toxic int")
    voter = quality.fit(docs, labels, sample=200)
    assert 50 < len(voter.labels) < 400
    assert len(quality.fit(documents(spark, ["a"] * 500, [5] * 500), labels, sample=200).labels) == 1


def test_texts_without_letters_are_undetermined(spark):
    docs = documents(spark, ["½ ² 3 _", "１２", None, "", "le chat", "ªº"], None).withColumn("lang", F.lit("fr"))
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()}
    assert [got[k] for k in range(6)] == ["und", "und", "und", "und", "fr", "fr"]
