"""The trees of op3 learn from every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.llm import pii

from .test_operators import documents


def test_formats_count_the_candidates_of_all_documents(spark):
    texts = [f"call +1 (212) 555-{1000 + k}" for k in range(5000)] + ["mail jo at home dot com now", "no candidate", None]
    docs = documents(spark, texts)
    found = pii.formats(docs.union(docs.limit(50)))  # repeated rows count once
    n = {(r.kind, r.covered): r.n for r in found.groupBy("kind", "covered").agg(F.sum("n").alias("n")).collect()}
    assert n == {("phone", True): 5000, ("email", False): 1}
    assert found.count() < 50


def test_documents_without_an_id_are_learned_from(spark):
    docs = documents(spark, [f"call +1 (212) 555-{1000 + k}" for k in range(40)]).withColumn("doc_id", F.lit(None).cast("long"))
    assert pii.formats(docs).agg(F.sum("n")).first()[0] == 40
