"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayframe.llm import chat, decontaminate, language, neighbours, packing, pii, quality, secrets, simhash, spelling, substrings, tokenfiles, whitening
from stayframe.llm.common import table
from stayframe.session import tune


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digests(substrings.remove_repeats(table(spark, sf_dir, "documents")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(packing.VOCABULARY))
    return packing.pack(pieces)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(pii.find_pii(table(spark, sf_dir, "documents")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), decontaminate.whole_seeds)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(chat.format_chats(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_rows(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_digests(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_rows(table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_rows(table(spark, sf_dir, "documents"), public_tokenizers.path(packing.VOCABULARY))


def _tuned(fn):
    return lambda spark, sf_dir: fn(tune(spark), sf_dir)


_ALL = (
    op1_substrings, op2_packing, op3_pii, op4_decontaminate, op5_chat_format, op6_language, op7_neighbours, op8_secrets, op9_simhash, op10_quality,
    op11_spelling, op12_whitening, op13_token_files,
)
QUERIES = {f.__name__: _tuned(f) for f in _ALL}
SQL = {"op1_substrings": substrings.SUBSTRINGS_SQL, "op4_decontaminate": decontaminate.LEAKS_SQL, "op5_chat_format": chat.CHAT_SQL, "op11_spelling": spelling.SPELLING_SQL}
