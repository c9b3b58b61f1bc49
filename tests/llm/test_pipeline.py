"""The corpus pipeline on a small table, against the same stages by brute force, and the registered queries' contracts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from stayframe.llm import packing, queries

from .test_operators import base_spans, brute_components, brute_leaks, plain_fingerprint, prose


def tables(spark, folder):
    rng = random.Random(21)
    bench = [(j, " ".join(prose(rng, 25, 10**6))) for j in range(4)]
    rows, good = [], {}
    for i in range(300):
        words = prose(rng, rng.randrange(30, 120), 10**6)
        good[i] = i % 6 != 0
        if i % 25 == 1:
            words[5:5] = bench[i % 4][1].split()
        if i % 20 == 3:
            words[9:9] = "mail x.y@mail.example.com or +1 (202) 555-0147".split()
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if not good[i] else " ".join(words) + "."))
    for k in range(30):
        rows.append((300 + k, rows[7 + k % 5][1]))
        good[300 + k] = good[7 + k % 5]
    docs = [(i, t, "en", "s", len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, int(good[i]), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return dict(rows), good, bench


def test_pipeline_matches_brute_force(spark, tmp_path):
    texts, good, bench = tables(spark, tmp_path)
    kept = {i: t for i, t in texts.items() if good[i]}
    fps = {i: plain_fingerprint(t) for i, t in kept.items()}
    root = brute_components(list(fps.values()))
    first: dict = {}
    for i in sorted(kept):
        first.setdefault(root[fps[i]], i)
    kept = {i: kept[i] for i in first.values()}
    bad = {i for i, _ in brute_leaks(list(kept.items()), bench)}
    kept = {i: t for i, t in kept.items() if i not in bad}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = set()
    for i, t in kept.items():
        for s in sorted((s.split(":") for s in base_spans(t)), key=lambda s: -int(s[1])):
            t = t[: int(s[1])] + f"[{s[0].upper()}]" + t[int(s[2]) :]
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4")
        want.add((i, 0, len(ids), zlib.crc32(ids.tobytes())))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    assert 5 < len(bad) and len(kept) < 260


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_duplicate_stage_keeps_one_of_each_component(spark, tmp_path):
    rng = random.Random(22)
    base = [prose(rng, n, 10**6) for n in (1, 2, 3, 12, 60, 150, 400, 900, 3000) for _ in range(3)]
    texts = [" ".join(w) for w in base] + [None, "", "A b", "a B", None]
    for words in base[9:]:
        for _ in range(4):
            edited = list(words)
            edited[rng.randrange(len(edited))] = "sub"
            texts.append(" ".join(edited))
    hot = prose(rng, 1500, 10**6)
    texts += [" ".join([*hot[:k], f"new{k}", *hot[k + 1 :]]) for k in range(100)]  # a large group of near copies
    root = brute_components([plain_fingerprint(t) for t in texts])
    first: dict = {}
    for i, t in enumerate(texts):
        first.setdefault(root[plain_fingerprint(t)], i)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, _sig string, _id int").repartition(5)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted(first.values()) and {(r._sig, r._id) for r in rows} == {("x", 1)}
    assert len(first) < len(texts) - 50


CONTRACT = {
    "op1_substrings": "doc_id:bigint,n_words:bigint,n_removed:bigint,kept_sha256:string",
    "op2_packing": "doc_id:bigint,start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,sequence_id:bigint,offset:bigint",
    "op3_pii": "doc_id:bigint,n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base_sha256:string,spans:string",
    "op5_chat_format": "conv_id:bigint,n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint",
    "op6_language": "doc_id:bigint,held_out:boolean,lang_pred:string,score:double",
    "op7_neighbours": "query_id:bigint,rank:int,vec_id:bigint,score:double",
    "op8_secrets": "doc_id:bigint,n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string",
    "op9_simhash": "doc_id:bigint,fingerprint:string,component_id:bigint",
    "op10_quality": "doc_id:bigint,held_out:boolean,score:double,predicted:int",
    "op11_spelling": "word:string,form:string,root:string,n:bigint,n_near:bigint,form_n:bigint",
    "op12_whitening": "vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double",
    "op13_token_files": "doc_id:bigint,start:bigint,n_tokens:bigint,ids_crc32:bigint",
}


def test_queries_return_the_contract_columns(spark):
    for name, want in CONTRACT.items():
        df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert df.schema.simpleString() == f"struct<{want}>", name
