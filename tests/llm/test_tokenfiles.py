"""Token-id files: exact round trips, order, damage, nulls, repeats and odd texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayframe.llm import tokenfiles
from stayframe.llm.tokens import VOCABULARY, Encoder

from .test_operators import ODD, documents, prose

PATH = public_tokenizers.path(VOCABULARY)
STRANGE = ["Y̊ W̊ é a<|endoftext|>B <|ENDOFTEXT|>  xy İstanbul DON'T", "  \xa0", "\U0001f600" * 50]


def test_codes_of_every_length_round_trip():
    rng = np.random.default_rng(1)
    for sizes in ([], [0], [1], [0, 3, 4, 5, 0, 1], list(rng.integers(0, 40, 200))):
        first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        ranks = (rng.integers(0, 1 << 32, first[-1], dtype=np.uint64) >> rng.integers(0, 32, first[-1]).astype(np.uint64)).astype(np.uint32)
        control, data, c, d = tokenfiles.encode(ranks, first)
        assert (tokenfiles.decode(control, data, np.diff(first)) == ranks).all()
        for k in range(len(sizes)):  # each document by itself
            one = tokenfiles.decode(control[c[k] : c[k + 1]], data[d[k] : d[k + 1]], np.diff(first)[k : k + 1])
            assert (one == ranks[first[k] : first[k + 1]]).all()
    ends = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], np.uint32)
    control, data, *_ = tokenfiles.encode(ends, np.array([0, 8]))
    assert list(control) == [0b01010000, 0b11111010] and len(data) == 20
    assert (tokenfiles.decode(control, data, np.array([8])) == ends).all()


def test_a_damaged_block_is_refused():
    block = tokenfiles.pack_block(7, [3, None], np.array([1, 2]), b"\x00\x00", b"abc") + b"\n"
    (docs, order, total, control, data, at), *_ = tokenfiles.blocks_of(memoryview(block * 2))
    ids, nulls, n, ranks = tokenfiles.unpack_block(memoryview(block), docs, control, data, at)
    assert (order, total, ids.tolist(), nulls.tolist(), n.tolist(), ranks.tolist()) == (7, 3, [3, 0], [False, True], [1, 2], [97, 98, 99])
    broken = bytearray(block)
    broken[-3] ^= 1
    with pytest.raises(ValueError):
        tokenfiles.unpack_block(memoryview(broken), docs, control, data, at)


def test_encoder_gives_the_tokenizer_s_ids_with_little_memory():
    rng = random.Random(5)
    texts = STRANGE + [t or "" for t in ODD] + [" ".join(prose(rng, 200, 5000)) for _ in range(20)]
    plain, small = Tokenizer.from_file(PATH), Encoder(PATH, keep=300)
    for at in range(0, len(texts), 5):
        part = texts[at : at + 5]
        ids, first = small([t.encode() for t in part])
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in part]


def test_signs_at_a_word_s_end_are_split_off_without_change():
    rng = random.Random(7)
    heads = ["word", "Word", "don't", "été", "ÉTÉ", "e\u0301", "x\u0338", "×", "3", "12", "a<", "<|endoftext|>", "<|endoftext|", "日本", "'s", "ß", "İ", "\u0301", "a'", "(b", "\xa0", "Ã", "\u00c3\u0097", "ς"]
    tails = ["", ".", "...", "$$$", ",###", "*" * 15, "*" * 16, "*" * 17, "*" * 40, ".'s", "|", "|>", "!\u0338", "=\u0338", ".)", ".é"]
    texts = [" ".join(rng.choice(heads) + rng.choice(tails) for _ in range(60)) for _ in range(60)] + [h + t for h in heads for t in tails]
    plain, small = Tokenizer.from_file(PATH), Encoder(PATH, keep=100)
    for at in range(0, len(texts), 30):
        part = texts[at : at + 30]
        ids, first = small([t.encode() for t in part])
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in part]
    small([f"new{k}$$$ new{k}," .encode() for k in range(5)])
    assert all(f"new{k}$$$".encode() not in small.place and f"new{k}".encode() in small.place for k in range(5))


def test_a_full_memory_of_words_keeps_those_met_often():
    small, plain = Encoder(PATH, keep=200), Tokenizer.from_file(PATH)
    learnt = []
    run = small._learn
    small._learn = lambda new: (learnt.extend(new), run(new))
    for k in range(60):
        text = "common words stand in each text " + " ".join(f"rare{k}x{j}" for j in range(20))
        ids, _ = small([text.encode()])
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(small.place) <= 200 and len(small.seen) == len(small.at) == len(small.count)
    assert learnt.count(b"common") == 1 and len(learnt) == 60 * 20 + 6


def test_files_round_trip_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SMALL_PART", 4_000)
    rng = random.Random(6)
    texts = ODD + STRANGE + [" ".join(prose(rng, rng.randrange(0, 600))) for _ in range(80)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[5] = None
    ids += [ids[20], ids[20], None]
    texts += [texts[20], "another text of that id", "null too"]
    docs = documents(spark, texts, ids, clash=True).repartition(4)
    folder = str(tmp_path / "tokens")
    tokenfiles.write_token_files(docs, folder, PATH)
    plain = Tokenizer.from_file(PATH)
    want = sorted(((i is not None, i or 0), plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in zip(ids, texts))
    rows = tokenfiles.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids) for r in rows) == want
    keys = [(r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in rows]
    assert keys == sorted(keys)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    ranks = [r.id for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    counts = np.bincount(np.concatenate([r.ids for r in rows]))
    assert ranks == sorted(np.flatnonzero(counts).tolist(), key=lambda i: (-counts[i], i))
    files = spark.read.format("binaryFile").load(f"{folder}/files").where(F.col("length") > 0)
    assert files.count() > 3
    digests = tokenfiles.token_rows(docs, PATH)
    assert digests.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(digests.collect(), key=lambda r: r.start) == [r[:4] for r in rows]


def test_an_empty_table_gives_no_rows(spark):
    assert tokenfiles.token_rows(documents(spark, ["x"]).limit(0), PATH).count() == 0
