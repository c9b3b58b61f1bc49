"""Spelling variants against brute force: all pairs, hot beginnings and endings, ties, nulls and odd texts."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from stayframe.llm import spelling

from .test_operators import ODD, documents


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    counts: Counter = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    vocabulary = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in vocabulary if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)] for w in vocabulary}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best and vocabulary[best] >= 5 * n else None
    out = set()
    for w, n in vocabulary.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), vocabulary.get(form[w])))
    return out


def edited(rng, w, letters):
    k = rng.randrange(len(w) + 1)
    return rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k + 1 :]])


def texts(rng):
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(5, 10))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "x" * 300, "x" * 301, "ÀÖ×÷øÿ", "àÖ×÷øÿ"]
    words += [edited(rng, w, "abcé") for w in words for _ in range(2)]
    said = []
    for w in words:
        said += [rng.choice([w, w.upper() if w.isascii() else w])] * rng.choice([3, 5, 6, 25, 30, 150])
    rng.shuffle(said)
    return [rng.choice([" ", ", ", "1", "_"]).join(said[k : k + 40]) for k in range(0, len(said), 40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = texts(rng) + ODD + [None, "abcabc " * 7]
    ids = [*range(len(rows) - 3), None, None, 3]
    docs = documents(spark, rows, ids, clash=True).repartition(5)
    found = spelling.variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in found.collect()]
    want = brute(zip(ids, rows))
    assert set(got) == want and len(got) == len(want)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])


def test_partitions_split_until_they_are_small(spark):
    rng = random.Random(3)
    words = {"prefix" * 3 + "".join(rng.choice("abc") for _ in range(rng.randrange(3, 6))) for _ in range(150)}
    words |= {"".join(rng.choice("abc") for _ in range(rng.randrange(3, 6))) + "ending" * 3 for _ in range(150)}
    words |= {"ab" + "".join(rng.choice("abc") for _ in range(4)) + "ba" for _ in range(60)} | {"a" * k for k in range(6, 14)}
    vocabulary = spark.createDataFrame([(w, k) for k, w in enumerate(sorted(words))], "word string, n long")
    want = sorted((a, b) for a in words for b in words if a != b and one_edit(a, b))
    for large, bucket in ((3, 40), (10_000, 20_000)):
        got = spelling.near_pairs(vocabulary, large=large, bucket=bucket).collect()
        assert sorted((r.word, r.other) for r in got) == want  # each pair once
    number = {w: k for k, w in enumerate(sorted(words))}
    assert all(number[r.other] == r.n_other for r in got)


def test_acceptor_is_minimal():
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops"})
    made = spelling.Acceptor((0, w) for w in words)
    assert len(made.next) == 6 + 1  # ends: "", s; then p, a|o, t; the first symbol; "s" -> t
    assert sorted(made.common(made.initial[0], made.initial[0])) == words


def test_sql_twin_agrees(spark, tmp_path):
    rows = texts(random.Random(4)) + ODD
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert set(db.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({spelling.SPELLING_SQL})").fetchall()) == brute(enumerate(rows))


def test_an_empty_table_gives_no_rows(spark):
    assert spelling.variants(documents(spark, ["abcdef " * 9]).limit(0)).count() == 0
    assert spelling.variants(documents(spark, [None, "", "abc"])).count() == 0
