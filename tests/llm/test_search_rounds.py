"""Rounds of op7's search change what lists hand back, never the result."""

from __future__ import annotations

import numpy as np

from stayframe.llm import neighbours


def test_more_rounds_hand_back_fewer_rows_and_find_the_same(spark, monkeypatch):
    assert len(neighbours.ROUNDS) > 1
    x = np.random.default_rng(4).standard_normal((6000, 6))
    x[100:140] = x[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    best_of, got = neighbours.best_of, []
    for rounds in ((1,), neighbours.ROUNDS):
        seen = spark.sparkContext.accumulator(0)

        def counted(*args, seen=seen, **kw):
            out = best_of(*args, **kw)
            seen.add(len(out[0]))
            return out

        monkeypatch.setattr(neighbours, "ROUNDS", rounds)
        monkeypatch.setattr(neighbours, "best_of", counted)
        rows = neighbours.nearest(df, lambda c: c % 20 == 0).collect()
        got.append((sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in rows), seen.value))
    assert got[0][0] == got[1][0] and got[1][1] < got[0][1]


def test_a_nearest_list_of_fewer_entries_than_asked_for(spark, monkeypatch):
    monkeypatch.setattr(neighbours.fit, "__defaults__", (neighbours.SAMPLE, 16, neighbours.K))  # lists of some 16 entries, 21 are asked for
    rng = np.random.default_rng(1)
    x = np.concatenate((np.repeat(4 * rng.standard_normal((30, 8)), 50, 0) + rng.standard_normal((1500, 8)), 30 * rng.standard_normal((40, 8))))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict = {}
    for r in neighbours.nearest(df, lambda c: c % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert found.keys() == set(range(0, len(x), 20)) and all(len(v) == 20 for v in found.values())
    true = {q: set(np.argsort(-(x @ x[q]) + (np.arange(len(x)) == q) * 1e9)[:20].tolist()) for q in found}
    assert np.mean([len(found[q] & true[q]) / 20 for q in found]) > 0.85


def test_floats_stay_floats_and_find_the_same(spark):
    x = np.random.default_rng(6).standard_normal((1500, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert neighbours.usable(df).schema["vec"].dataType.simpleString() == "array<float>"
    doubles = df.withColumn("embedding", df.embedding.cast("array<double>"))
    assert neighbours.usable(doubles).schema["vec"].dataType.simpleString() == "array<double>"
    got = [sorted(map(tuple, neighbours.nearest(d, lambda c: c % 20 == 0).collect())) for d in (df, doubles)]
    assert len(got[0]) == 75 * 20 and got[0] == got[1]


def test_a_group_hands_back_the_best_of_all_its_lists():
    rng = np.random.default_rng(7)
    ids, row, col = rng.permutation(60) // 2, rng.integers(0, 5, 400), rng.integers(0, 60, 400)  # an entry is in two lists
    score = np.round(rng.standard_normal((5, 30)), 1)[row, ids[col]]
    r, c, s = neighbours._merged(row, col, score, ids, 4)
    for q in range(5):
        want = sorted({(-x, i) for x, i in zip(score[row == q].tolist(), ids[col[row == q]].tolist())})[:4]
        assert list(zip((-s[r == q]).tolist(), ids[c[r == q]].tolist())) == want


def test_a_query_takes_all_lists_within_the_ratio():
    x = np.random.default_rng(8).standard_normal((4000, 8))
    index = neighbours.build(x, float(np.sqrt((x * x).sum(1).max())), 100)
    for q, lists in zip(x[:50], index.search(x[:50], 1.05, 42)):
        far = np.sqrt(((index.centroids - np.append(q, 0.0)) ** 2).sum(1))
        assert set(np.flatnonzero(far <= 1.05 * far.min() - 1e-9)) <= set(lists.tolist()) and (np.diff(far[lists]) >= -1e-9).all()
        assert index.sizes[lists].sum() >= 42
