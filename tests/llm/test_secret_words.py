"""Word ranks learned from the documents, against plain counts."""

from __future__ import annotations

import random
import re
from collections import Counter

from stayframe.llm import secrets

WORDS = ["zanzibar", "quokka", "marmalade", "teapot", "ox", "lighthouse"]
SECRET = "Vq7#trZp9!Lw"


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


def _texts():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, weights=[9, 7, 5, 5, 3, 1], k=rng.randrange(60))).title() for _ in range(200)]
    return [*texts, None, "", "pwd is zanzibarQuokka", "pwd: marmaladeteapot9", *[f"the pwd is {SECRET} now"] * 300, "\u0130 \u212aelvin " * 9, "x" * 40 + " once"]


def _plain(texts, most):
    counts = Counter()
    for t in texts:
        t = t or ""
        for m in list(secrets.CONTEXT.finditer(t))[::-1]:
            t = t[: m.start(1)] + " " + t[m.end(1) :]
        counts.update(w for w in re.findall("[a-z]+", t.lower()) if 3 <= len(w) <= 24)
    known = {w: n for w, n in counts.items() if n >= secrets.LEAST}
    step = lambda w: known[w] >> max(known[w].bit_length() - 7, 0) << max(known[w].bit_length() - 7, 0)
    top = [w for w in known if sum(step(v) >= step(w) for v in known) <= most]
    ranks = {w: i + 1 for i, w in enumerate(sorted(top, key=lambda w: (-known[w], w)))}
    return ranks | {w: min(i, ranks.get(w, i)) for w, i in secrets.RANK.items()}


def test_ranks_equal_plain_counts(spark):
    texts = _texts()
    for most in (secrets.VOCABULARY, 3, 0):
        assert secrets.learned_ranks(_docs(spark, texts), most) == _plain(texts, most)
    assert secrets.learned_ranks(_docs(spark, texts).limit(0)) == secrets.RANK


def test_findings_equal_the_scan_with_those_ranks(spark):
    texts = _texts()
    ranks = _plain(texts, secrets.VOCABULARY)
    longest = max(map(len, ranks))
    got = {r.doc_id: [tuple(f) for f in r.findings] for r in secrets.scan_secrets(_docs(spark, texts)).collect()}
    assert got == {i: secrets.find_secrets(t or "", ranks=ranks, longest=longest) for i, t in enumerate(texts)}


def test_known_words_are_cheap_and_copied_secrets_are_not(spark):
    texts = _texts()
    at = texts.index("pwd is zanzibarQuokka")
    rows = {r.doc_id: r.findings for r in secrets.scan_secrets(_docs(spark, texts)).collect()}
    assert rows[at] == [] and rows[at + 1] == []
    assert secrets.find_secrets(texts[at]) != []  # by the fixed list alone
    assert sum(any(f.kind == "guess" for f in fs) for fs in rows.values()) == 300


def test_repeated_and_null_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "pin: Zk4$Tq!vBn2", 5, "a"), (1, "pin: Zk4$Tq!vBn2", 5, "a"), (None, None, 6, "b")], "doc_id long, text string, n long, word string")
    rows = sorted((str(r.doc_id), len(r.findings)) for r in secrets.scan_secrets(df).collect())
    assert rows == [("1", 1), ("1", 1), ("None", 0)]
