"""Spelling variants: words one edit apart, by finite-state composition.

``words`` counts the runs of letters of all texts. ``near_pairs`` finds every
pair of words that differ by one inserted, deleted or replaced code point: an
acceptor of the words (deterministic, acyclic, minimised) is composed with a
one-edit transducer and with the acceptor again, and the accepted pairs are
enumerated from each initial state. An initial state is what the acceptor has
reached after the code points that two words share: of a pair whose shorter
word has m code points, the first ``m div 2`` or the last ``m div 2`` are
equal, so each word enters the partitions of its first and of its last half,
once as the shorter and once as the longer word, with what is left of it. A
partition of over ``LARGE`` words is split again by the halves of what is left
of its words; when one code point is left, at most an alphabet's square of them
is there. So no task holds more than a bounded part of the vocabulary, however
many words share a beginning or an end, and no pair is lost: a pair with equal
first halves is taken from there, any other from the last halves (``below``
bounds the length of the common beginning there).

Null or empty text, or one without letters: no words. A null doc_id counts as
empty text in the hash. Repeated rows count as often as they occur. Ties for
the form go to the smallest word in code-point order. Very long runs are words
like any other. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import cut, id_and_text, text_batches

LEAST_LENGTH, LEAST_COUNT, TIMES, DELETE_OF = 6, 5, 5, 199
LARGE, BUCKET, HELD = 10_000, 20_000, 200_000  # words of a partition, words of a task's acceptor, words counted before they are sent on
KEY = ("m", "pre", "suf", "below")
WHOLE = 1 << 30  # no bound on the common beginning


def _counted(batches, shortest: int, one_of: int):
    import pyarrow as pa

    # lower-cased first: what is shorter can't become a word
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % shortest)
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for t, texts in text_batches(batches):
        for doc_id, text in zip(t.column("doc_id").to_pylist(), texts):
            start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(runs.findall(text.lower().decode())).items():  # bytes: A-Z only
                h = zlib.crc32(run.encode(), start)
                if h % one_of == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < shortest:
                        continue
                held[run] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    yield out()


def words(docs: DataFrame, shortest: int = LEAST_LENGTH, least: int = LEAST_COUNT, one_of: int = DELETE_OF) -> DataFrame:
    """word, n (occurrences in all texts, after the deletions that the hash picks) of the words of the vocabulary."""
    counted = id_and_text(docs).mapInArrow(partial(_counted, shortest=shortest, one_of=one_of), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Acceptor:
    """The minimal acyclic acceptor of words added in ascending order; ``initial`` holds the state after each first symbol."""

    def __init__(self, entries):
        self.next: list[dict] = []
        self.final: list[bool] = []
        self.known: dict = {}
        self.initial: dict = {}
        path, last = [({}, False)], ()  # states still open, from the root
        for first, word in entries:
            symbols = (first, *word)
            same = 0
            while same < len(last) and same < len(symbols) and symbols[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path += [({}, False) for _ in symbols[same:]]
            path[-1] = (path[-1][0], True)
            last = symbols
        self._close(path, last, 0)
        self.initial = path[0][0]

    def _close(self, path, last, keep: int) -> None:
        """Give the open states below ``keep`` symbols their numbers; states that accept the same share one."""
        while len(path) > keep + 1:
            arcs, final = path.pop()
            key = (final, tuple(arcs.items()))
            state = self.known.get(key)
            if state is None:
                state = self.known[key] = len(self.next)
                self.next.append(arcs)
                self.final.append(final)
            path[-1][0][last[len(path) - 1]] = state

    def common(self, a: int, b: int, but: str | None = None):
        """The strings that both states accept, without those that start with ``but``."""
        todo = [(a, b, "")]
        while todo:
            a, b, s = todo.pop()
            if self.final[a] and self.final[b]:
                yield s
            x, y = self.next[a], self.next[b]
            if len(y) < len(x):
                x, y = y, x
            for c in x:
                if c in y and (s or c != but):
                    todo.append((x[c], y[c], s + c))

    def one_edit(self, start: int, short: int, below: int):
        """Pairs accepted by acceptor, one-edit transducer and acceptor from one initial state.

        Before the edit both sides read the same symbols, so they are in the
        same state; after it the transducer copies. Replacements are taken of
        words of ``short`` code points, insertions between them and words of
        one more; the common beginning is shorter than ``below``.
        """
        todo = [(start, "")]
        while todo:
            p, s = todo.pop()
            arcs = list(self.next[p].items())
            for k, (c, a) in enumerate(arcs):
                for d, b in arcs[k + 1 :]:
                    for rest in self.common(a, b):
                        if len(s) + 1 + len(rest) == short:
                            yield s + c + rest, s + d + rest
                for rest in self.common(p, a, but=c):  # the inserted symbol is where the two words part
                    yield s + rest, s + c + rest
                if len(s) + 1 < below:
                    todo.append((a, s + c))


def _pairs(key, t):
    import pyarrow as pa

    t = t.sort_by([(c, "ascending") for c in (*KEY, "core")])
    m, pre, suf, below, core, n = (t.column(c).to_pylist() for c in (*KEY, "core", "n"))
    keys = list(zip(m, pre, suf, below))
    made = Acceptor(zip(keys, core))
    count = dict(zip(zip(keys, core), n))
    word, other, n_other = [], [], []
    for k, state in made.initial.items():
        m, pre, suf, below = k
        for a, b in made.one_edit(state, m - len(pre) - len(suf), below):
            u, v = pre + a + suf, pre + b + suf
            word += (u, v)
            other += (v, u)
            n_other += (count[k, b], count[k, a])
    return pa.table({"word": pa.array(word, pa.string()), "other": pa.array(other, pa.string()), "n_other": pa.array(n_other, pa.int64())})


def _halves(rows: DataFrame) -> DataFrame:
    """Each row under the first and under the last half of what is left of the shorter words."""
    left = rows.withColumn("h", F.expr("(m - length(pre) - length(suf)) div 2").cast("int"))
    front = left.selectExpr("m", "concat(pre, left(core, h)) AS pre", "suf", f"IF(below = {WHOLE}, below, below - h) AS below", "substring(core, h + 1) AS core", "n")
    back = left.selectExpr("m", "pre", "concat(right(core, h), suf) AS suf", "least(below, h) AS below", "left(core, length(core) - h) AS core", "n")
    return front.where("below > 0").unionByName(back)


def near_pairs(vocabulary: DataFrame, shortest: int = LEAST_LENGTH, large: int = LARGE, bucket: int = BUCKET) -> DataFrame:
    """word, other, n_other for every two words one edit apart, in both directions."""
    length = F.length("word")
    classes = vocabulary.select(F.explode(F.array(length, length - 1)).alias("m"), F.lit("").alias("pre"), F.lit("").alias("suf"), F.lit(WHOLE).alias("below"), F.col("word").alias("core"), "n")
    rows, found = _halves(classes.where(F.col("m") >= shortest)), None
    while True:
        sizes = rows.groupBy(*KEY).agg(F.count("*").alias("size")).where("size > 1")
        met = cut(rows.join(sizes, list(KEY)))
        splits = (F.col("size") > large) & (F.expr("m - length(pre) - length(suf)") > 1)
        totals = met.agg(F.count_if(splits).alias("more"), F.count_if(~splits).alias("n")).first()
        dealt = met.where(~splits).drop("size").withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(max(1, -(-totals.n // bucket)))))
        pairs = dealt.groupBy("bucket").applyInArrow(_pairs, "word string, other string, n_other long")
        found = pairs if found is None else found.unionByName(pairs)
        if not totals.more:
            return found
        rows = _halves(met.where(splits).drop("size"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word on the way along the forms. Counts grow at each step, so ways are short; each round doubles the step."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = cut(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not now.agg(F.count_if("moved").alias("n")).first().n:
            return now.select("word", "root")
        at = now.drop("moved")


def variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary."""
    vocabulary = cut(words(docs))
    best = F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other").alias("form")))
    near = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = vocabulary.join(near, "word", "left")
    kept = -F.col("best.less") >= times * F.col("n")
    found = cut(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(kept, F.col("best.form")).alias("form"),
            F.when(kept, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The CRC-32 of the contract's hash comes from its polynomial; near words meet in what is left when one code point is deleted.
SPELLING_SQL = f"""
WITH RECURSIVE crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))
), runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{{LEAST_LENGTH},}}')) AS run FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, k, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 | (unicode(c) >> 6))::BIGINT, (128 | (unicode(c) & 63))::BIGINT] END)) AS b FROM runs
), hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc
), said AS (
  SELECT CASE WHEN h % {DELETE_OF} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM said WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}
), cuts AS (
  SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS form_n FROM near GROUP BY word
), found AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {TIMES} * w.n THEN form_n END AS form_n,
    CASE WHEN form_n >= {TIMES} * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.n = best.form_n) END AS form
  FROM words w LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS root FROM found UNION ALL SELECT way.word, f.form FROM way JOIN found f ON f.word = way.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM found JOIN (SELECT way.word, root FROM way JOIN found f ON f.word = way.root WHERE f.form IS NULL) USING (word)
"""
