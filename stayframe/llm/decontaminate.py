"""Benchmark decontamination with spaced seeds, in DataFrame expressions only.

Training words meet test words on hashes of spaced groups of words. Around
each meeting the item is laid over the document at the same shift; it is a
leak if in some stretch of ``STRETCH`` words (the whole item, if shorter) at
least four fifths of the words are equal. Items of under 5 words are no
evidence and are not looked up.

There are two sets of seeds. ``whole_seeds`` misses nothing that the overlay
accepts: a stretch that may have u other words is cut into more than u groups,
and a seed is kept for every choice of as many groups as must be untouched; it
needs only those words inside the document. ``twin_seeds`` are those of the
SQL twin: a window of twelve words has three groups of four, of which two must
be equal, and items of 5 to 11 words are looked up whole.

All windows stay inside one generated loop over the scan when the seed table
is small enough to broadcast (its rows, and the bytes of the items, are
counted first); beyond those bounds Spark shuffles both sides instead. The
loop ends in a hash table of the distinct places (item, shift and only the
words there): a place is met by hundreds of seeds, and rows handed on would
all be held, each with its document's words, until the document ends.

Words are runs of other than bytes 9-13 and 32, lower-cased. Null text: no
words. Null or empty items are never found. A null doc_id or item_id is
reported as null. Repeated rows and ties give one row per doc_id and item_id.
An empty table on either side gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import id_and_text

GROUP, SPAN, STRETCH, SHORTEST = 4, 12, 16, 5
BROADCAST_SEEDS, BROADCAST_ITEM_BYTES = 500_000, 16 << 20
# Fixed masks: the groups of a window that each keeps.
MASKS = [(0, 1), (0, 2), (1, 2)]
# For items of so many words at least: words in a group, groups, and how many of them n // 5 other words leave untouched.
CUTS = {15: (3, 5, 2), 12: (3, 4, 2), 10: (2, 5, 3), 9: (3, 3, 2), 8: (2, 4, 3), 6: (2, 3, 2), 5: (1, 5, 4)}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _trimmed_words(text: Column) -> Column:
    """The same without a lambda, so that it stays in generated code: white space is trimmed first."""
    return F.split(F.btrim(F.lower(text), F.lit("\t\n\x0b\x0c\r ")), r"[\x20\x09-\x0D]+")


def twin_seeds(n: int) -> list[tuple]:
    """(words needed from the first on, groups (offset, length)) of the seeds for items of n words, as in the SQL twin."""
    return [(SPAN, tuple((GROUP * g, GROUP) for g in mask)) for mask in MASKS] if n >= SPAN else [(n, ((0, n),))]


def whole_seeds(n: int) -> list[tuple]:
    """The same for every place that the overlay accepts; offsets count from the first kept word."""
    size, groups, kept = next(c for least, c in CUTS.items() if n >= least)
    return [(size * (c[-1] - c[0] + 1), tuple((size * (g - c[0]), size) for g in c)) for c in combinations(range(groups), kept)]


def _keys(places: DataFrame, seeds: list[tuple], *keep: str) -> DataFrame:
    """(keep, mask, key): hashes of the seeds at word ``at``; null where the text ends too soon."""
    word = lambda k: F.get(F.col("words"), F.col("at") + k)
    runs = {g: f"g{i}" for i, g in enumerate(dict.fromkeys(g for _, groups in seeds for g in groups))}
    hashed = [F.xxhash64(*[word(k) for k in range(at, at + n)]).alias(name) for (at, n), name in runs.items()]
    keys = [F.when(F.col("at") + span <= F.size("words"), F.xxhash64(F.lit(m), *[F.col(runs[g]) for g in groups])) for m, (span, groups) in enumerate(seeds)]
    return places.select(*keep, "words", "at", *hashed).select(*keep, "words", "at", F.posexplode(F.array(*keys)).alias("mask", "key"))


def leaks(docs: DataFrame, benchmark: DataFrame, seeds_of=twin_seeds) -> DataFrame:
    """doc_id, item_id, n_equal, n_words (of the item), doc_start: leaks of benchmark items in documents."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
        .groupBy("words")
        .agg(F.array_sort(F.collect_set(F.struct("item_id"))).alias("same"))
        .where(F.size("words") >= SHORTEST)
        .withColumn("uid", F.xxhash64("words"))
    )
    length = F.least(F.size("words"), F.lit(STRETCH))
    uses = {r.n: seeds_of(r.n) for r in items.select(length.alias("n")).distinct().orderBy("n").collect()} or {STRETCH: seeds_of(STRETCH)}  # 12 values at most
    kinds = list(dict.fromkeys(seed for n in uses for seed in uses[n]))
    starts = items.select("words", "uid", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at"))
    used = reduce(lambda a, b: a | b, [(length == n) & F.col("mask").isin([kinds.index(x) for x in uses[n]]) for n in uses])
    seeds = _keys(starts, kinds, "uid").where("key IS NOT NULL").where(used).select("key", "uid", F.col("at").alias("item_at"), F.size("words").alias("n_words"))
    texts_of = items.select("uid", F.col("words").alias("item"), "same")
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    if (items.agg(F.sum(F.length(F.array_join("words", " ")) + 20 * F.size("same"))).first()[0] or 0) <= BROADCAST_ITEM_BYTES:
        texts_of = F.broadcast(texts_of)

    first = min(span for span, _ in kinds)
    texts = id_and_text(docs).select("doc_id", _trimmed_words(F.coalesce("text", F.lit(""))).alias("words"))
    starts = F.when(F.size("words") >= first, F.sequence(F.lit(0), F.size("words") - first))
    probes = _keys(texts.select("doc_id", "words", F.explode(starts).alias("at")), kinds, "doc_id")
    shift = F.col("at") - F.col("item_at")
    there = F.slice("words", F.greatest(shift, F.lit(0)) + 1, F.col("n_words") + F.least(shift, F.lit(0)))
    places = probes.join(seeds, "key").select("doc_id", "uid", "n_words", shift.alias("shift"), there.alias("there")).distinct()
    hits = places.join(texts_of, "uid")
    # Words of the item before the document's first are equal to none. The comparison is generated from hits, as a plain filter would move into the join.
    equal = F.transform("item", lambda w, j: F.coalesce(F.get("there", j + F.least("shift", F.lit(0))) == w, F.lit(False)).cast("int"))
    laid = hits.select("doc_id", "same", "shift", "n_words", F.explode(F.array(equal)).alias("equal"))
    stretch = F.least(F.lit(STRETCH), F.col("n_words"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("n_words") - stretch + 1), lambda s: total(F.slice("equal", s, stretch))))
    found = laid.where(best * 5 >= stretch * 4).select("doc_id", F.explode("same.item_id").alias("item_id"), "shift", "n_words", total(F.col("equal")).alias("n_equal"))
    top = found.groupBy("doc_id", "item_id").agg(
        F.max("n_equal").cast("long").alias("n_equal"), F.max("n_words").cast("long").alias("n_words"), F.min(F.greatest(F.col("shift"), F.lit(0))).cast("long").alias("doc_start")
    )
    return top


def without_leaks(docs: DataFrame, benchmark: DataFrame, seeds_of=twin_seeds) -> DataFrame:
    """The documents that hold no leak, with all their columns; a null doc_id is never dropped."""
    bad = leaks(docs, benchmark, seeds_of).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(bad, F.col("doc_id").cast("long") == F.col("leaked_id"), "left_anti")


# DuckDB twin: the same masks as text keys.
LEAKS_SQL = """
WITH it AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
items AS (SELECT DISTINCT item_id, w, len(w) AS n FROM it WHERE len(w) >= 5),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
dw AS (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM d WHERE len(w) >= 5),
iw AS (SELECT item_id, w, n, unnest(range(0, n)) AS p FROM items),
lens AS (SELECT DISTINCT n FROM items WHERE n < 12),
dk AS (
  SELECT doc_id, w, p, 'a' || array_to_string(w[p+1:p+8], ' ') AS k FROM dw WHERE p + 12 <= len(w)
  UNION ALL SELECT doc_id, w, p, 'b' || array_to_string(w[p+1:p+4] || w[p+9:p+12], ' ') FROM dw WHERE p + 12 <= len(w)
  UNION ALL SELECT doc_id, w, p, 'c' || array_to_string(w[p+5:p+12], ' ') FROM dw WHERE p + 12 <= len(w)
  UNION ALL SELECT doc_id, w, p, 's' || array_to_string(w[p+1:p+n], ' ') FROM dw, lens WHERE p + n <= len(w)),
ik AS (
  SELECT item_id, w, n, p, 'a' || array_to_string(w[p+1:p+8], ' ') AS k FROM iw WHERE p + 12 <= n
  UNION ALL SELECT item_id, w, n, p, 'b' || array_to_string(w[p+1:p+4] || w[p+9:p+12], ' ') FROM iw WHERE p + 12 <= n
  UNION ALL SELECT item_id, w, n, p, 'c' || array_to_string(w[p+5:p+12], ' ') FROM iw WHERE p + 12 <= n
  UNION ALL SELECT item_id, w, n, p, 's' || array_to_string(w, ' ') FROM iw WHERE p = 0 AND n < 12),
h AS (
  SELECT DISTINCT doc_id, item_id, dk.w AS dw, ik.w AS iw, n, dk.p - ik.p AS shift FROM dk JOIN ik USING (k)),
e AS (
  SELECT doc_id, item_id, n, shift,
    list_transform(range(0, n), lambda j: CASE WHEN shift + j >= 0 AND dw[shift + j + 1] = iw[j + 1] THEN 1 ELSE 0 END) AS eq FROM h),
v AS (
  SELECT *, list_max(list_transform(range(0, n - least(16, n) + 1), lambda s: list_sum(eq[s+1:s+least(16, n)]))) AS best FROM e)
SELECT doc_id, item_id, CAST(max(list_sum(eq)) AS BIGINT) AS n_equal, max(n) AS n_words, min(greatest(shift, 0)) AS doc_start
FROM v WHERE best * 5 >= least(16, n) * 4 GROUP BY doc_id, item_id
"""
