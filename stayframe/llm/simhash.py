"""SimHash near-duplicates by an inverted index over positional bytes.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ
in at most two bits share at least six of them, so of the four position pairs
(0,1) (2,3) (4,5) (6,7) at least two are untouched: the index holds every
distinct fingerprint under the bytes of each of the six unions of two pairs.
Pairs that meet there are tallied by shared positional bytes, those with at
least six go on to the exact bit count.

An index list longer than ``MAX_LIST`` is not paired: its fingerprints are
listed again under themselves and each one-bit change of the bits the list
leaves free. Two of them share such a value exactly if they differ in at most
two bits, so linking each value's fingerprints to the least of them loses no
link and emits a number of rows linear in the list.

Copies collapse before the index: it holds distinct fingerprints. Components
are found by alternating large-star and small-star rounds over the links.

Null text: no words, fingerprint zero; zero links like any other value. Rows
with a null doc_id get a fingerprint and, as a component's id, the least
non-null doc_id that they reach. Repeated rows are repeated in the result. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import cut, id_and_text

SHINGLE, MAX_BITS, MAX_LIST, MIN_BYTES = 3, 2, 64, 6
PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text's lower-cased word shingles, repeats included."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and white space is bytes 9-13 and 32
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    h64, total, votes = xxhash.xxh64_intdigest, len(words) - shingle + 1, np.zeros(64, np.int64)
    for at in range(0, total, 1 << 15):  # a block at a time, so that a long text needs no more memory
        block = words[at : at + (1 << 15) + shingle - 1]
        grams = zip(*(block[k:] for k in range(shingle)))
        h = np.fromiter((h64(b" ".join(g), 42) for g in grams), np.uint64, len(block) - shingle + 1)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * votes > total).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches, shingle: int):
    import pyarrow as pa

    for b in batches:
        texts = b.column(1).cast(pa.large_binary())
        fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64), pa.int64())], ["doc_id", "sig", "fp"])


def signed(docs: DataFrame) -> Column:
    """A hash of the text that tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, sig (hash of the text), fp (the 64 bits as a long) of every row."""
    return id_and_text(docs, signed(docs).alias("sig")).mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, sig long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shared_bytes(a: Column, b: Column) -> Column:
    x = a.bitwiseXOR(b)
    return sum(F.when(F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0) for k in range(8))


def links(fps: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """Links (u, v), u < v, between distinct fingerprints at most two bits apart; they reach whatever is in reach."""
    masks = [_signed(sum(0xFFFF << (16 * p) for p in pair)) for pair in PAIRS]
    index = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("list", "key"))
    sizes = index.groupBy("list", "key").agg(F.count("*").alias("n")).where("n > 1")
    listed = index.join(sizes, ["list", "key"])
    short, long = listed.where(F.col("n") <= max_list), listed.where(F.col("n") > max_list)

    pairs = short.groupBy("list", "key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))  # max_list entries at most
    pairs = pairs.select(F.posexplode("fps").alias("k", "u"), "fps").select("u", F.explode(F.slice("fps", F.col("k") + 2, F.size("fps"))).alias("v"))
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    pairs = pairs.where(shared_bytes(F.col("u"), F.col("v")) >= MIN_BYTES).where(apart <= MAX_BITS)

    free = [[_signed(1 << b) for b in range(64) if not (masks[k] >> b) & 1] for k in range(len(masks))]
    bits = F.element_at(F.array(*[F.array(*[F.lit(x).cast("long") for x in f]) for f in free]), F.col("list") + 1)
    near = F.array_append(F.transform(bits, lambda x: F.col("fp").bitwiseXOR(x)), F.col("fp"))
    changed = long.select("fp", F.explode(near).alias("value"))
    least = changed.groupBy("value").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = changed.join(least, "value").where("u < fp").select("u", F.col("fp").alias("v"))
    return pairs.select("u", "v").unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (least node in reach) of every node that has a link."""
    edges = cut(edges.select("u", "v"))
    mark = None
    while True:
        # large star: a node's greater neighbours point to the least node around it
        both = edges.select(F.inline(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select("b", "m").distinct()
        # small star: a node and its lesser neighbours point to the least of them
        least = large.groupBy("b").agg(F.min("m").alias("low"))
        small = large.join(least, "b").select("low", F.explode(F.array("b", "m")).alias("node")).where("low < node")
        edges = cut(small.select(F.col("low").alias("u"), F.col("node").alias("v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        mark = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_list: int = MAX_LIST) -> DataFrame:
    """doc_id, sig, fp, root (least fingerprint in reach) and component_id (smallest doc_id in reach) of every row."""
    fps = cut(fingerprints(docs, shingle))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = components(links(distinct.select("fp"), max_list))
    reach = distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = reach.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(reach.join(least, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "sig", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The documents with one row of each component left."""
    return first_of_each(docs, near_duplicates(docs, shingle))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of each root of ``found`` the row of its smallest doc_id (of equal ids, of the least text hash)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sig"))
    stay = found.groupBy("root").agg(first.alias("k")).select(F.col("k.doc_id").alias("_stay_id"), F.col("k.sig").alias("_stay_sig"))
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("id"), signed(docs).alias("sig"))
    kept = packed.join(stay, F.col("id").eqNullSafe(F.col("_stay_id")) & (F.col("sig") == F.col("_stay_sig")), "left_semi")
    return kept.dropDuplicates(["id", "sig"]).select("row.*")


def fingerprint_digests(found: DataFrame) -> DataFrame:
    """Contract columns of ``op9_simhash``."""
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
