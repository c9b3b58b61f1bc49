"""Substring dedup with fixed-block anchors.

Every document is a reference cut into non-overlapping blocks of ``block``
words, and a probe with all its rolling windows of as many words. A repeat of
``2 * block`` words or more holds a whole block of the reference, so wherever
a probe meets a block of another document there may be such a repeat: both
documents extend the hit to all windows of the full length around it, and the
extended windows are matched exactly, which leaves the maximal repeats. A
window that starts in a document with a smaller doc_id is removed; all are
judged on the input.

No pairs of documents are formed. Probes and blocks travel as packed bytes,
one row per batch of documents and bucket of hashes, about five bytes a word;
a bucket holds the same amount of text at every input size, as their number
follows the input's bytes. A hot passage adds one entry per document to its
buckets. Block tags may collide (about once in 10^5), which only costs extra
windows; full windows are told apart by 64 bits within a bucket.

Batches are made from the rows in the order of their partition, so ``docs``
must be read from files (or be a checkpoint), as the query and the pipeline
do; then a recomputed task makes the same batches.

Null text: no words. A null doc_id counts as larger than any other; equal
doc_ids are not smaller than each other, and a repeat within one document
stays. Every row gives a row. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import Words, id_and_text, text_batches

WINDOW = 50
LAST = (1 << 63) - 1  # stands for a null doc_id
BUCKET_TEXT = 1 << 20
PACKED = "bucket int, batch long, tags binary, docs binary, ids binary"


def _ids(t) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(t.column("doc_id"), LAST).to_numpy().astype(np.int64)


def _narrow(values: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of unsigned integers, one row each."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def _wide(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _binary(values: np.ndarray, cuts: np.ndarray):
    """Arrow binary array of the rows of a byte matrix, cut at the given places."""
    import pyarrow as pa

    offsets = (cuts * values.shape[1]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())


def _packed(batch: int, buckets: int, bucket: np.ndarray, columns: list[np.ndarray], ids: bytes):
    """One row per bucket, and one with the batch's document ids, in a bucket of its own."""
    import pyarrow as pa

    order = np.argsort(bucket.astype(np.uint32), kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    cuts = np.append(first, len(order))
    n = len(names)
    rows = pa.RecordBatch.from_arrays(
        [pa.array(names.astype(np.int32)), pa.array(np.full(n, batch), pa.int64()), *[_binary(c[order], cuts) for c in columns], pa.nulls(n, pa.binary())],
        ["bucket", "batch", "tags", "docs", "ids"],
    )
    head = pa.RecordBatch.from_arrays(
        [pa.array([buckets + batch % buckets], pa.int32()), pa.array([batch], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([ids], pa.binary())],
        ["bucket", "batch", "tags", "docs", "ids"],
    )
    return [rows, head]


def _batch_ids():
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    while True:
        yield (part << 24) + n
        n += 1


def _probes(batches, block: int, bits: int):
    """Blocks and rolling windows of a batch: 3 bytes of the hash, 2 of the document, with a mark on blocks."""
    numbers = _batch_ids()
    for t, texts in text_batches(batches):
        words = Words(texts)
        at, key = words.windows(block)
        doc = words.doc[at].astype(np.uint64)
        anchor = ((at - words.first[words.doc[at]]) % block == 0).astype(np.uint64)
        bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
        yield from _packed(next(numbers), 1 << bits, bucket, [_narrow(key, 3), _narrow(doc | anchor << np.uint64(15), 2)], _ids(t).tobytes())


def _met(key, rows, bits: int):
    """Of a bucket's entries those whose tag is a block of one document and occurs in another."""
    import pyarrow as pa

    bucket = key[0].as_py()
    if bucket >= 1 << bits:
        return pa.table([rows.column("batch"), pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.binary()), rows.column("ids")], ["batch", "tags", "docs", "ids"])
    batch = rows.column("batch").to_pylist()
    tags = [_wide(x, 3) for x in rows.column("tags").to_pylist()]
    docs = [_wide(x, 2) for x in rows.column("docs").to_pylist()]
    row = np.repeat(np.arange(len(batch)), [len(x) for x in tags])
    tag, doc = np.concatenate(tags), np.concatenate(docs)
    who = row.astype(np.int64) << 16 | (doc & np.uint64(0x7FFF)).astype(np.int64)
    order = np.argsort(tag, kind="stable")
    tag, who, row, doc = tag[order], who[order], row[order], doc[order]
    first = np.flatnonzero(np.concatenate(([True], tag[1:] != tag[:-1])))
    size = np.diff(np.append(first, len(tag)))
    # rows stay in order, so a tag's first and last entries tell whether several documents have it
    several = who[first] != who[first + size - 1]
    anchored = np.bitwise_or.reduceat(doc, first) >> np.uint64(15) > 0
    keep = np.repeat(several & anchored, size)
    tag, doc, row = tag[keep], doc[keep] & np.uint64(0x7FFF), row[keep]
    order = np.argsort(row, kind="stable")
    cuts = np.searchsorted(row[order], np.arange(len(batch) + 1))
    some = np.flatnonzero(np.diff(cuts))
    full = tag[order] | np.uint64(bucket) << np.uint64(24)
    return pa.table(
        [
            pa.array([batch[i] for i in some], pa.int64()),
            pa.array([full[cuts[i] : cuts[i + 1]].astype("<u8").tobytes() for i in some], pa.binary()),
            pa.array([doc[order][cuts[i] : cuts[i + 1]].astype("<u2").tobytes() for i in some], pa.binary()),
            pa.nulls(len(some), pa.binary()),
        ],
        ["batch", "tags", "docs", "ids"],
    )


def _by_document(key, rows):
    """A batch's entries given back to its documents: one row per document with its distinct tags."""
    import pyarrow as pa

    ids = next((x for x in rows.column("ids").to_pylist() if x is not None), b"")
    tags = [np.frombuffer(x, "<u8") for x in rows.column("tags").to_pylist() if x is not None]
    docs = [np.frombuffer(x, "<u2") for x in rows.column("docs").to_pylist() if x is not None]
    out_id, out = [], []
    if tags:
        tag, doc, ids = np.concatenate(tags), np.concatenate(docs), np.frombuffer(ids, np.int64)
        order = np.lexsort((tag, doc))
        tag, doc = tag[order], doc[order]
        new = np.concatenate(([True], (tag[1:] != tag[:-1]) | (doc[1:] != doc[:-1])))
        tag, doc = tag[new], doc[new]
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        for a, b in zip(first, np.append(first[1:], len(doc))):
            out_id.append(int(ids[doc[a]]))
            out.append(tag[a:b].tobytes())
    return pa.table([pa.array(out_id, pa.int64()), pa.array(out, pa.binary())], ["key_id", "tags"])


def _extended(batches, block: int, window: int, bits: int):
    """Full windows around the hits of documents: 8 bytes of the hash, the document's id and its place in the batch."""
    numbers = _batch_ids()
    tag_of = lambda h: (h >> np.uint64(64 - bits)) << np.uint64(24) | h & np.uint64(0xFFFFFF)
    for t, texts in text_batches(batches):
        words, hits = Words(texts), t.column("tags").to_pylist()
        at, key = words.windows(block)
        tag, doc = tag_of(key), words.doc[at]
        known = [np.unique(np.frombuffer(b"".join(x), "<u8")) if x else np.zeros(0, np.uint64) for x in hits]
        hit = np.zeros(len(words.hash) + 1, np.int64)
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        for d, ks in enumerate(known):
            if len(ks):
                part = tag[edges[d] : edges[d + 1]]
                found = ks[np.minimum(np.searchsorted(ks, part), len(ks) - 1)] == part
                hit[at[edges[d] : edges[d + 1]][found] + 1] = 1
        upto = np.cumsum(hit)
        full, code = words.windows(window)
        near = upto[full + window - block + 1] > upto[full]  # a hit starts inside and ends inside
        full, code = full[near], code[near]
        ids = _ids(t)
        bucket = (code >> np.uint64(64 - bits)).astype(np.int64)
        yield from _packed(
            next(numbers), 1 << bits, bucket, [np.concatenate((_narrow(code, 8), _narrow(ids[words.doc[full]].view(np.uint64), 8)), 1), _narrow(words.doc[full], 2)], ids.tobytes()
        )


def _earlier(key, rows, bits: int):
    """Of a bucket's windows those that a document with a smaller id has too."""
    import pyarrow as pa

    if key[0].as_py() >= 1 << bits:
        return pa.table([rows.column("batch"), pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.binary()), rows.column("ids")], ["batch", "tags", "docs", "ids"])
    batch = rows.column("batch").to_pylist()
    both = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in rows.column("tags").to_pylist()]
    docs = [_wide(x, 2) for x in rows.column("docs").to_pylist()]
    row = np.repeat(np.arange(len(batch)), [len(x) for x in both])
    code, owner = np.concatenate(both).T
    owner, doc = owner.view(np.int64) if owner.flags.c_contiguous else np.ascontiguousarray(owner).view(np.int64), np.concatenate(docs)
    code = np.ascontiguousarray(code)
    order = np.lexsort((owner, code))
    new = np.concatenate(([True], code[order][1:] != code[order][:-1]))
    least = np.empty(len(code), np.int64)
    least[order] = owner[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    gone = least < owner
    code, doc, row = code[gone], doc[gone], row[gone]
    cuts = np.searchsorted(row, np.arange(len(batch) + 1))  # rows are still in order
    some = np.flatnonzero(np.diff(cuts))
    return pa.table(
        [
            pa.array([batch[i] for i in some], pa.int64()),
            pa.array([code[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
            pa.array([doc[cuts[i] : cuts[i + 1]].astype("<u2").tobytes() for i in some], pa.binary()),
            pa.nulls(len(some), pa.binary()),
        ],
        ["batch", "tags", "docs", "ids"],
    )


def _kept(batches, window: int):
    import pyarrow as pa

    for t, texts in text_batches(batches):
        words, gone = Words(texts), t.column("tags").to_pylist()
        full, code = words.windows(window)
        edges = np.searchsorted(words.doc[full], np.arange(len(texts) + 1))
        cover = np.zeros(len(words.hash) + 1, np.int64)
        for d, raw in enumerate(gone):
            if raw:
                ks = np.unique(np.frombuffer(b"".join(raw), "<u8"))
                part = code[edges[d] : edges[d + 1]]
                found = full[edges[d] : edges[d + 1]][ks[np.minimum(np.searchsorted(ks, part), len(ks) - 1)] == part]
                np.add.at(cover, found, 1)
                np.add.at(cover, found + window, -1)
        stay = np.cumsum(cover)[:-1] == 0
        kept = []
        for d in range(len(texts)):
            a, b = words.first[d], words.first[d + 1]
            if stay[a:b].all():
                kept.append(b" ".join(texts[d].split()))
            else:
                kept.append(b" ".join([words.data[s:e] for s, e in zip(words.start[a:b][stay[a:b]].tolist(), words.end[a:b][stay[a:b]].tolist())]))
        left = np.array([int(stay[words.first[d] : words.first[d + 1]].sum()) for d in range(len(texts))], np.int64)
        yield pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks(), pa.array(words.count.astype(np.int64)), pa.array(words.count - left, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def _regrouped(packed: DataFrame, judge, bits: int) -> DataFrame:
    """Packed entries judged bucket by bucket, then given back to the documents of each batch."""
    judged = packed.groupBy("bucket").applyInArrow(lambda key, rows: judge(key, rows, bits), "batch long, tags binary, docs binary, ids binary")
    mine = judged.groupBy("batch").applyInArrow(_by_document, "key_id long, tags binary")
    return mine.groupBy("key_id").agg(F.collect_list("tags").alias("tags"))  # one entry per row with that id


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words left, joined by spaces) of every row."""
    block = window // 2
    texts = id_and_text(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(6, (size // BUCKET_TEXT).bit_length()))
    keyed = texts.withColumn("key_id", F.coalesce("doc_id", F.lit(LAST)))

    hits = _regrouped(texts.mapInArrow(partial(_probes, block=block, bits=bits), PACKED), _met, bits)
    # only documents with hits go on; their texts meet the hits by id
    around = keyed.join(hits, "key_id").select("doc_id", "text", "tags")
    packed = around.mapInArrow(partial(_extended, block=block, window=window, bits=bits), PACKED)
    gone = _regrouped(packed, _earlier, bits)
    return keyed.join(gone, "key_id", "left").select("doc_id", "text", "tags").mapInArrow(partial(_kept, window=window), "doc_id long, n_words long, n_removed long, kept string")


def kept_digests(found: DataFrame) -> DataFrame:
    """Contract columns of ``op1_substrings``."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute(rows: list[tuple[int, str]], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """The same by a dictionary of all windows, for tests."""
    words = {d: (t or "").encode().split() for d, t in rows}
    least: dict[tuple, int] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            least.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, ws in words.items():
        gone = set()
        for i in range(len(ws) - window + 1):
            if least[tuple(ws[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out[d] = (len(ws), len(gone), hashlib.sha256(kept).hexdigest())
    return out


# DuckDB twin: all windows as text.
SUBSTRINGS_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5_number(array_to_string(ws[i:i+49], ' ')) AS k FROM p),
m AS (SELECT k, min(doc_id) AS least FROM h GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM h JOIN m USING (k) WHERE least < doc_id),
gone AS (SELECT doc_id, count(*) AS n_removed FROM g GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM words ANTI JOIN g USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
