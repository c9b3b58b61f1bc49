"""Token ids of documents in binary files: ranks in a byte-aligned variable-length code.

``write_token_files`` tokenises every text once, ranks the ids by how often
they occur (ties to the smaller id) and writes each document's ranks in
ascending doc_id order. A rank takes one to four data bytes; how many stands in
two bits of a separate control byte, one control byte for four ranks, so
``decode`` finds all lengths of a block by one look-up in a table of 256 rows.

Layout of a file: blocks, each followed by a line end (Spark's own text writer
writes them, so its commit protocol covers retried and lost tasks on any file
system). A block, little-endian: ``SVTB``, documents (u32), place in the order
(u64: range partition << 32 | block), ids, control bytes, data bytes (u64 each);
doc_id (i64 each), null marks (u8 each), ids (u64 each); control bytes; data
bytes; CRC-32 of all before. A document's control bytes start anew, and the
unused slots of its last one have no data. ``ranks`` beside the files holds the
id of each rank (at most one row for each id of the vocabulary).

Null or empty text: the closing id alone. A null doc_id comes first in the
order and stays null. Rows of one doc_id stand in the order of their length,
then of a hash of their ids; rows repeated whole are written as often as they
occur. An empty table gives no block and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from functools import partial

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm.common import cut, id_and_text, text_batches
from stayframe.llm.tokens import CLOSING_ID, encoder, release, trim
from stayframe.operators.ordering import global_prefix
from stayframe.session import remove_scratch, scratch_path

MAGIC, HEAD = b"SVTB", struct.Struct("<4sIQQQQ")
FILE_BLOCKS, SMALL_PART, LARGE_PART = 16, 8 << 20, 128 << 20  # blocks, bytes of code
WORDS = 500_000  # that a worker remembers
STRETCH = 1 << 18  # ids of a block, unless one document has more
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # of the four ranks of each control byte


def encode(ranks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of documents whose ranks are ranks[first[k]:first[k + 1]], and where each one's begin."""
    n = np.diff(first)
    slots = -(-n // 4) * 4
    slot_first = np.concatenate(([0], np.cumsum(slots)))
    code = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(slot_first[-1], np.uint8)
    padded[np.arange(len(ranks)) + np.repeat(slot_first[:-1] - first[:-1], n)] = code
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    upto = np.concatenate(([0], np.cumsum(code.astype(np.int64) + 1)))
    return control, data, slot_first // 4, upto[first]


def decode(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ranks of documents of ``n`` ids each, all in a row."""
    slots = -(-n // 4) * 4
    used = np.ones(int(slots.sum()), bool)
    last = np.cumsum(slots)
    for k in (1, 2, 3):  # unused slots at a document's end
        used[(last - k)[slots - n >= k]] = False
    length = _LENGTHS[control].ravel()[used]
    at = np.cumsum(length) - length
    data = np.concatenate((data, np.zeros(3, np.uint8)))
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(length > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_block(order: int, doc_ids: list, n: np.ndarray, control: bytes, data: bytes) -> bytes:
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes()
    nulls = bytes(i is None for i in doc_ids)
    head = HEAD.pack(MAGIC, len(doc_ids), order, int(n.sum()), len(control), len(data))
    block = b"".join((head, ids, nulls, n.astype("<u8").tobytes(), control, data))
    return block + struct.pack("<I", zlib.crc32(block))


def blocks_of(content: memoryview):
    """(order, total ids, size and place of the block) of each block of a file."""
    at = 0
    while at < len(content):
        magic, docs, order, total, control, data = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        yield docs, order, total, control, data, at
        at += HEAD.size + 17 * docs + control + data + 5  # with the CRC and the line end


def unpack_block(content: memoryview, docs: int, control: int, data: int, at: int):
    """doc_id, null mark and number of ids of each document of a block, and all ranks."""
    end = at + HEAD.size + 17 * docs + control + data
    if struct.unpack_from("<I", content, end)[0] != zlib.crc32(content[at:end]):
        raise ValueError("a block of token ids is damaged")
    at += HEAD.size
    ids = np.frombuffer(content, "<i8", docs, at)
    nulls = np.frombuffer(content, np.uint8, docs, at + 8 * docs).astype(bool)
    n = np.frombuffer(content, "<u8", docs, at + 9 * docs).astype(np.int64)
    at += 17 * docs
    return ids, nulls, n, decode(np.frombuffer(content, np.uint8, control, at), np.frombuffer(content, np.uint8, data, at + control), n)


def _tokenised(batches, path: str, closing: int):
    import pyarrow as pa

    encode_texts = encoder(path, WORDS)
    for t, texts in text_batches(batches, limit=2 << 20):
        ids, first = encode_texts(texts, closing)
        wide = ids.max(initial=0) >= 1 << 16
        raw = memoryview(ids.astype("<u4" if wide else "<u2").tobytes())
        size = 4 if wide else 2
        parts = [raw[a:b] for a, b in zip((size * first[:-1]).tolist(), (size * first[1:]).tolist())]
        yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array(np.diff(first)), pa.array(parts, pa.binary())], ["doc_id", "n_tokens", "ids"])
    trim()  # the worker lives on


def _flat(batches):
    """Stored rows (two or four bytes an id) a stretch of at most about ``STRETCH`` ids at a time: the rows, all ids in a row, where each row's begin."""
    release()
    for batch in batches:
        upto = np.cumsum(batch.column("n_tokens").to_numpy())
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STRETCH, side="right")))
            rows = batch.slice(at, to - at)
            n = rows.column("n_tokens").to_numpy()
            parts = [np.frombuffer(r.as_buffer(), "<u2" if len(r.as_buffer()) == 2 * k else "<u4") for r, k in zip(rows.column("ids"), n.tolist())]
            yield rows, np.concatenate([x.astype(np.uint32) for x in parts]), np.concatenate(([0], np.cumsum(n)))
            at = to


def _counted(batches):
    import pyarrow as pa

    total = np.zeros(0, np.int64)
    for _, ids, _ in _flat(batches):
        now = np.bincount(ids, minlength=len(total))
        now[: len(total)] += total
        total = now
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def _blocks(batches, rank):
    import pyarrow as pa

    part = TaskContext.get().partitionId()
    for number, (rows, ids, first) in enumerate(_flat(batches)):
        control, data, *_ = encode(rank.value[ids], first)
        block = pack_block(part << 32 | number, rows.column("doc_id").to_pylist(), np.diff(first), control.tobytes(), data.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["block"])


def _rows(batches, id_of, with_ids: bool):
    import pyarrow as pa

    release()
    for b in batches:
        for content in b.column("content"):
            content = memoryview(content.as_buffer())
            for docs, order, _, control, data, at in blocks_of(content):
                doc_id, null, n, ranks = unpack_block(content, docs, control, data, at)
                ids = id_of.value[ranks].astype("<u4")
                first = np.concatenate(([0], np.cumsum(n)))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[a:z]) for a, z in zip((4 * first[:-1]).tolist(), (4 * first[1:]).tolist())]
                cols = [pa.array(doc_id, mask=null), pa.array(np.full(docs, order, np.int64)), pa.array(first[:-1]), pa.array(n), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "block", "at", "n_tokens", "ids_crc32", "ids"][: len(cols)])


def _heads(batches):
    import pyarrow as pa

    for b in batches:
        for content in b.column("content"):
            found = [(order, total) for _, order, total, *_ in blocks_of(memoryview(content.as_buffer()))]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*found)] if found else [pa.array([], pa.int64())] * 2, ["block", "total"])


def write_token_files(docs: DataFrame, folder: str, path: str, closing: int = CLOSING_ID) -> None:
    """Write ``folder``/files and ``folder``/ranks."""
    spark = docs.sparkSession
    kept = scratch_path(spark, "token-ids")
    tokenised = id_and_text(docs).mapInArrow(partial(_tokenised, path=path, closing=closing), "doc_id long, n_tokens long, ids binary")
    tokenised.write.option("compression", "zstd").parquet(kept)
    tokenised = spark.read.parquet(kept)
    counts = tokenised.select("n_tokens", "ids").mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary at most
    counts.sort(key=lambda r: (-r.n, r.id))
    spark.createDataFrame([(k, r.id) for k, r in enumerate(counts)], "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    rank = np.zeros(max((r.id for r in counts), default=0) + 1, np.uint32)
    rank[[r.id for r in counts]] = np.arange(len(counts))
    size = sum((1.25 + (k >= 1 << 8) + (k >= 1 << 16)) * r.n for k, r in enumerate(counts))
    parts = max(1, -(-int(size) // LARGE_PART), min(-(-int(size) // SMALL_PART), 2 * spark.sparkContext.defaultParallelism))
    # Ids cross the shuffle before they are coded, so that the sampling of the ranges runs no Python.
    rows = tokenised.withColumn("hash", F.xxhash64("ids")).withColumn("row", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens").asc(), F.col("hash").asc(), F.col("row").asc()]  # the row's number parts rows repeated whole
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("hash", "row")
    blocks = ordered.mapInArrow(partial(_blocks, rank=spark.sparkContext.broadcast(rank)), "block binary")
    blocks.select(F.col("block").cast("string")).write.option("maxRecordsPerFile", FILE_BLOCKS).text(f"{folder}/files")
    remove_scratch(spark, kept)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document; with ``with_ids`` its ids."""
    ranks = spark.read.parquet(f"{folder}/ranks").collect()
    id_of = np.zeros(len(ranks), np.uint32)
    id_of[[r.rank for r in ranks]] = [r.id for r in ranks]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/files").select("content")
    schema = "doc_id long, block long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = files.mapInArrow(partial(_rows, id_of=spark.sparkContext.broadcast(id_of), with_ids=with_ids), schema)
    # One small row a block, stored: the prefix sum reads it three times.
    before = global_prefix(cut(files.mapInArrow(_heads, "block long, total long")), ["block"], ["total"])
    before = before.select("block", (F.col("total_cum") - F.col("total")).alias("before"))
    return rows.join(before, "block").select("doc_id", (F.col("before") + F.col("at")).alias("start"), *[c for c in rows.columns if c not in ("doc_id", "block", "at")])


def token_rows(docs: DataFrame, path: str) -> DataFrame:
    """Contract columns of ``op13_token_files``, read back from files written in the shared scratch folder."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, path)
    rows = cut(read_token_files(spark, folder))
    remove_scratch(spark, folder)
    return rows
