"""Best-fit-decreasing packing of tokenised documents.

Each document becomes the ids of a public tokenizer and a closing id. Full
windows are cut from overlong documents first; what is left of each (less
than a window) is placed, longest first, in the open window with the least
room that still fits, found with a segment tree over remaining capacity.

Only (document, start, length) go into packing, never the ids, in groups of a
fixed number of pieces, so a task's memory is bounded and groups multiply
with the input. A document's pieces may lie in several groups.

Null or empty text: the closing id alone. Repeated rows are packed as often
as they occur; a null doc_id stays null. An empty table gives no rows. Extra
columns are ignored. ``sequence_id`` is unique, not gapless.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import cut, id_and_text, text_batches
from stayframe.llm.tokens import CLOSING_ID, VOCABULARY, encoder  # noqa: F401  (VOCABULARY: for callers)

WINDOW, GROUP_PIECES = 4096, 20_000


def _pieces(batches, path: str, window: int, closing: int, with_ids: bool):
    import pyarrow as pa

    encode = encoder(path)
    for t, texts in text_batches(batches, limit=2 << 20):
        ids, first = encode(texts, closing)
        tokens = np.diff(first)
        pieces = -(-tokens // window)
        doc = np.repeat(np.arange(len(texts)), pieces)
        start = window * (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        length = np.minimum(window, tokens[doc] - start)
        at = first[doc] + start
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[a:b]) for a, b in zip((4 * at).tolist(), (4 * (at + length)).tolist())]
        out = [t.column("doc_id").combine_chunks().take(pa.array(doc)), *[pa.array(x, pa.int64()) for x in (start, length, crc, tokens[doc])]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            out.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(out, names)
    pa.default_memory_pool().release_unused()  # the worker lives on


def cut_pieces(docs: DataFrame, path: str, window: int = WINDOW, closing: int = CLOSING_ID, with_ids: bool = False) -> DataFrame:
    """Full windows and the rest of each document; with ``with_ids`` the pieces carry their ids."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return id_and_text(docs).mapInArrow(partial(_pieces, path=path, window=window, closing=closing, with_ids=with_ids), schema)


class RoomTree:
    """Segment tree over remaining capacities 0..window: how many open windows have each."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def add(self, room: int, which: int, by: int = 1) -> None:
        if by > 0:
            self.open.setdefault(room, []).append(which)
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room >= need that some open window has."""
        node, count = need + self.size, self.count
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:  # climb until a right neighbour holds windows
                node += 1
                while node < self.size:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None

    def take(self, room: int) -> int:
        self.add(room, -1, -1)
        return self.open[room].pop()


def best_fit(lengths, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """The window and the offset in it of each length, placed in the order given."""
    tree, where, offset, opened = RoomTree(window), [], [], 0
    for need in lengths:
        room = tree.tightest(need)
        if room is None:
            which, room = opened, window
            opened += 1
        else:
            which = tree.take(room)
        where.append(which)
        offset.append(window - room)
        if room > need:
            tree.add(room - need, which)
    return where, offset


def pack(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset; pieces must not carry ids (join those back by doc_id and start)."""
    pieces = cut(pieces)
    groups = max(1, -(-pieces.count() // group_pieces))

    def place(key, t):
        import pyarrow as pa

        t = t.drop(["pack_group"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        where, offset = best_fit(t.column("length").to_pylist(), window)
        base = key[0].as_py() << 32
        return t.append_column("sequence_id", pa.array([base + w for w in where], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    grouped = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))  # the row's number parts rows repeated whole
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return grouped.groupBy("pack_group").applyInArrow(place, schema)
