"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.session import checkpoint_dir

# Bytes 9-13 and 32 separate words in every contract here.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_R = 0x9E3779B97F4A7C15  # odd multipliers, so that their powers invert modulo 2^64
_S = 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator works on; any further columns stay behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut by a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` different rows at most (all, if there are no more), chosen by a hash of the whole row: the same rows on every run.

    Rows with a null key stay out and equal rows count once, so neither a
    hot key nor rows repeated often make the sample any larger.
    """
    df = df.where(F.col(key).isNotNull())
    n = df.count()
    if n > bound:
        df = df.where(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int(bound / n * (1 << 30)))
    return df.dropDuplicates()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` and its inverse modulo 2^64 to the powers 0..n-1 (kept per worker, grown by doubling)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length()) if n > 1 else 1 << 16
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit polynomial hash of values[start:end] for every span, from prefix sums."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[end] - total[start]) * down[start]


class Words:
    """Words of a batch of texts, found without a loop over words.

    ``hash`` holds a 64-bit hash of each word, ``doc`` its text's place in
    the batch, ``start``/``end`` its bytes in ``data``.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join(texts)
        raw = np.frombuffer(self.data, np.uint8)
        word = ~SPACE[raw]
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        first = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.doc = np.searchsorted(first, self.start, side="right") - 1
        n = spans_hash(raw.astype(np.uint64) + np.uint64(1), self.start, self.end, _R)
        self.hash = mix(n ^ (self.end - self.start).astype(np.uint64))
        self.count = np.bincount(self.doc, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first words of all ``size``-word windows inside one text, and the windows' hashes."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, mix(spans_hash(self.hash, at, at + size, _S))


def text_batches(batches, column: str = "text", limit: int = 4 << 20, rows: int = 20_000):
    """Arrow batches cut or joined to about ``limit`` bytes of text and ``rows`` rows at most: (table, list of UTF-8 texts, null as empty)."""
    import pyarrow.compute as pc

    held, size, n = [], 0, 0
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = min(at + rows - n, max(at + 1, int(np.searchsorted(ends, base + limit - size, side="right"))))
            held.append(batch.slice(at, to - at))
            size, n, at = size + int(ends[to - 1] - base), n + to - at, to
            if size >= limit or n >= rows or to < batch.num_rows:
                yield _joined(held, column)
                held, size, n = [], 0, 0
    if held:
        yield _joined(held, column)


def _joined(held, column):
    import pyarrow as pa

    t = pa.Table.from_batches(held).combine_chunks()
    return t, [x or b"" for x in t.column(column).cast(pa.large_binary()).to_pylist()]
