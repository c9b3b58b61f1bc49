"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its words (lower-cased runs of letters and digits), and
runs of three signs of its outline (letters by case, digits, spaces, line ends
and punctuation, with runs of one kind collapsed) with counts of words and word
pairs that repeat, hashed into a fixed number of slots. Words and outline weigh
alike: each part of a text's tf-idf row has length one. A truncated SVD of the tf-idf matrix of a bounded sample of labelled rows gives
the latent space. Those rows' latent vectors (at most ``SAMPLE`` x ``LATENT``
floats, whatever the input's size) go to every task, where the cosine of each
document with each of them is computed in blocks; the nearest vote with their
labels, weighted by similarity.

Null or empty text: no terms; the score is the sample's share of label 1.
Labels that are null take no part in fitting; a doc_id with both labels takes
part with each, repeated rows count once. Without any labelled row every score is 0.5. Repeated
rows get equal rows. An empty table gives no rows. Labels, lang, source and
doc_id never enter a score.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import Words, bounded_sample, held_out, id_and_text, mix, text_batches

SLOTS, WORD_SLOTS, LATENT, SAMPLE, NEIGHBOURS, BLOCK, SEED, TIE = 2048, 4096, 48, 3000, 15, 512, 7, 1e-5


def _outline() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[97:123] = 97
    t[65:91] = 65
    t[48:58] = 48
    t[128:] = 97  # bytes of letters beyond ASCII
    t[[9, 11, 12, 13, 32]] = 32
    return t


_OUTLINE = _outline()
# Letters and digits, lower-cased; all else parts words.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms(texts: list[bytes]) -> np.ndarray:
    """Term counts, one row for each text: ``SLOTS`` slots of the outline, then ``WORD_SLOTS`` of words."""
    n = len(texts)
    out = np.zeros((n, SLOTS), np.float32)
    raw = _OUTLINE[np.frombuffer(b"".join(texts), np.uint8)]
    doc = np.repeat(np.arange(n), [len(t) for t in texts])
    if len(raw):
        run = np.ones(len(raw), bool)
        run[1:] = (raw[1:] != raw[:-1]) | (doc[1:] != doc[:-1])
        raw, doc = raw[run].astype(np.int64), doc[run]
    if len(raw) >= 3:
        code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        inside = doc[:-2] == doc[2:]
        slot = (mix(code[inside].astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % (SLOTS - 4)
        out += np.bincount(doc[:-2][inside] * SLOTS + slot, minlength=n * SLOTS).reshape(n, SLOTS)
    words = Words(texts)
    for back in (1, 2):  # a word that repeats the one before it, or the one before that
        same = (words.hash[back:] == words.hash[:-back]) & (words.doc[back:] == words.doc[:-back])
        out[:, SLOTS - 3 + back] = np.bincount(words.doc[back:][same], minlength=n)
    words = Words([t.translate(_WORD) for t in texts])
    slot = (words.hash >> np.uint64(40)).astype(np.int64) % WORD_SLOTS
    said = np.bincount(words.doc * WORD_SLOTS + slot, minlength=n * WORD_SLOTS).reshape(n, WORD_SLOTS)
    return np.hstack((out, said.astype(np.float32)))


def weighted(counts: np.ndarray, idf: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    x = np.log1p(counts, out=out)
    x *= idf
    for part in (x[:, :SLOTS], x[:, SLOTS:]):
        norm = np.sqrt(np.einsum("ij,ij->i", part, part))[:, None]
        np.divide(part, norm, out=part, where=norm > 0)
    return x


class Voter:
    """The fitted space: idf, projection, and the unit vectors and labels of the sample."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, latent: int = LATENT, neighbours: int = NEIGHBOURS, reuse: bool = False):
        self.neighbours = min(neighbours, len(labels))
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.idf = np.log((1 + len(labels)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + 1
        x = weighted(counts, self.idf, out=counts if reuse else None)  # in place: the driver holds the matrix once
        # truncated SVD by subspace iteration from a fixed start
        rng = np.random.default_rng(SEED)
        k = min(latent, *x.shape) if len(labels) else 0
        q = rng.standard_normal((x.shape[1], k + 10)).astype(np.float32) if k else np.zeros((x.shape[1], 0), np.float32)
        for _ in range(6 if k else 0):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        if k:
            _, _, v = np.linalg.svd(x @ q, full_matrices=False)
            q = (q @ v.T)[:, :k].astype(np.float32)
        self.space = q
        self.refs = self._project(x)
        self.labels = labels.astype(np.float32)

    def _project(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.space
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        return np.divide(z, norm, out=np.zeros_like(z), where=norm > 0)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.labels):
            return out
        z = self._project(weighted(counts, self.idf))
        for at in range(0, len(z), BLOCK):
            cosine = z[at : at + BLOCK] @ self.refs.T
            # every row as near as the k-th nearest votes, so ties never hang on the order of the sample
            least = np.partition(cosine, -self.neighbours, axis=1)[:, -self.neighbours, None]
            weight = np.where(cosine >= least - TIE, np.exp(20 * (cosine - cosine.max(1, keepdims=True))), np.float32(0))
            vote = (weight @ self.labels) / weight.sum(1)
            known = np.abs(z[at : at + BLOCK]).sum(1) > 0
            out[at : at + BLOCK][known] = vote[known]
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Voter:
    """A voter from at most about ``sample`` different labelled rows (chosen by a hash)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL").distinct()
    known = bounded_sample(known, "doc_id", sample)
    labelled = id_and_text(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")
    labelled = bounded_sample(labelled, "doc_id", sample)  # a labelled doc_id may stand on many rows
    rows = labelled.mapInArrow(_sampled, "doc_id long, label int, counts binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.counts))
    counts = np.zeros((len(rows), SLOTS + WORD_SLOTS), np.float32)
    for row, r in zip(counts, rows):
        n = len(r.counts) // 6
        row[np.frombuffer(r.counts, "<u2", n)] = np.frombuffer(r.counts, "<f4", n, 2 * n)
    labels = np.array([r.label for r in rows], np.float32)
    del rows
    return Voter(counts, labels, reuse=True)


def _sampled(batches):
    import pyarrow as pa

    for t, texts in text_batches(batches, limit=1 << 20):
        used = ((x, np.flatnonzero(x)) for x in terms(texts))  # the slots in use, then their counts
        rows = [at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes() for x, at in used]
        yield pa.RecordBatch.from_arrays([*t.select(["doc_id", "label"]).to_batches()[0].columns, pa.array(rows, pa.binary())], ["doc_id", "label", "counts"])


def _scored(texts: list[bytes], voter: Voter) -> np.ndarray:
    return np.concatenate([voter.score(terms(texts[at : at + BLOCK])) for at in range(0, len(texts), BLOCK)])


def _scores(batches, voter):
    import pyarrow as pa

    for t, texts in text_batches(batches, limit=2 << 20):
        yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array(_scored(texts, voter.value))], ["doc_id", "score"])


def _keep(batches, voter, least):
    import pyarrow as pa

    for t, texts in text_batches(batches, limit=2 << 20):
        yield from t.filter(pa.array(_scored(texts, voter.value) >= least)).combine_chunks().to_batches()


def score_quality(docs: DataFrame, voter: Voter) -> DataFrame:
    """doc_id, score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(voter)  # bounded by the sample
    return id_and_text(docs).mapInArrow(partial(_scores, voter=shared), "doc_id long, score double")


def keep_quality(docs: DataFrame, voter: Voter, least: float = 0.5) -> DataFrame:
    """The rows of documents, with all their columns, whose score reaches ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(voter)
    return docs.mapInArrow(partial(_keep, voter=shared, least=least), docs.schema)


def quality_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of ``op10_quality``: learned from rows that aren't held out."""
    voter = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score_quality(docs, voter).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
