"""Language identification with n-gram filters that answer for all languages at once.

A Bloom filter is kept bit-sliced: each slot is a bitmask with one bit per
language, an n-gram's slots are ANDed, and the bits left are the languages
whose profile holds it. For a text the bits of all its n-grams are counted per
language, each count is corrected by the filter's false-positive rate for that
language, and the language with the largest share of n-grams wins.

A language's profile is its ``PROFILE`` most frequent byte n-grams (of 3, 4
and 5 bytes, in texts lower-cased, with all but letters turned into spaces)
that are not as frequent elsewhere, counted by Spark over a bounded sample of
each language's labelled rows (all of a rare one's), so every lang value is
learned and the filter's size does not depend on the input.

Null text or one without a letter: ``und``, score 0. Rows with null lang or
text teach nothing. With no teaching rows every text is ``und``. A tie goes to
the language first in alphabetical order. Repeated rows get equal rows. An
empty table gives no rows. Lang, source and doc_id never enter a prediction.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import cut, held_out, id_and_text, mix, text_batches

SIZES, PROFILE, SAMPLE, BITS_PER_GRAM, PROBES = (3, 4, 5), 20_000, 6_000, 16, 2
UNKNOWN = "und"
# Bytes other than letters become one kind of space; bytes above 127 are parts of letters.
_CLEAN = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def cleaned(text: bytes) -> bytes:
    try:
        low = text.decode().lower().encode()
    except UnicodeDecodeError:
        low = text.lower()
    return b" " + b" ".join(low.translate(_CLEAN).split()) + b" "


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text's place, 64-bit code) of every n-gram of cleaned texts."""
    raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    docs, codes, code = [], [], raw
    for n in range(2, max(SIZES) + 1):
        code = code[:-1] << np.uint64(8) | raw[n - 1 :]
        if n in SIZES and len(code):
            inside = doc[: len(code)] == doc[n - 1 :]
            docs.append(doc[: len(code)][inside])
            codes.append(code[inside])
    return (np.concatenate(docs), np.concatenate(codes)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


class Filters:
    """Bit-sliced Bloom filters of all languages; languages beyond 64 use further words of the masks."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.languages = sorted(profiles)
        n = max([len(p) for p in profiles.values()], default=0)
        self.slots = 1 << max(10, int(n * BITS_PER_GRAM - 1).bit_length()) if n else 1 << 10
        words = max(1, -(-len(self.languages) // 64))
        self.masks = np.zeros((self.slots, words), np.uint64)
        for i, lang in enumerate(self.languages):
            for p in self._probes(np.asarray(profiles[lang], np.uint64)):
                self.masks[p, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        fill = [float(self._bit(self.masks, i).mean()) for i in range(len(self.languages))]
        self.false = np.array(fill) ** PROBES
        # byte-wide masks are quicker to read at random when the languages fit
        self.narrow = self.masks[:, 0].astype(np.uint8) if len(self.languages) <= 8 else None

    def _probes(self, codes: np.ndarray):
        h = mix(codes)
        for k in range(PROBES):
            yield ((h >> np.uint64(32 * k)) & np.uint64(self.slots - 1)).astype(np.int64)

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """For each text and language the share of its n-grams that the language holds, corrected for false positives."""
        doc, code = grams(texts)
        total = np.bincount(doc, minlength=len(texts)).astype(np.float64)
        a, b = self._probes(code)
        out = np.zeros((len(texts), len(self.languages)))
        if self.narrow is not None:
            hit = self.narrow[a] & self.narrow[b]
            # one table of (text, mask) counts gives every language's popcount
            table = np.bincount(doc * 256 + hit, minlength=256 * len(texts)).reshape(-1, 256)
            bits = (np.arange(256)[:, None] >> np.arange(len(self.languages))) & 1
            out = (table @ bits).astype(np.float64)
        else:
            hit = self.masks[a] & self.masks[b]
            for i in range(len(self.languages)):
                out[:, i] = np.bincount(doc, weights=self._bit(hit, i).astype(np.float64), minlength=len(texts))
        share = out / np.maximum(total, 1)[:, None]
        return np.clip((share - self.false) / (1 - self.false), 0, 1)

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        letters = [any(map(str.isalpha, t.decode(errors="replace"))) for t in texts]
        share = self.shares([cleaned(t) for t in texts])
        best, all_of = share.argmax(1), share.sum(1)
        return [
            ((self.languages[b], float(share[i, b] / all_of[i]) if all_of[i] > 0 else 0.0) if letters[i] else (UNKNOWN, 0.0))
            for i, b in enumerate(best.tolist())
        ]


def _count(batches):
    import pyarrow as pa

    for t, texts in text_batches(batches, limit=4 << 20):
        langs = t.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            _, code = grams([cleaned(x) for x, y in zip(texts, langs) if y == lang])
            codes, n = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "code", "n"])


def fit(docs: DataFrame, sample: int = SAMPLE, profile: int = PROFILE) -> Filters:
    """Filters of every lang value among ``docs``, from about ``sample`` rows of each (chosen by the hash of doc_id and text)."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string").alias("lang"))
    shares = known.groupBy("lang").agg((F.lit(float(sample)) / F.count("*") * (1 << 30)).alias("share"))  # a row per language
    rows = known.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("share"))
    counts = rows.select("text", "lang").mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counts = cut(counts)  # read three times
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rate = counts.join(F.broadcast(totals), "lang").where("n > 1").withColumn("rate", F.col("n") / F.col("total"))  # a row per language
    own = rate.join(rate.groupBy("code").agg(F.max("rate").alias("most")), "code").where("rate * 4 >= most")
    from pyspark.sql import Window

    first = own.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("rate"), "code"))).where(F.col("k") <= profile)
    profiles: dict[str, list[int]] = {r.lang: [] for r in totals.select("lang").collect()}
    for r in first.select("lang", "code").collect():  # ``profile`` rows per language at most
        profiles[r.lang].append(r.code)
    return Filters({k: np.array(v, np.int64).view(np.uint64) for k, v in profiles.items()})


def _predict(batches, filters):
    import pyarrow as pa

    for t, texts in text_batches(batches, limit=1 << 20):
        found = filters.value.predict(texts)
        yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # bounded by the profile's size
    return id_and_text(docs).mapInArrow(partial(_predict, filters=shared), "doc_id long, lang_pred string, score double")


def language_rows(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op6_language``: learned from rows that aren't held out."""
    filters = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, filters).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
