"""Secret scan: pattern rules, and guess cost of values in a credential context.

The rules (``assign``, ``access``, ``hex``) find leftmost non-overlapping
matches and drop those that fail their length test. A value that follows a
credential word is also priced by a dynamic programme: the cheapest way to
write it as common words, dates, repeats, keyboard or alphabet walks and
brute-force characters gives log2 of the guesses it takes; costly values
become ``guess`` findings where no rule already has the place. A bare word of
letters, all small or with a capital first, after 'is' or 'with' may be prose
and must cost ``PROSE_BITS``; any other value ``MIN_BITS``.

The word ranks are a fixed list and the documents' own words: runs of 3 to 24
letters a-z in the lower-cased texts are counted over all documents, and the
most frequent rank by their counts (ties by word): as many steps of counts
(``_step``, whole ones) as hold ``VOCABULARY`` words at most. Runs inside
the value after a credential word don't count, so a secret that is copied many
times does not become a common word; neither do words met fewer than
``LEAST`` times. The ranks are broadcast: at most 20,000 words of 24 letters.

Null text: empty, no findings. Every row gives a row; repeated rows and ids
give equal rows. Texts of any length are scanned whole. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import partial
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.llm.common import id_and_text, text_batches

RULES = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]{16,}"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
KINDS = [*RULES, "guess"]
# A credential word, a joiner, and a value without spaces or quotes.
CONTEXT = re.compile(
    r"""\b(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth(?:orization)?|bearer|login|(?:api|access|private|signing|client)[_-]?(?:key|secret))["']?\x20{0,3}(?:[:=]|=>|is\b|\bwith\b)\x20{0,3}["']?([^\s"'<>,;]{8,})""",
    re.I | re.A,
)
MIN_BITS, PROSE_BITS = 40.0, 60.0
VOCABULARY, LEAST = 20_000, 5
WORD = re.compile(r"(?<![a-z])[a-z]{3,24}(?![a-z])")
PROSE = re.compile(r"\b(?:is|with)\x20{0,3}$", re.I | re.A)
# Common password words, most used first.
COMMON = (
    "password qwerty admin welcome letmein monkey dragon master login princess sunshine football baseball shadow "
    "superman michael jordan hunter secret token test user guest root changeme default hello world love summer winter "
    "spring autumn monday friday january february march april june july august september october november december "
    "the and for you that with this from have not are was but all one can out day get has him his how man new now old "
    "see two way who boy did its let put say she too use pass word key api access private public example server client "
    "company database service account mail home work data file system"
).split()
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
RANK = {w: i + 1 for i, w in enumerate(COMMON)}
LONGEST = max(map(len, COMMON))
NEAR = {a: {b for j in (i - 1, i, i + 1) if 0 <= j < len(ROWS) for b in ROWS[j][max(0, k - 1) : k + 2] if b != a} for i, row in enumerate(ROWS) for k, a in enumerate(row)}
LEET = str.maketrans("@$013457", "asoieast")
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")


def count_words(text: str, counts: Counter) -> None:
    """Add the words of a text; those inside the values of a credential context are left out."""
    counts.update(map(itemgetter(0), WORD.finditer(text.lower())))
    for m in CONTEXT.finditer(text):
        counts.subtract(map(itemgetter(0), WORD.finditer(m[1].lower())))


def _counted(batches):
    import pyarrow as pa

    for _, texts in text_batches(batches):
        counts: Counter = Counter()
        for t in texts:
            count_words(t.decode("utf-8"), counts)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def _step(n: Column) -> Column:
    """A count rounded down to its seven leading bits, as an ascending number (under 10,000)."""
    size = F.length(F.bin(n))
    return size * 128 + F.call_function("shiftright", n, F.greatest(size - 7, F.lit(0))).cast("int")


def learned_ranks(docs: DataFrame, most: int = VOCABULARY) -> dict[str, int]:
    """Ranks of the documents' words joined with the fixed ones (the lesser of both); ``most`` words are learned at most.

    The words of each step of counts are counted first, so that only those kept reach the driver."""
    counts = id_and_text(docs).mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("n") >= LEAST).withColumn("step", _step(F.col("n")))
    upto = counts.groupBy("step").count().withColumn("upto", F.sum("count").over(Window.orderBy(F.col("step").desc())))  # a row a step
    kept = counts.join(F.broadcast(upto.where(F.col("upto") <= int(most)).select("step")), "step").select("word", "n").collect() if most else []
    ranks = {r.word: i + 1 for i, r in enumerate(sorted(kept, key=lambda r: (-r.n, r.word)))}
    return ranks | {w: min(i, ranks.get(w, i)) for w, i in RANK.items()}


def guess_bits(value: str, ranks: dict[str, int] = RANK, longest: int = LONGEST) -> float:
    """log2 of the guesses of the cheapest segmentation; linear in the length, as segments that branch are short."""
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    size = sum(k for k, p in ((26, r"[a-z]"), (26, r"[A-Z]"), (10, r"[0-9]"), (33, r"[^A-Za-z0-9]")) if re.search(p, value))
    char = math.log2(max(size, 2))
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if low[i].isdigit() and (m := DATE.match(value, i)):
            dates.setdefault(i, []).append(m.end())
    for i in range(n):
        here = best[i]
        # brute force, one character more
        best[i + 1] = min(best[i + 1], here + char)
        for j in range(i + 3, min(n, i + longest) + 1):
            rank = ranks.get(plain[i:j])
            if rank:
                seg = value[i:j]
                extra = 0.0 if seg == low[i:j] else 1.0 if seg == seg.title() or seg.isupper() else float(j - i)
                extra += sum(a != b for a, b in zip(low[i:j], plain[i:j]))
                best[j] = min(best[j], here + 1 + math.log2(rank) + extra)
        for j in dates.get(i, ()):
            best[j] = min(best[j], here + (math.log2(365 * 120) if j - i > 4 else math.log2(120)))
        for unit in (1, 2, 3, 4):  # one step of a repeat costs little once the unit has been paid
            if i >= unit and low[i : i + unit] == low[i - unit : i] and i + unit <= n:
                best[i + unit] = min(best[i + unit], here + 1)
        if i and (low[i] in NEAR.get(low[i - 1], ()) or abs(ord(low[i]) - ord(low[i - 1])) == 1):
            best[i + 1] = min(best[i + 1], here + 1.5)  # next key or letter of a walk
    return best[n]


def find_secrets(text: str, min_bits: float = MIN_BITS, ranks: dict[str, int] = RANK, longest: int = LONGEST) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, log2 guesses or 0) ordered by start, then kind."""
    found = [("assign", *m.span(), 0.0) for m in RULES["assign"].finditer(text) if len(m[1]) >= 6]
    for kind in ("access", "hex"):
        found += [(kind, *m.span(), 0.0) for m in RULES[kind].finditer(text)]
    taken: list[list[int]] = []  # places of the rules' findings, overlapping ones joined
    for s, e in sorted((s, e) for _, s, e, _ in found):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    k = 0
    for m in CONTEXT.finditer(text):
        s, e = m.span(1)
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if k < len(taken) and taken[k][0] < e:
            continue
        value = m[1].rstrip(".)]}!?:")
        prose = value.isalpha() and value[1:].islower() and PROSE.search(text, m.start(), s)
        if len(value) >= 8 and (bits := guess_bits(value, ranks, longest)) >= (max(min_bits, PROSE_BITS) if prose else min_bits):
            found.append(("guess", s, s + len(value), bits))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def scan_secrets(docs: DataFrame, min_bits: float = MIN_BITS, learn: int = VOCABULARY) -> DataFrame:
    """doc_id, findings array<struct<kind, start, end, bits>> in code points, end exclusive.

    ``learn`` words of the documents are learned at most (0: the fixed list alone)."""
    ranks = docs.sparkSession.sparkContext.broadcast(learned_ranks(docs, learn))

    def scan(batches):
        import pyarrow as pa

        item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))
        known = ranks.value
        longest = max(map(len, known))
        for b in batches:
            rows = [[dict(zip(("kind", "start", "end", "bits"), f)) for f in find_secrets(t or "", min_bits, known, longest)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, item)], ["doc_id", "findings"])

    return id_and_text(docs).mapInArrow(scan, "doc_id long, findings array<struct<kind string, start long, end long, bits double>>")


def _is(kind, x):
    return x == kind


def secret_digests(found: DataFrame) -> DataFrame:
    """Contract columns of ``op8_secrets``."""
    line = lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
    base = F.filter("findings", lambda f: f["kind"] != "guess")
    return found.select(
        "doc_id",
        *[F.size(F.filter(F.col("findings")["kind"], partial(_is, kind))).cast("long").alias(f"n_{kind}") for kind in RULES],
        F.sha2(F.array_join(F.transform(base, line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("findings", line), ",").alias("spans"),
    )


def brute_digest(text: str) -> str:
    """The base digest by the rules' plain patterns, for tests."""
    plain = {"assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6), "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}
    found = sorted((m.start(), i, k, m.end()) for i, (k, (p, ok)) in enumerate(plain.items()) for m in re.finditer(p, text, re.A) if ok(m))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in found).encode()).hexdigest()
