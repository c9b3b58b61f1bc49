"""Personal data: candidate spans, boosted trees, calibrated thresholds; DataFrame expressions only.

Base spans come from four patterns with their tests. High-recall generators
propose further, looser spans (spelled-out addresses, numbers with any
separators). Boosted trees score a candidate by its format and the words
before it; they are fitted on the candidates of all documents, folded to one
weighted row for each format, and written out as one expression, so scoring
needs no shuffle. A candidate is labelled right
if a base span of its kind covers it or, whatever the base finds, if its
format is valid and its spelling or the words before it say what it is
(``evidence``). For each kind the threshold is the least score at which the
candidates of the other half are at least ``PRECISION`` right, all of
them and those that no base span covers; a kind that has none adds nothing.
Candidates over the threshold that touch no base span are added; base spans
always stay.

Null text: empty, no spans. Without candidates only base spans are found. Repeated rows give equal rows. Texts of any length are read whole.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import id_and_text

PRECISION, TREES, DEPTH, LEAST_RIGHT = 0.99, 12, 3, 20
# Possessive forms of the contract's patterns, which match the same text without deep recursion; a match
# may start where the last one ended or where a run of its first class begins, as any other start in
# the run would fail alike.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
# Cheap tests that any match passes.
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE = {
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{2,64}(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{2,64}){1,4}",
    "number": r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,24}(?![0-9A-Za-z])",
}
LOOSE_GATES = {"address": r"@|\(at\)|\[at\]|\x20dot\x20|\(dot\)|\[dot\]", "number": r"[0-9][\x20().\-/]{0,2}[0-9]"}
CONTEXT = {"says_mail": "mail|contact|write", "says_call": "phone|tel|call|mobile|fax", "says_card": "card|visa|credit|pay", "says_host": r"\bip\b|host|addr|server"}
# Whole words, just before a number or address, that name its kind.
NAMED = {"phone": r"\b(?:phone|telephone|tel|call|mobile|fax)\b", "card": r"\b(?:card|visa|mastercard|credit)\b"}
SPELLED = r"^[^@]*(?:\x20?(?:\(at\)|\[at\])\x20?|\x20at\x20(?=.*\x20dot\x20))|\x20@|@\x20|@.*(?:\(dot\)|\[dot\]|\x20dot\x20)"
SPAN = "array<struct<kind:string,start:long,end:long,text:string>>"


def _spans(text: Column, pattern: str, gate: str, kind: str) -> Column:
    """Matches with their places in code points: the pieces between matches give the starts."""
    p = F.lit(pattern)
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        s = acc["at"] + F.char_length(x["gap"])
        e = s + F.coalesce(F.char_length(x["hit"]), F.lit(0))
        one = F.struct(F.lit(kind).alias("kind"), s.cast("long").alias("start"), e.cast("long").alias("end"), x["hit"].alias("text"))
        return F.struct(e.cast("long").alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out"))

    found = F.aggregate(zipped, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(gate), found).otherwise(F.array().cast(SPAN))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _passes(kind: str):
    if kind == "email":
        return lambda s: F.lit(True)
    if kind == "ip":
        return lambda s: s["text"].rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return lambda s: F.char_length(_digits(s["text"])).between(13, 19) & F.call_function("luhn_check", _digits(s["text"]))
    return lambda s: F.char_length(_digits(s["text"])).between(9, 15)


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty), row (all columns) and base, the base spans by kind, then start."""
    rows = id_and_text(docs, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "row")
    each = [F.filter(_spans(F.col("text"), PATTERNS[k], GATES[k], k), _passes(k)) for k in KINDS]
    return rows.withColumn("base", F.concat(*each))


FEATURES = ["n_chars", "n_digits", "n_runs", "longest", "brackets", "dots", "dashes", "spaces", "letters", "luhn", *CONTEXT]


def evidence(kind: Column, c: Column, before: Column) -> Column:
    """Whether a candidate's own form and the words before it show personal data of its kind; base spans play no part."""
    n, luhn = F.char_length(_digits(c["text"])), F.call_function("luhn_check", _digits(c["text"]))
    return (
        F.when(kind == "email", c["text"].rlike(SPELLED) & c["text"].rlike(r"[A-Za-z]{2}$"))
        .when(kind == "phone", n.between(9, 15) & c["text"].rlike(r"^[+(0]|[0-9][^0-9]+[0-9]") & before.rlike(NAMED["phone"]))
        .when(kind == "card", n.between(13, 19) & luhn & before.rlike(NAMED["card"]))
        .otherwise(False)
    )


def with_candidates(rows: DataFrame, labelled: bool = False) -> DataFrame:
    """Adds candidates array<struct<kind, start, end, covered, touches, features...>>; evidence too if labelled."""
    before = lambda c: F.lower(F.substring(F.col("text"), F.greatest(c["start"] - 23, F.lit(1)).cast("int"), F.least(c["start"], F.lit(24)).cast("int")))
    count = lambda c, p: F.char_length(F.regexp_replace(c["text"], f"[^{p}]", "")).cast("double")

    def described(loose):
        def one(c):
            t, digits = c["text"], _digits(c["text"])
            n = F.char_length(digits)
            kind = F.lit("email") if loose == "address" else F.when(t.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), "ip").when(n >= 13, "card").otherwise("phone")
            touched = lambda other: F.exists(F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]) & other(b))
            runs = F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))
            values = {
                "n_chars": F.char_length(t), "n_digits": n, "n_runs": F.size(runs), "longest": F.coalesce(F.array_max(F.transform(runs, F.char_length)), F.lit(0)),
                "brackets": count(c, "()\\\\[\\\\]"), "dots": count(c, "."), "dashes": count(c, "-"), "spaces": count(c, " "), "letters": count(c, "A-Za-z"),
                "luhn": F.call_function("luhn_check", digits).cast("int"), **{k: before(c).rlike(p).cast("int") for k, p in CONTEXT.items()},
            }
            covered = touched(lambda b: b["kind"] == kind)
            return F.struct(kind.alias("kind"), c["start"].alias("start"), c["end"].alias("end"), covered.alias("covered"), touched(lambda b: F.lit(True)).alias("touches"), *([evidence(kind, c, before(c)).alias("evidence")] if labelled else []), *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in values.items()])

        return F.transform(_spans(F.col("text"), LOOSE[loose], LOOSE_GATES[loose], loose), one)

    return rows.withColumn("candidates", F.concat(*[described(x) for x in LOOSE]))


def _as_expression(node, c) -> Column:
    """A fitted regression tree as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return F.when(c[name] <= float(split.threshold()), _as_expression(node.leftChild(), c)).otherwise(_as_expression(node.rightChild(), c))


class Scorer:
    """Fitted trees and the thresholds of the kinds that have one."""

    def __init__(self, trees, weights, thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def margin(self, c) -> Column:
        return reduce(lambda a, b: a + b, [F.lit(float(w)) * _as_expression(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t, c) for t, w in zip(self.trees, self.weights)])

    def selects(self, c) -> Column:
        over = [(c["kind"] == k) & (self.margin(c) >= t) for k, t in self.thresholds.items()]
        return reduce(lambda a, b: a | b, over, F.lit(False)) if over else F.lit(False)


def formats(docs: DataFrame) -> DataFrame:
    """kind, label, covered, half, features and n: the candidates of all documents, counted by format.

    Equal rows count once; a candidate's half hangs on its document and place. Only the folded rows
    are learned from, and their number follows the variety of formats, not the documents."""
    rows = with_base(docs).withColumn("of", F.xxhash64("text"))
    found = with_candidates(rows, labelled=True).select("doc_id", "of", F.explode("candidates").alias("c")).select("doc_id", "of", "c.*").distinct()
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id", "start"), F.lit(2)).alias("half")
    label = (F.col("covered") | F.col("evidence")).cast("double").alias("label")
    return found.groupBy("kind", label, "covered", half, *FEATURES).agg(F.count("*").cast("double").alias("n"))


def fit(docs: DataFrame) -> Scorer:
    """Trees and thresholds from the candidates of all documents."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    found = formats(docs).repartition(4).persist()  # a row for each format
    try:
        seen = {(r.half, r.label): r.n for r in found.groupBy("half", "label").agg(F.sum("n").alias("n")).collect()}
        if not all(seen.get((0, y), 0) >= LEAST_RIGHT for y in (0.0, 1.0)):
            return Scorer([], [], {})
        table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found.where("half = 0"))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=5, checkpointInterval=-1, weightCol="n").fit(table)
        scorer = Scorer(model.trees, model.treeWeights, {})
        scored = found.where("half = 1").withColumn("margin", F.round(scorer.margin({k: F.col(k) for k in FEATURES}), 6))
        right, bare = F.col("label") * F.col("n"), F.when(~F.col("covered"), F.col("n")).otherwise(0.0)
        levels = scored.groupBy("kind", "margin").agg(F.sum(right).alias("right"), F.sum("n").alias("n"), F.sum(F.col("label") * bare).alias("bare_right"), F.sum(bare).alias("bare")).collect()  # one row per leaf combination
        for kind in KINDS:
            right = n = bare_right = bare = 0
            for r in sorted((r for r in levels if r.kind == kind), key=lambda r: -r.margin):
                right, n, bare_right, bare = right + r.right, n + r.n, bare_right + r.bare_right, bare + r.bare
                if right >= LEAST_RIGHT and right >= PRECISION * n and bare_right >= PRECISION * bare:
                    scorer.thresholds[kind] = r.margin - 1e-6
        return scorer
    finally:
        found.unpersist()


def find_pii(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """doc_id, text, base and spans (base and added) of every row; spans by kind, then start."""
    scorer = fit(docs) if scorer is None else scorer
    rows = with_base(docs)
    if not scorer.thresholds:
        return rows.withColumn("spans", F.transform("base", _bare))
    rows = with_candidates(rows)
    added = F.filter("candidates", lambda c: ~c["touches"] & scorer.selects(c))
    order = F.array(*[F.lit(k) for k in KINDS])
    both = F.concat(F.transform("base", _bare), F.transform(added, _bare))
    ordered = F.array_sort(F.transform(both, lambda s: F.struct(F.array_position(order, s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return rows.withColumn("spans", F.transform(ordered, _bare)).drop("candidates")


def _bare(s: Column) -> Column:
    return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the earlier one's name is kept."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    cut = lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))

    def step(acc, s):
        name = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(cut(acc["at"], s["start"]), name))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("out"))

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(by_start, first, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def redact(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """The documents, all columns, with personal data in their texts replaced; n_chars follows the text."""
    found = find_pii(docs, scorer)
    text = F.when(F.size("spans") > 0, redacted(F.col("text"), F.col("spans"))).otherwise(F.col("row")["text"])
    found = found.select("row", text.alias("new"))
    kinds = {f.name: f.dataType for f in docs.schema}
    new = {"text": F.col("new").cast(kinds["text"])}
    if "n_chars" in kinds:
        new["n_chars"] = F.char_length("new").cast(kinds["n_chars"])
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def pii_digests(found: DataFrame) -> DataFrame:
    """Contract columns of ``op3_pii``."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return found.select(
        "doc_id",
        *[F.size(F.filter(F.col("base")["kind"], _same(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform("base", line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
    )


def _same(kind: str):
    return lambda x: x == kind
