"""Operators against brute force, round trips and held-out accuracy, with nulls, ties, repeats and odd texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayframe.llm import chat, common, decontaminate, language, neighbours, packing, pii, quality, secrets, simhash, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that an operator also uses for its own columns.
CLASHING = {"tags": "x", "words": "y", "at": 1, "fp": 2, "score": 0.5, "base": "z", "row": 3, "key": 4, "batch": 5, "sig": 6}


def documents(spark, texts, ids=None, clash=False):
    ids = range(len(texts)) if ids is None else ids
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)
    return df.select("*", *[F.lit(v).alias(k) for k, v in CLASHING.items()]) if clash else df


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD = [None, "", " \t\n", "one", "é ñ 漢字   x", "a" * 30_000, "De " * 3_000, "1 2 3 " * 500]


# 1: substrings ---------------------------------------------------------------


def planted_repeats():
    rng = random.Random(1)
    passage, long = prose(rng, 60, 10**6), prose(rng, 400, 10**6)
    texts = []
    for k in range(60):
        body = prose(rng, rng.randrange(0, 300), 10**6)
        if k % 3 == 0:
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage[: rng.choice([49, 50, 51, 60])]
        if k % 5 == 0:
            cut = rng.randrange(300)
            body += long[cut : cut + rng.randrange(40, 100)]
        texts.append(" \n".join(body))
    return texts + [texts[3], texts[3], texts[0]] + ODD + ["De " * 3_000]


def test_substrings_match_brute_force(spark, tmp_path):
    texts = planted_repeats()
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    docs = documents(spark, texts, ids, clash=True).repartition(5)
    docs.write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.kept_digests(substrings.remove_repeats(spark.read.parquet(str(tmp_path / "d")))).collect()}
    want = substrings.brute(list(zip(ids, texts)))
    assert got == want
    assert sum(n for _, n, _ in want.values()) > 500


def test_substrings_null_and_repeated_ids(spark):
    text = " ".join(f"x{i}" for i in range(80))
    docs = documents(spark, [text, text, text, "other " + text], [5, None, 5, None]).coalesce(1)
    rows = sorted(((r.doc_id is None, r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()))
    assert rows == [(False, 80, 0), (False, 80, 0), (True, 80, 80), (True, 81, 80)]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


# 2: packing ------------------------------------------------------------------


def test_packing_keeps_every_id(spark):
    rng = random.Random(3)
    texts = ODD + [" ".join(prose(rng, rng.randrange(0, 3_000))) for _ in range(60)] + ["Don't STOP, it's 12.5%!! <|endoftext|> İstanbul", "Y\u030a W\u030a T\u0308x e\u0301 E\u0301t a<|endoftext|>B <|ENDOFTEXT|> \ue000 x\ue000y"]
    path = public_tokenizers.path(packing.VOCABULARY)
    docs = documents(spark, texts, clash=True)
    pieces = packing.cut_pieces(docs, path, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [x for p in mine for x in p.ids] == want
        assert all(p.doc_tokens == len(want) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in mine)
    placed = packing.pack(packing.cut_pieces(docs, path), group_pieces=30).collect()
    assert sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in placed) == sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces)
    rows: dict = {}
    for p in placed:
        rows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for r in rows.values():
        r.sort()
        assert r[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(r, r[1:])) and sum(r[-1]) <= 4096
    assert packing.pack(packing.cut_pieces(docs.limit(0), path)).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(4)
    for _ in range(20):
        lengths = sorted((rng.randrange(1, 65) for _ in range(200)), reverse=True)
        where, offset = packing.best_fit(lengths, 64)
        room: list[int] = []
        for n, w, o in zip(lengths, where, offset):
            fits = [r for r in room if r >= n]
            if fits:
                assert room[w] == min(fits)
            else:
                assert w == len(room)
                room.append(64)
            assert o == 64 - room[w]
            room[w] -= n


# 3: personal data ------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * c, 10)) for c in d[1::2])) % 10 == 0


def passes(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]


def private_texts():
    rng = random.Random(5)
    texts = list(ODD) + [
        "a@b.c@d.e a@b.c_x@d.e é@x.y.z. @x.y .@-.-",
        "1.2.3.4.5 0001.002.3.4 256.1.1.1 1.2.3 1.2.3.4 漢1.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0000000000000",
        "+1 (733) 555-4559 +44 20.7946.0958 +1 2 +123456789012345678 ++1234567890",
        "x" * 5_000 + "@" + "y" * 5_000 + ".z" * 3_000,
        "1" * 40_000,
        "9." * 10_000,
    ]
    pieces = ["a", "1", ".", "@", " ", "-", "+", "(", ")", "4111111111111111", "x@y.zz", "10.0.0.1", "+1 202 555 0100", "é", "\n", "255"]
    return texts + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(400)]


def test_pii_base_matches_the_contract_patterns(spark):
    texts = private_texts()
    rows = pii.pii_digests(pii.find_pii(documents(spark, texts, clash=True), pii.Scorer([], [], {}))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id] or "")
        assert r.spans == ",".join(want)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PATTERNS]


def test_pii_trees_add_and_keep_base(spark):
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = []
    for _ in range(300):
        texts.append(f"please call +1 ({digits(3)}) {digits(3)}-{digits(4)} today")
        texts.append(f"the count was {digits(8)} and then {digits(9)} rows")
    for _ in range(20):
        texts.append(f"please call 1 ({digits(3)}) {digits(3)}-{digits(4)} today")
    docs = documents(spark, texts, clash=True)
    scorer = pii.fit(docs.where("doc_id < 600"))
    assert set(scorer.thresholds) == {"phone"}
    rows = {r.doc_id: r for r in pii.pii_digests(pii.find_pii(docs, scorer)).collect()}
    assert all(rows[i].spans.startswith("phone:12:") and rows[i].n_phone == 0 for i in range(600, 620))
    assert all(rows[i].spans == "" for i in range(1, 600, 2))
    done = pii.redact(docs, scorer)
    assert done.columns == docs.columns
    assert {r.text for r in done.where("doc_id % 2 = 0 AND doc_id < 600").collect()} == {"please call [PHONE] today"}
    assert done.where("n_chars <> length(text)").count() == 0
    assert pii.redact(docs.limit(0), scorer).count() == 0 and pii.fit(docs.limit(0)).thresholds == {}


def test_pii_trees_fitted_on_the_full_table_add_other_forms(spark):
    rng = random.Random(19)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for _ in range(150):
        texts += [f"please call +1 ({digits(3)}) {digits(3)}-{digits(4)} today", f"mail {name()}@{name()}.com now", f"the count was {digits(8)} and then {digits(9)} rows"]
        texts += [f"please call 1 ({digits(3)}) {digits(3)}-{digits(4)} today", f"mail {name()} (at) {name()} (dot) com now", f"we met at {name()}.{name()} then"]
    docs = documents(spark, texts)
    spans = {r.doc_id: r.spans for r in pii.pii_digests(pii.find_pii(docs)).collect()}
    for i in range(0, len(texts), 6):
        assert spans[i + 3].startswith("phone:12:") and spans[i + 4].startswith("email:5:")
        assert spans[i + 2] == spans[i + 5] == ""


def test_redaction_of_overlapping_spans_and_nulls(spark):
    df = spark.sql("SELECT 'éabcdef' AS text, array(named_struct('kind','ip','start',1L,'end',4L), named_struct('kind','card','start',3L,'end',5L)) AS spans")
    assert df.select(pii.redacted(F.col("text"), F.col("spans"))).first()[0] == "é[IP]ef"
    out = pii.redact(documents(spark, [None, "", "plain"]), pii.Scorer([], [], {})).collect()
    assert [r.text for r in sorted(out, key=lambda r: r.doc_id)] == [None, "", "plain"]


# 4: decontamination ----------------------------------------------------------


def brute_leaks(docs, items):
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    out = set()
    for i, t in docs:
        ws = split(t)
        for j, b in items:
            it = split(b)
            n = len(it)
            if n < 5:
                continue
            for shift in range(-n + 1, len(ws)):
                eq = [0 <= shift + k < len(ws) and ws[shift + k] == it[k] for k in range(n)]
                inside = lambda a, m: a >= 0 and shift + a >= 0 and shift + a + m <= len(ws) and a + m <= n  # noqa: E731, B023
                if n < 12:
                    hit = all(eq)
                else:
                    hit = any(inside(a, 12) and sum(all(eq[a + g : a + g + 4]) for g in (0, 4, 8)) >= 2 for a in range(n - 11))
                m = min(16, n)
                if hit and any(sum(eq[s : s + m]) * 5 >= m * 4 for s in range(n - m + 1)):
                    out.add((i, j))
    return out


def test_leaks_match_brute_force(spark):
    rng = random.Random(7)
    items = [(j, " ".join(prose(rng, n, 10**6))) for j, n in enumerate([3, 5, 8, 12, 13, 20, 30, 45])] + [(90, None), (91, ""), (None, " ".join(prose(rng, 20, 10**6)))]
    items.append((92, items[5][1].upper()))
    docs = []
    for i in range(120):
        body = prose(rng, rng.randrange(0, 60), 10**6)
        if i % 2:
            part = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randrange(0, 6)):
                if part:
                    part[rng.randrange(len(part))] = "sub"
            cut = rng.randrange(0, 8) if i % 4 == 1 else 0
            at = rng.randrange(len(body) + 1)
            body[at:at] = part[cut:]
        docs.append((i, " ".join(body)))
    docs += [(200 + k, t) for k, t in enumerate(ODD)]
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    d = documents(spark, [t for _, t in docs], [i for i, _ in docs], clash=True)
    rows = decontaminate.leaks(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute_leaks(docs, items)
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows}) > 20
    kept = decontaminate.without_leaks(d, b)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {r.doc_id for r in rows}
    assert decontaminate.leaks(d.limit(0), b).count() == 0 and decontaminate.leaks(d, b.limit(0)).count() == 0


def test_leaks_beyond_the_broadcast_bounds(spark, monkeypatch):
    rng = random.Random(8)
    item = " ".join(prose(rng, 30, 10**6))
    d, b = documents(spark, [f"a b c {item} d", "x y z"]), spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_ITEM_BYTES", -1)
    assert [(r.doc_id, r.item_id, r.n_equal, r.doc_start) for r in decontaminate.leaks(d, b).collect()] == [(0, 1, 30, 3)]


def test_whole_seeds_find_all_that_the_overlay_accepts(spark):
    rng = random.Random(18)
    items = [(n, " ".join(prose(rng, n, 10**6))) for n in [*range(4, 18), 24, 40]]
    texts = []
    for n, t in items:
        for k in range(16):  # as many other words as the overlay accepts, anywhere, within or over either end
            part = t.split()
            for at in rng.sample(range(n), min(n, 16) // 5) if k % 4 < 3 else range(k // 4, n, 6):
                part[at] = "sub"
            lost = rng.randrange(3) if k % 4 == 2 else 0
            texts.append(" ".join([*prose(rng, k % 4 % 2 * 7, 10**6), *part[lost:]] if k < 8 else [*part[: n - lost], *prose(rng, k % 4 % 2 * 7, 10**6)]))
    want = set()
    for i, t in enumerate(texts):
        ws = t.split()
        for n, b in items[1:]:
            for shift in range(-n + 1, len(ws)):
                eq = [0 <= shift + k < len(ws) and ws[shift + k] == w for k, w in enumerate(b.split())]
                if any(sum(eq[s : s + 16]) * 5 >= min(16, n) * 4 for s in range(max(1, n - 15))):
                    want.add((i, n))
    d, b = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b, decontaminate.whole_seeds).collect()}
    assert got == want and len(want) > 150
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()} < want
    kept = decontaminate.without_leaks(d, b, decontaminate.whole_seeds)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in want}


def test_a_long_document_with_many_leaks_fits_in_memory(spark):
    rng = random.Random(19)
    items = [" ".join(prose(rng, 30, 10**6)) for _ in range(450)]
    text = " ".join(" ".join([*prose(rng, 18, 10**6), t]) for t in items)  # met by some 100 seeds a leak, which each kept its 21,600 words
    d, b = documents(spark, [text, "x", text], [0, 1, 0]), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.leaks(d, b, decontaminate.whole_seeds).collect()
    assert sorted((r.item_id, r.doc_id, r.n_equal, r.n_words, r.doc_start) for r in rows) == [(k, 0, 30, 30, 48 * k + 18) for k in range(450)]


# 5: chat ---------------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(9)
    bits = ["<s>[", "</s>", "<t>", "]", "[", "\\", "\\e", "\\l", "hi", "é", "\n", " ", "<", "[INST]", ""]
    rows = []
    for c in range(40):
        for t in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "a]b</s>"])
            rows.append((c, rng.choice([t, t, 3, None]), role, rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(8)))])))
    rows += rows[:5] + [(None, 1, "user", "x"), (50, 1, "assistant", "y" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(df)).collect()}
    chats = {r.conv_id: r for r in chat.format_chats(df).collect()}
    groups: dict = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, turns in groups.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(chats[c].formatted)
        assert "".join(s.text for s in chats[c].segments) == chats[c].formatted
        blocks = sum(k == 0 or turns[k - 1][1] != turns[k][1] for k in range(len(turns)))
        assert chats[c].formatted.count("<s>[") == chats[c].formatted.count("</s>") == blocks
    assert chat.format_chats(df.limit(0)).count() == 0


# 6: language -----------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    rng = random.Random(10)
    syllables = {"aa": "ka to mi re".split(), "bb": "sch ung pf tz".split(), "cc": "ción lla osé ue".split()}
    rows = []
    for i in range(600):
        lang = rng.choice(list(syllables))
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(words), lang))
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "12 34 !", "bb"), (1003, "schung", None), (1003, "schung", None), (None, "kato", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = language.language_rows(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = {i: lang for i, _, lang in rows[:600]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[1000] == by[1001] == by[1002] == "und" and by[1003] == "bb" and by[None] == "aa"
    assert all((r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == bool(r.held_out) for r in got)
    assert language.language_rows(df.limit(0)).count() == 0


def test_every_language_is_learned_from_its_own_rows(spark):
    rng = random.Random(20)
    say = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    common_, rare = "ka to mi re".split(), "sch ung pf tz".split()
    rows = [(i, say(common_, 20), "aa") for i in range(2_000)] + [(5_000 + i, say(rare, 40), "bb") for i in range(3)]
    filters = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=50)
    assert filters.languages == ["aa", "bb"]
    assert [x for x, _ in filters.predict([say(rare, 30).encode(), say(common_, 30).encode()])] == ["bb", "aa"]


def test_filters_answer_for_many_languages():
    rng = np.random.default_rng(1)
    profiles = {f"l{i:03}": rng.integers(0, 1 << 40, 50).astype(np.uint64) for i in range(70)}
    f = language.Filters(profiles)
    for i, lang in enumerate(f.languages):
        a, b = f._probes(profiles[lang])
        assert f._bit(f.masks[a] & f.masks[b], i).all()
    assert language.Filters({}).predict([b"x"]) == [("und", 0.0)]


# 7: neighbours ---------------------------------------------------------------


def brute_nearest(rows, k):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8})
    x = np.array([v for _, v in good])
    ids = np.array([i for i, _ in good])
    out = {}
    for i, v in good:
        if i % 20 == 0:
            s = x @ np.array(v)
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("n", [15, 1500])
def test_neighbours_recall_ties_and_odd_rows(spark, n):
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((10, 8))
    rows = [(i, (centres[i % 10] + 0.5 * rng.standard_normal(8)).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(n // 3)]  # a group of copies
    rows += [(9000, None), (9020, [0.0] * 8), (9040, [float("nan")] + [1.0] * 7), (9060, [None] + [1.0] * 7), (9080, [1.0, 2.0]), (None, [1.0] * 8), (9100, [float("inf")] * 8), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(1))
    got: dict = {}
    for r in neighbours.nearest(df, lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, 20)
    assert got.keys() == want.keys()
    recall = []
    vec = {i: np.array(v) for i, v in rows if i is not None and i < 9000}
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1)) and len(found) == len(want[q])
        assert all(abs(vec[q] @ vec[v] - s) < 1e-9 for _, v, s in found)
        assert all((-round(a[2], 12), a[1]) <= (-round(b[2], 12), b[1]) or abs(a[2] - b[2]) < 1e-9 for a, b in zip(found, found[1:]))
        least = want[q][-1][1]
        recall.append(np.mean([s >= least - 1e-9 for _, _, s in found]))
    assert np.mean(recall) >= 0.9
    assert neighbours.nearest(df.limit(0), lambda c: c % 20 == 0).count() == 0


def test_best_of_a_block_bounds_ties_and_floors():
    rng = np.random.default_rng(4)
    v = rng.integers(-1, 2, (300, 4)).astype(float)  # many equal scores
    q = np.concatenate((rng.integers(-1, 2, (40, 4)).astype(float), np.zeros((1, 4))))
    ids = rng.permutation(300)
    least = np.where(np.arange(41) % 3 == 0, 1.0, -np.inf)
    row, col, score = neighbours.best_of(q, v, ids, least, 5, chunk=16)
    for i in range(41):
        s = q[i] @ v.T
        want = [j for j in np.lexsort((ids, -s)) if s[j] >= least[i]][:5]
        assert col[row == i].tolist() == want and np.allclose(score[row == i], s[want])
    assert len(neighbours.best_of(q, v[:0], ids[:0], least, 5)[0]) == 0


def test_neighbour_lists_are_balanced():
    x = np.random.default_rng(5).standard_normal((4000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = neighbours.build(x, 1.0, 40)
    first = np.argmin(neighbours._squares(index.lift(x), index.centroids) + index.price, axis=1)
    assert np.bincount(first, minlength=40).max() <= 2.5 * 100
    row, kept = index.lists_of(x)
    assert set(row) == set(range(4000)) and np.bincount(row).max() <= neighbours.REPLICAS


def test_neighbours_searched_by_chunks_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {tuple(r) for r in neighbours.nearest(df, lambda c: c % 20 == 0).select("query_id", "rank", "vec_id").collect()}
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 10)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    assert {tuple(r) for r in neighbours.nearest(df, lambda c: c % 20 == 0).select("query_id", "rank", "vec_id").collect()} == whole


# 8: secrets ------------------------------------------------------------------


def test_secret_rules_match_the_plain_patterns(spark):
    rng = random.Random(11)
    bits = ["password", "ToKeN", "api_key", "apikey", "secret", ":", "=", " ", '"', "'", "abc", "deadbeef" * 3, "AKIA", "ABCDEFGHIJ0123456789", "ſecret", "toKen", ".", "x", "\n", "0123456789abcdef"]
    texts = list(ODD) + ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(800)]
    rows = secrets.secret_digests(secrets.scan_secrets(documents(spark, texts, clash=True))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == secrets.brute_digest(texts[r.doc_id] or "")
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert spans == sorted(spans, key=lambda s: (int(s[1]), secrets.KINDS.index(s[0])))
    assert sum(r.n_assign for r in rows) > 20 and sum(r.n_access for r in rows) > 5 and sum(r.n_hex for r in rows) > 20


def test_guess_cost_orders_values():
    bits = secrets.guess_bits
    assert bits("password") < bits("password1999") < bits("pqxwvord1999") < bits("k8$Zq!vT2#Lm")
    assert bits("aaaaaaaaaaaa") < 20 and bits("qwertyuiop") < 30 and bits("1234567890") < 30 and bits("20240131") < 17
    assert bits("P@ssw0rd") < 15 < 60 < bits("k8$Zq!vT2#Lm")
    found = secrets.find_secrets("the pwd is k8$Zq!vT2#Lm and pwd is password1999 too")
    assert [f[:3] for f in found] == [("guess", 11, 23)]


def test_values_of_letters_only_are_priced():
    find = lambda t: [f[:3] for f in secrets.find_secrets(t)]
    assert find("the pwd is XkqzPvWmTtrJhB today") == [("guess", 11, 25)]
    assert find("pin: vbxqjzkwplmgt") == [("guess", 5, 18)] and find("pwd is 'vbxqjzkwplmgt'") == [("guess", 8, 21)]
    assert find("the login is vbxqjzkwplmgthrcd now") == [("guess", 13, 30)]
    assert find("the login is required and the pin is Forgotten, pwd with password") == []


def test_guess_cost_is_the_cheapest_segmentation():
    # all segmentations of lower-case letters into words, repeats, walk steps and single letters, from the end
    def brute(v):
        cost = [np.inf] * len(v) + [0.0]
        for i in reversed(range(len(v))):
            ways = [np.log2(26) + cost[i + 1]]
            ways += [1 + np.log2(secrets.RANK[v[i:j]]) + cost[j] for j in range(i + 3, len(v) + 1) if v[i:j] in secrets.RANK]
            ways += [1 + cost[i + n] for n in (1, 2, 3, 4) if i >= n and i + n <= len(v) and v[i - n : i] == v[i : i + n]]
            if i and (v[i] in secrets.NEAR[v[i - 1]] or abs(ord(v[i]) - ord(v[i - 1])) == 1):
                ways.append(1.5 + cost[i + 1])
            cost[i] = min(ways)
        return cost[0]

    rng = random.Random(17)
    for _ in range(300):
        v = "".join(rng.choice([rng.choice(secrets.COMMON), rng.choice("abcxyz"), rng.choice("qwerty") * 2, "abab"]) for _ in range(rng.randrange(1, 6)))
        assert secrets.guess_bits(v) == pytest.approx(brute(v))


# 9: SimHash ------------------------------------------------------------------


def brute_components(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def to_signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_links_and_components_match_brute_force(spark):
    rng = random.Random(12)
    fps = [rng.getrandbits(64) for _ in range(60)] + [0, 1, 3, (1 << 64) - 1, 1 << 63]
    for _ in range(200):  # chains of changes, close and just too far
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.choice([1, 2, 3])):
            f ^= 1 << b
        fps.append(f)
    base = rng.getrandbits(64)
    fps += [base ^ sum(1 << b for b in rng.sample(range(20), rng.randrange(1, 6))) for _ in range(300)]  # a hot list
    want = brute_components(fps)
    df = spark.createDataFrame([(to_signed(f),) for f in sorted(set(fps))], "fp long")
    for longest in (64, 4):
        nodes = {r.node: r.root for r in simhash.components(simhash.links(df, longest)).collect()}
        groups: dict = {}
        for f in set(fps):
            groups.setdefault(nodes.get(to_signed(f), to_signed(f)), set()).add(f)
        truth: dict = {}
        for f, r in want.items():
            truth.setdefault(r, set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, truth.values()))


def plain_fingerprint(text):
    import xxhash

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_near_duplicates_of_documents(spark):
    rng = random.Random(13)
    texts = ODD + [" ".join(prose(rng, rng.randrange(1, 80))) for _ in range(60)] + ["É one TWO", "é one two"]
    texts += [texts[20], texts[21].upper(), "", "a b", "a\tb"]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    ids[3] = None
    docs = documents(spark, texts, ids, clash=True)
    rows = simhash.fingerprint_digests(simhash.near_duplicates(docs)).collect()
    assert len(rows) == len(texts)
    fps = {i: plain_fingerprint(t) for i, t in zip(ids, texts)}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fps.items()}
    root = brute_components(list(fps.values()))
    least: dict = {}
    for i, f in fps.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert {r.doc_id: r.component_id for r in rows} == {i: least.get(root[f]) for i, f in fps.items()}
    kept = simhash.one_of_each(docs.unionAll(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([*least.values(), *([-1] if root[fps[None]] not in least else [])])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# 10: quality -----------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    rng = random.Random(14)
    texts, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randrange(20, 120))
        bad = i % 4 == 0
        texts.append(" ".join(w.upper() + "!!" if bad else w for w in words) + "." * (not bad))
        labels.append((i, int(not bad), 0))
    n = len(texts)
    texts += ODD
    docs = documents(spark, texts, clash=True)
    marks = spark.createDataFrame(labels + [(n, None, None), (None, 1, 0), (10**6, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_rows(docs, marks).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [i for i in range(n) if got[i].held_out]
    assert len(held) > 80 and np.mean([got[i].predicted == labels[i][1] for i in held]) > 0.97
    assert 0.5 < got[n].score == got[n + 1].score < 1  # null and empty: the sample's share of label 1
    voter = quality.fit(docs, marks)
    kept = quality.keep_quality(docs, voter)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(n) if i % 4}
    assert {r.score for r in quality.quality_rows(docs, marks.limit(0)).collect()} == {0.5}
    assert quality.quality_rows(docs.limit(0), marks).count() == 0


def test_quality_told_by_words_alone(spark):
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    good, bad, any_ = ([word() for _ in range(40)] for _ in range(3))
    rows = [(i, " ".join(rng.choice(any_ if k % 2 else bad if i % 3 == 0 else good) for k in range(40)), int(i % 3 != 0)) for i in range(400)]
    docs, marks = documents(spark, [t for _, t, _ in rows]), spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = [r for r in quality.quality_rows(docs, marks).collect() if r.held_out]
    assert len(got) > 80 and np.mean([r.predicted == rows[r.doc_id][2] for r in got]) > 0.97


def test_votes_match_brute_force():
    rng = random.Random(15)
    marks = ".,!?;:*#"
    texts = ["".join(w + rng.choice(marks) * rng.randrange(3) + " " for w in prose(rng, rng.randrange(5, 60))).encode() for _ in range(120)]
    texts[50:60] = texts[40:50]  # ties
    counts, labels = quality.terms(texts), np.array([rng.randrange(2) for _ in texts], np.float32)
    v = quality.Voter(counts[:100], labels[:100], latent=8, neighbours=5)
    z = v._project(quality.weighted(counts, v.idf)).astype(np.float64)
    for i, s in enumerate(v.score(counts)):
        cosine = z[:100] @ z[i]
        voters = cosine >= np.sort(cosine)[-5] - quality.TIE
        w = np.where(voters, np.exp(20 * (cosine - cosine.max())), 0)
        assert s == pytest.approx((w * labels[:100]).sum() / w.sum(), abs=1e-3)


# shared ----------------------------------------------------------------------


def test_words_and_windows():
    rng = random.Random(16)
    texts = [" ".join(prose(rng, n, 20)).encode() for n in (0, 1, 5, 30, 200)] + ["é\t\nñ  漢  x".encode(), b"  "]
    w = common.Words(texts)
    assert [w.data[s:e] for s, e in zip(w.start, w.end)] == [x for t in texts for x in t.split()]
    assert w.count.tolist() == [len(t.split()) for t in texts]
    at, key = w.windows(3)
    grams = [tuple(t.split()[i : i + 3]) for t in texts for i in range(len(t.split()) - 2)]
    assert len(at) == len(grams)
    seen: dict = {}
    for g, k in zip(grams, key.tolist()):
        assert seen.setdefault(g, k) == k
    assert len(set(seen.values())) == len(seen)


def test_text_batches_bounds():
    import pyarrow as pa

    texts = ["x" * n for n in (0, 5, 100, 3, 3, 3, 250, 1)] + [None] * 50
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    out = list(common.text_batches([batch, batch], limit=100, rows=20))
    assert [i for t, _ in out for i in t.column("doc_id").to_pylist()] == list(range(len(texts))) * 2
    assert all(t.num_rows <= 20 and (sum(map(len, b)) <= 100 or t.num_rows == 1) for t, b in out)
    assert [x for _, b in out for x in b] == [(t or "").encode() for t in texts] * 2
