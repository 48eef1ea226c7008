"""Each operator against a brute-force version, and its edge cases."""

import datetime
import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm import chat_format, components, decontamination, language_id, line_dedup, packing, personal_data, quality_rules, secret_scan, simhash_dedup, suffix_dedup
from tallyspark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __row string, key string, words string"


def frame(spark, texts, langs=None):
    """Documents with extra columns whose names an operator might use."""
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "s", len(t or ""), "r", "k", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


EDGES = [None, "", " \n\t", "a", "é" * 300, "x y " * 3000, "same text here", "same text here", "9" * 3000, "\x00 b"]


# suffix dedup


def repeats(texts):
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [3, 20_000])
def test_suffix_dedup(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ab c") for _ in range(700)) for _ in range(4)]
    texts = [*EDGES, "a" * 199, "a" * 200, "ab" * 300, "abc" * 67]
    for _ in range(40):
        b = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2])):
            b[rnd.randrange(len(b))] = rnd.choice("xyzé")
        texts.append("".join(b)[rnd.choice([0, 0, 300]) :] + rnd.choice(["", base[0][100:350]]))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(repeats([(t or "").encode() for t in texts])))


# quality


def test_quality_edges(spark):
    rows = {r.doc_id: r for r in quality_rules.score_quality(frame(spark, [*EDGES, "the cat and the dog sat in a garden of green grass " * 2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 the w11"])).collect()}
    assert all(rows[k].n_words == 0 and rows[k].base_failed and not rows[k].kept for k in range(3))
    assert rows[5].n_words == 6000 and rows[5].n_repeat_words == 6000
    assert rows[10].n_repeat_words == 24 and not rows[10].kept
    assert rows[11].n_repeat_words == 0 and rows[11].kept


# packing


@pytest.mark.parametrize("range_bytes", [24_000_000, 3_000])
def test_packing_round_trip(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(packing, "RANGE_BYTES", range_bytes)
    texts = [*EDGES, "Hello  world,\n I'm <|endoftext|> here ² 日本 " * 400, *["Some text number %d." % k for k in range(50)]]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
    rows = packing.pack(frame(spark, texts), with_ids=True).collect()
    got, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.setdefault(r.doc_id, [])) and r.length == len(r.ids) > 0 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got[r.doc_id] += r.ids
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    lengths = []
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        lengths.append(at)
    assert max(lengths) <= 1024 and sum(n < 1024 for n in lengths) <= 1
    assert packing.pack(frame(spark, ["x"]).limit(0)).count() == 0


def test_ranges_hold_like_bytes(spark, monkeypatch):
    rnd = random.Random(12)
    whole = 1 << packing.KEY_BITS
    keys = [rnd.randrange(whole) for _ in range(2000)] + [(7 << 40) + rnd.randrange(1 << 20) for _ in range(3000)] + [99 << 30] * 500  # a dense place, and equal keys
    rows = spark.createDataFrame([(k, rnd.choice([0, 5, 20])) for k in keys], "key long, bytes long").cache()
    for cells, first in ((1 << 20, 16), (64, 4)):
        monkeypatch.setattr(packing, "CELLS", cells)
        monkeypatch.setattr(packing, "FIRST_BITS", first)
        bounds = packing.range_bounds(rows, 500, 1000)
        assert bounds == sorted(set(bounds))
        held = np.zeros(len(bounds) + 1)
        for r in rows.collect():
            held[np.searchsorted(bounds, r.key, side="right")] += r.bytes
        single = sum(r.bytes for r in rows.filter(f"key = {99 << 30}").collect())
        assert sorted(held)[-2] <= 1000 and held.max() <= single + 500 and len(held) < 2.2 * held.sum() / 500
        assert len(packing.range_bounds(rows, 500, 10)) < 20
    assert packing.range_bounds(rows.limit(0), 500, 10) == []


def test_hilbert_neighbours():
    side = np.arange(8)
    points = np.array([(x, y, z) for x in side for y in side for z in side])
    order = points[np.argsort(packing.hilbert(points, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


# line dedup


def test_line_dedup(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    own = [[" ".join(word() for _ in range(9)) for _ in range(4)] for _ in range(12)]
    texts = ["\n".join([own[k][0], f"Page {k} of the annual report printed on day {k * 7}", own[k][1], "Licensed under these terms by all of us", *own[k][2:]]) for k in range(12)]
    texts += [None, "", "short line\nshort line", *["\n".join(own[0])] * 8]
    rows = {r.doc_id: r for r in line_dedup.drop_recurring_lines(frame(spark, texts)).collect()}
    for k in range(12):
        assert rows[k].text == "\n".join(own[k]) and rows[k]["__n_dropped"] == 2
    assert rows[12].text is None and rows[13].text == "" and rows[14].text == texts[14] and rows[12]["__n_lines"] == 0 and rows[14]["__n_lines"] == 2
    assert all(rows[k].text == texts[k] for k in range(15, 23))  # copies keep their lines
    assert rows[0].words == "w" and rows[0]["__n_lines"] == 6


def test_line_fields_without_digits(spark):
    names = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rnd = random.Random(2)
    other = lambda: " ".join("".join(rnd.choice("klmnop") for _ in range(5)) for _ in range(8))
    texts = [f"{other()}\nThis page was last saved by {n} in the office\n{other()}" for n in names]
    rows = line_dedup.drop_recurring_lines(frame(spark, texts)).collect()
    assert all("last saved" not in r.text and r.text.count("\n") == 1 for r in rows)
    assert line_dedup.drop_recurring_lines(frame(spark, ["x"]).limit(0)).count() == 0


def test_lines_in_blocks_paragraphs_and_copies(spark):
    rnd = random.Random(12)
    prose = lambda: " ".join("".join(rnd.choice("klmnopqrst") for _ in range(6)) for _ in range(9))
    block, paragraph, notice = [prose() for _ in range(4)], prose(), prose()
    own = [[prose() for _ in range(2)] for _ in range(24)]
    texts = ["\n".join([own[k][0], *block, own[k][1]]) for k in range(8)]
    texts += ["\n\n".join([own[k][0], paragraph, own[k][1]]) for k in range(8, 16)]
    texts += ["\n".join([own[k][0], notice, own[k][1]]) for k in range(16, 24)]
    copied = "\n".join([prose(), notice, prose()])
    texts += [copied] * 200
    rows = {r.doc_id: r for r in line_dedup.drop_recurring_lines(frame(spark, texts)).collect()}
    assert all(rows[k].text == "\n".join(own[k]) for k in [*range(8), *range(16, 24)])
    assert all(rows[k].text == "\n\n\n".join(own[k]) for k in range(8, 16))
    first, _, last = copied.split("\n")
    assert all(rows[k].text == f"{first}\n{last}" for k in range(24, 224))


def test_short_lines_fields_and_long_texts(spark):
    rnd = random.Random(21)
    prose = lambda: " ".join("".join(rnd.choice("klmnopqrst") for _ in range(6)) for _ in range(9))
    own = [prose() for _ in range(10)]
    texts = [f"{own[k]}\nShare this page\n{k * 31}\nMenu\nwe do not {'abcdefghij'[k] * 4}" for k in range(10)]
    long = "\n".join(prose() for _ in range(4000))
    rows = {r.doc_id: r for r in line_dedup.drop_recurring_lines(frame(spark, [*texts, long + "\nMenu"])).collect()}
    # short lines go; a line of fields alone and lines that share their leading tokens alone stay
    assert all(rows[k].text == f"{own[k]}\n{k * 31}\nwe do not {'abcdefghij'[k] * 4}" for k in range(10))
    assert rows[10].text == long and rows[10]["__n_dropped"] == 1


# language


def test_gradients():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in language_id.start_weights(3, rng).items()}
    letters, target = rng.integers(97, 105, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = language_id.step_gradients(w, letters, target)
    for k, v in w.items():
        at = (int(letters[0, 1]), 4) if k[0] == "x" else tuple(n // 2 for n in v.shape)
        old, e = v[at], 1e-5
        v[at] = old + e
        up, _ = language_id.step_gradients(w, letters, target)
        v[at] = old - e
        down, _ = language_id.step_gradients(w, letters, target)
        v[at] = old
        assert abs((up - down) / 2 / e - grads[k][at]) < 1e-7


def brute_language(model, text):
    """(language, score) of a text by a byte-at-a-time network."""
    w, n = model["weights"], language_id.HIDDEN
    data = [48 if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b for b in text.encode()]

    def states(d, part):
        h, out = np.zeros(n), []
        for b in part:
            x, a = w[f"x{d}"][b].astype(float), h @ w[f"u{d}"]
            z, r = 1 / (1 + np.exp(-(x[:n] + a[:n]))), 1 / (1 + np.exp(-(x[n : 2 * n] + a[n : 2 * n])))
            h = z * h + (1 - z) * np.tanh(x[2 * n :] + r * a[2 * n :])
            out.append(h)
        return out

    total = 0
    for s in range(0, len(data), 256):
        low, high = max(0, s - 24), min(len(data), s + 280)
        forward, backward = states("f", data[low:high]), states("b", data[low:high][::-1])[::-1]
        for k in range(s, min(len(data), s + 256)):
            logits = forward[k - low] @ w["vf"] + backward[k - low] @ w["vb"] + w["c"]
            total = total + logits - np.log(np.exp(logits).sum())
    p = np.exp(total / len(data))
    return model["languages"][int(p.argmax())], p.max() / p.sum()


def test_language_predictions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    texts = [r.text for r in docs.orderBy("doc_id").limit(25).collect()] + ["a", "The 12 and <b>", "é", "und " * 300, "x" * 257]
    got = {r.doc_id: r.p for r in frame(spark, texts).select("doc_id", language_id.predictor(model)(F.col("text")).alias("p")).collect()}
    for k, t in enumerate(texts):
        name, score = brute_language(model, t)
        assert got[k].lang_pred == name and abs(got[k].score - score) < 1e-3


def test_rare_languages_are_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rare = spark.createDataFrame([(8, "qzxv wkzq vvzx qqkz " * 900, "xx")], "doc_id long, text string, lang string")
    model = language_id.train(docs.union(rare))
    assert "xx" in model["languages"]
    assert rare.select(language_id.predictor(model)(F.col("text")).alias("p")).first().p.lang_pred == "xx"


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [None, "12 34 !", "", "½ ²", "①", "Ⅷ ٣", "\u0301"]
    extra = spark.createDataFrame([(10**6 + k, t, "en") for k, t in enumerate(odd)], "doc_id long, text string, lang string")
    found = language_id.identify_languages(docs.select("doc_id", "text", "lang").union(extra)).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    held = [r for r in found if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in found if r.doc_id >= 10**6)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    none = language_id.identify_languages(extra.withColumn("lang", F.lit(None).cast("string")).withColumn("text", F.lit("abc")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


# secrets


def brute_secrets(text):
    t = text or ""
    a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, "assign", m.end()) for m in a.finditer(t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)).encode()).hexdigest()


def test_secrets(spark):
    rnd = random.Random(3)
    digits = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    texts = [*EDGES, 'PassWord = "hunter22" x', "token: abc", "é secret='ſſ' Secret=abcdefgh", "AKIASHORT", "x" + digits(30) + "G"]
    texts += [f"some words {key()} and api_key={digits(40)} then {digits(32)}." for _ in range(60)]
    loose = f"The ordinary words and {key()[4:]}{digits(3).upper()}7Q in a place without a name"
    found = {r.doc_id: r for r in secret_scan.find_secrets(frame(spark, [*texts, loose])).collect()}
    assert all(found[k].base_sha256 == brute_secrets(t) for k, t in enumerate(texts))
    at = loose.index("and ") + 4
    assert found[len(texts)].spans == f"format:{at}:{at + 21}"
    assert not any("format" in found[k].spans for k in range(len(EDGES)))


def test_bare_secrets_in_the_sample(spark):
    rnd = random.Random(9)
    digits = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + str(rnd.randrange(10)) for _ in range(12))
    bare = [key() for _ in range(80)]
    texts = [f"some words token={key()} and {x} then {digits(32)}." for x in bare]
    rows = secret_scan.find_secrets(frame(spark, texts)).collect()
    found = sum(f"format:{texts[r.doc_id].index(bare[r.doc_id])}:" in r.spans for r in rows)
    assert found >= 0.85 * len(bare)


def test_long_secrets(spark):
    rnd = random.Random(10)
    key = lambda n: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + str(rnd.randrange(10)) for _ in range(n // 2))
    texts = [f"some words token={key(rnd.randrange(40, 400))} in a place" for _ in range(80)]
    loose = f"some ordinary words {key(900)} in a place"
    found = {r.doc_id: r for r in secret_scan.find_secrets(frame(spark, [*texts, loose])).collect()}
    assert found[80].spans == "format:20:920"


def brute_formats(text, formats):
    """Added spans: tokens found character by character, scored by a walk through each automaton."""
    t, out, letters = text or "", [], set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
    base = [(m.start(), m.end()) for k, p in secret_scan.PATTERNS.items() for m in p.finditer(t) if len(m[0] if k != "assign" else m[2]) >= {"assign": 6, "access": 20, "hex": 24}[k]]
    k = 0
    while k < len(t):
        e = k
        while e < len(t) and (t[e] in letters or (e > k and t[e] == "." and e + 1 < len(t) and t[e + 1] in letters)):
            e += 1
        if e - k >= 6 and not any(s < e and k < f for s, f in base):
            symbols, reached = secret_scan.classes_of(t[k:e]), False
            for name, form in formats.formats.items():
                state, total, run, known, read = 0, 0.0, 0, True, ""
                for i, c in enumerate(symbols):
                    run, known = (run + 1, known) if i and symbols[i - 1] == c else (0, True)
                    steps, _, unseen = form.automaton.table[state]
                    c = read if run else c
                    if run < secret_scan.STATES and c not in steps:
                        c = ([x for x in secret_scan.WIDER[c] if x in steps] or [c])[0]
                    read = c
                    if run < secret_scan.STATES and c in steps:
                        total, state = total + steps[c][0], steps[c][1]
                    else:
                        known = known and run >= secret_scan.STATES
                        total -= np.log(secret_scan.SIZES[c]) - (0 if known else unseen)
                n, seen = e - k, form.lengths
                density = sum(v / sum(seen.values()) * np.exp(-0.5 * ((n - m) / (0.15 * m)) ** 2) / (0.15 * m * np.sqrt(2 * np.pi)) for m, v in seen.items())
                score = (total + form.automaton.table[state][1] + np.log(density + 1e-9) - sum(formats.rate[c] for c in symbols)) / n
                reached |= score >= formats.bars[name]
            if reached:
                out.append(f"format:{k}:{e}")
        k = max(e, k + 1)
    return out


MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def planted_secret(rnd, form):
    pick = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    if form == "dotted":
        return ".".join((pick(MIXED, 24), pick(MIXED, 30), pick(MIXED, 43)))
    if form == "prefixed":
        return "ghp_" + pick(MIXED, 36)
    if form == "uuid":
        return "-".join(pick("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))
    alphabet, n = form
    return pick({"mixed": MIXED, "hex": "0123456789abcdef", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "lower": "abcdefghijklmnopqrstuvwxyz0123456789"}[alphabet], n)


FORMS = {"long": [("mixed", 40), "dotted"], "short": [("mixed", 12), ("upper", 19)], "several": [("mixed", 12), ("mixed", 32), ("lower", 19), ("hex", 16), "prefixed", "uuid"]}


@pytest.mark.parametrize("forms", FORMS)
def test_planted_secrets_are_found(spark, forms):
    rnd = random.Random(31)
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(500).collect()]
    secret = lambda k: planted_secret(rnd, FORMS[forms][k % len(FORMS[forms])])
    texts = [f"{t} api_key={secret(k)}" if k < 200 else t for k, t in enumerate(prose)]
    planted = {k: secret(k) for k in range(250, 450)}
    texts = [f"{t} see {planted[k]} and (Donaudampfschifffahrtsgesellschaft or www.example.org/some/long/path/here, 2021-03-04)" if k in planted else t for k, t in enumerate(texts)]
    docs = frame(spark, texts)
    formats = secret_scan.learn(docs)
    rows = {r.doc_id: r.spans for r in secret_scan.find_secrets(docs, formats).collect()}
    added = {k: [x for x in rows[k].split(",") if x.startswith("format")] for k in rows}
    assert added == {k: brute_formats(t, formats) for k, t in enumerate(texts)}
    right = {k: f"format:{texts[k].index(x)}:{texts[k].index(x) + len(x)}" for k, x in planted.items()}
    for n in range(len(FORMS[forms])):
        mine = [k for k in right if k % len(FORMS[forms]) == n]
        assert sum(right[k] in added[k] for k in mine) >= 0.9 * len(mine), FORMS[forms][n]
    assert sum(map(len, added.values())) <= sum(right[k] in added[k] for k in right) / 0.9


def test_automaton_merges():
    a = secret_scan.Automaton(["UU" + "d" * n for n in range(4, 40)] * 3)
    assert len(a.table) < 12
    assert a.score("UUdddddddd") > a.score("dUdUdUdUdU")


# personal data


def brute_personal(text):
    t, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    for kind, pattern, valid in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([ -]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ):
        out.append([f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, t) if valid(m[0])])
    return [len(x) for x in out], hashlib.sha256(",".join(sum(out, [])).encode()).hexdigest()


def brute_added(text):
    """Spans of the further kinds, by Python's own patterns, dates and sums."""
    t, out, base = text or "", [], []
    for pattern, valid in ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), (r"[0-9]+(\.[0-9]+){3}", lambda m: all(int(x) <= 255 for x in m.split("."))), (r"[0-9]([ -]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and brute_luhn(m)), (r"\+[0-9][ ().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15)):
        base += [m.span() for m in re.finditer(pattern, t) if valid(m[0])]

    def account(m):
        turned = "".join(str(int(c, 36)) for c in m[4:] + m[:4])
        return len(m) == personal_data.ACCOUNT_LENGTHS.get(m[:2]) and int(turned) % 97 == 1

    def day(m):
        for form in ("%Y-%m-%d", "%d.%m.%Y"):
            try:
                return bool(datetime.datetime.strptime(m.replace("/", "."), form))
            except ValueError:
                pass
        return False

    for kind, score, pattern, context, valid in (
        ("iban", 80, r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "iban|account|konto|compte|cuenta|bank", account),
        ("card15", 45, r"3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}", "card|amex|karte|carte|tarjeta|credit|payment", brute_luhn),
        ("person_fr", 55, r"[12][0-9]{14}", "nir|insee|secu|social|assur", lambda m: 1 <= int(m[3:5]) <= 12 and int(m[:13]) % 97 + int(m[13:]) == 97),
        ("person_es", 45, r"[0-9]{8}-?[A-Z]", "dni|nif|documento|identidad|identity", lambda m: "TRWAGMYFPDXBNJZSQVHLCKE"[int(m[:8]) % 23] == m[-1]),
        ("person_us", 40, r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "ssn|social|security|taxpayer", lambda m: m[:3] not in ("000", "666") and m[0] != "9" and m[4:6] != "00" and m[7:] != "0000"),
        ("phone_local", 35, r"0[0-9]{1,4}[ /.-][0-9]{3,4}[ .-]?[0-9]{3,5}", "tel|phone|call|mobil|fax|anruf|llam", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 12),
        ("birth", 35, r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2})", "born|birth|geboren|geburt|nacid|nacim|naiss", day),
    ):
        for m in re.finditer(rf"(?<![A-Za-z0-9_]){pattern}(?![A-Za-z0-9_])", t):
            near = f"{t[max(0, m.start() - 48) : m.start()]} {t[m.end() : m.end() + 48]}".lower()
            value = score + 20 * bool(re.search(context, near)) - 30 * bool(re.search("order|invoice|version|isbn|serial|rechnung|factura|facture|article", near))
            if valid(m[0]) and value >= 50 and not any(s < m.end() and m.start() < e for s, e in base):
                out.append(f"{kind}:{m.start()}:{m.end()}={value / 100}")
    return out


def brute_luhn(m):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(re.sub("[^0-9]", "", m)))) % 10 == 0


def test_personal_data(spark):
    texts = [*EDGES, "a@b.c.d@e.f x@y.com_foo@z.org a@b@c.d ..@x.y a@b.c..d@e.f", "1.2.3.4.5.6.7 256.1.1.1 0255.01.1.1 9999999999999.1.1.1 é 10.0.0.1", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "+1 (555) 123-4567 +49.30.1234567- x +1 2 +123456789012345678", "+1 234 567 89 " * 300, "é@x.yz" * 400, "a" * 20000 + "@", " 1-2" * 4000]
    fill = " and so on for many more words that say nothing at all "
    texts += [fill.join(["amex card 378282246310005", "378282246310005", "NIR 255081416802538 x", "255081416802538", "invoice 255081416802538", "ssn 123-45-6789", "123-45-6789", "ssn 000-45-6789", "DNI: 12345678Z", "12345678Z", "DNI 12345678A"])]
    texts += [fill.join(["call 030 123 4567", "030 123 4567", "tel +44 0171 555 1234", "born 1990-02-30", "born 1990-02-03", "1990-02-03", "geboren am 3.2.1990", "order 3.2.1990 born", "né: naissance 13/12/1988", "FR7630006000011234567890189 GB82WEST12345698765432 GB83WEST12345698765432"])]
    texts += ["born 01.02.1990 and 03.04.1991", "ssn 123-45-6789, 223-45-6789", "born " + "1.1.1990 " * 60, "1.1.1990/" * 9 + " born"]
    assert [len(brute_added(t)) for t in texts[-4:]] == [2, 2, 5, 5]
    texts[-6:] = texts[-4:] + texts[-6:-4]  # the two before stay last
    texts.append("iban DE89370400440532013000 and DE88370400440532013000")
    rows = {r.doc_id: r for r in personal_data.find_personal_data(frame(spark, texts)).collect()}
    for k, t in enumerate(texts):
        n, digest = brute_personal(t)
        assert ([rows[k].n_email, rows[k].n_ip, rows[k].n_card, rows[k].n_phone], rows[k].base_sha256) == (n, digest), t[:50]
        added = [x for x in rows[k].scores.split(",") if x and x.split(":")[0] not in ("email", "ip", "card", "phone")]
        assert added == brute_added(t)
        assert [x.split("=")[0] for x in rows[k].scores.split(",")] == rows[k].spans.split(",")
    assert [len(brute_added(t)) for t in texts[-3:]] == [5, 6, 1]
    last = rows[len(texts) - 1]
    assert last.spans == "iban:5:27" and last.scores == "iban:5:27=1.0" and last.words == "w"


# near duplicates


def brute_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("crowd", [1, 32])
def test_simhash(spark, crowd):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    texts = [*EDGES]
    for _ in range(6):
        base = [rnd.choice(words) for _ in range(250)]
        for _ in range(25):
            copy = list(base)
            copy[rnd.randrange(250)] = "Edited"
            texts.append(" ".join(copy))
    rows = {r.doc_id: r for r in simhash_dedup.near_duplicates(frame(spark, texts), crowd=crowd).collect()}
    prints = [brute_print(t) for t in texts]
    assert [rows[k].fingerprint for k in range(len(texts))] == [f"{p:016x}" for p in prints]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert [rows[k].component_id for k in range(len(texts))] == [find(k) for k in range(len(texts))]


def test_native_hash_is_the_same(spark):
    x = spark.createDataFrame([("one two é",)], "t string").select(F.xxhash64("t")).first()[0]
    assert x % 2**64 == xxhash.xxh64_intdigest("one two é".encode(), 42)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (-5, 101), (7, 7), (300, 300)]
    got = {r.vertex: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and got[100] == got[101] == got[-5] == -5 and got[300] == 300


# decontamination


def test_decontamination(spark, monkeypatch):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    items = [[word() for _ in range(n)] for n in (40, 40, 25, 3)]
    prose = lambda n: [word() for _ in range(n)]
    worn = list(items[1])
    worn[0], worn[39] = "zzz", "qqq"
    bad = list(items[2])
    bad[5], bad[12], bad[20] = "zzz", "qqq", "xxx"
    texts = [*EDGES, " ".join(prose(50) + items[0] + prose(30)), "\n ".join([*prose(9), *worn, *prose(9)]).upper(), " ".join(prose(20) + bad + prose(20)), " ".join(items[3]), " ".join(prose(200))]
    bench = spark.createDataFrame([(k, " ".join(x), "t") for k, x in enumerate(items)] + [(9, None, "t")], "item_id long, text string, doc_id string")
    want = {}
    for k, t in enumerate(texts):
        words = (t or "").encode().lower().split()
        for i, item in enumerate(items):
            shingles = decontamination._shingles([x.encode() for x in item], 5)
            n = min(len(item), len(words))
            best = max(((decontamination.similarity(shingles, decontamination._shingles(words[p : p + n], 5)), -p) for p in range(len(words) - n + 1)), default=(0, 0))
            if best[0] >= 0.8:
                want[(k, i)] = (round(best[0], 6), -best[1])
    assert {(10, 0), (11, 1), (13, 3)} == set(want)
    for block in (4_000_000, 100):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
        assert {(r.doc_id, r.item_id): (round(r.similarity, 6), r.start) for r in decontamination.find_leaks(frame(spark, texts), bench).collect()} == want


def test_decontamination_radius(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    every = {tuple(r) for r in decontamination.find_leaks(docs, bench, radius=64).collect()}
    found = {tuple(r) for r in decontamination.find_leaks(docs, bench).collect()}
    assert len(every) > 20 and found == every


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(None, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, " ")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "x a b c d e f g"), (7, "a b c d e f g"), (7, "a b c d e f g"), (8, "a b c " * 50_000), (9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.similarity, r.start) for r in decontamination.find_leaks(docs, bench).collect()), key=repr)
    assert got == sorted([(None, None, 1.0, 1), (None, 1, 1.0, 1), (7, None, 1.0, 0), (7, None, 1.0, 0), (7, 1, 1.0, 0), (7, 1, 1.0, 0)], key=repr)
    assert decontamination.find_leaks(docs, bench.limit(0)).count() == 0 and decontamination.find_leaks(docs.limit(0), bench).count() == 0


def test_shared_shingles_are_no_probes(spark):
    common = " ".join(f"c{k}" for k in range(12))
    items = [(k, f"{common} " + " ".join(f"i{k}w{n}" for n in range(20))) for k in range(50)]
    known = decontamination.index([(k, t.encode()) for k, t in items], 5, 0.8, 22)
    assert np.diff(known["first"]).max() == 1  # no probe belongs to two items
    docs = spark.createDataFrame([(k, f"start {t} end") for k, t in items] + [(99, common * 3)], "doc_id long, text string")
    found = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(k, k) for k in range(50)]


# chat


CALLS = "conv_id long, call_id string, name string, arguments string, parents array<string>"
RESULTS = "conv_id long, call_id string, content string"


def test_chat_links(spark):
    calls = [(1, "a", "f", '{"n": 1, "s": "x"}', None), (1, "b", "f", '{"s": "y", "n": 2}', ["a"]), (1, "c", "f", '{"n": "z"}', ["b", None]), (1, "c", "f", '{"n": "z"}', ["b", None]), (2, "x", "f", None, ["y"]), (2, "y", "f", "not json", ["x"]), (3, "p", "f", '{"n":1,"s":"","q":0}', ["gone"]), (3, "q", "unknown", "{}", [])]
    results = [(1, "a", "one"), (1, "b", 'tw"o'), (1, "b", 'tw"o'), (4, "lost", "r")]
    schema = {"f": {"type": "object", "properties": {"n": {"type": "integer"}, "s": {"type": "string"}}, "required": ["n", "s"]}}
    linked = chat_format.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schema)
    got = {r.call_id: r for r in linked.collect()}
    assert {k: (r.status, r.level, r.valid, r.copies) for k, r in got.items()} == {
        "a": ("linked", 0, True, 1), "b": ("linked", 1, True, 1), "c": ("pending", 2, False, 2), "x": ("cyclic", None, False, 1), "y": ("cyclic", None, False, 1), "p": ("pending", 0, False, 1), "q": ("pending", 0, False, 1), "lost": ("orphan", None, False, 0),
    }
    assert got["b"].json == '{"arguments":{"n":2,"s":"y"},"id":"b","level":1,"name":"f","result":"tw\\"o","status":"linked","valid":true}'
    assert json.loads(got["lost"].json)["arguments"] is None


@pytest.mark.parametrize("group", [4000, 0, 40])
def test_chat_levels_with_several_parents(spark, group):
    rnd = random.Random(17)
    parents = {k: sorted(set(rnd.sample(range(k), min(k, rnd.choice([0, 1, 1, 1, 2, 3]))))) for k in range(40)}
    parents |= {k: [k - 1] for k in range(41, 60)} | {40: []}  # a chain
    parents |= {100: [101], 101: [102, 3], 102: [100], 103: [100, 5], 104: [103], 105: [200]}
    level = {}
    for k in range(60):
        level[k] = max((level[p] + 1 for p in parents[k]), default=0)
    level |= {100: None, 101: None, 102: None, 103: None, 104: None, 105: 0}
    conv = lambda k: None if k == 40 else "a" if k < 20 else "b" if k < 40 else f"c{k % 3}"
    rows = [(str(k), conv(k), [str(p) for p in ps] + [None, *(str(p) for p in ps[:1])]) for k, ps in parents.items()]
    got = {int(r.call_id): r.level for r in chat_format.levels(spark.createDataFrame(rows, "call_id string, conv_id string, parents array<string>"), group).collect()}
    assert got == level


def test_chat_levels_of_long_conversations(spark):
    rows = [(f"{c}-{k}", c, [f"{c}-{k - 1}", f"{c}-{k - 2}"]) for c in ("x", "y") for k in range(1000)]
    calls = spark.createDataFrame(rows, "call_id string, conv_id string, parents array<string>")
    began = time.monotonic()
    got = {r.call_id: r.level for r in chat_format.levels(calls).collect()}
    assert got == {f"{c}-{k}": k for c in ("x", "y") for k in range(1000)}
    assert time.monotonic() - began < 60  # rounds would take a second each


def test_chat_schemas(spark):
    schema = {"type": "object", "properties": {"k": {"enum": ["a", 1]}, "o": {"type": "object", "properties": {"x y": {"type": "number", "minimum": 0, "maximum": 2}}, "required": ["x y"]}, "l": {"type": "array", "items": {"type": "array", "items": {"type": "integer"}, "maxItems": 2}}, "b": {"type": "boolean"}, "s": {"type": "string", "minLength": 1, "maxLength": 3}, "any": {}, "free": {"type": "object", "additionalProperties": True}}, "required": ["k"]}
    good = ['{"k":"a"}', '{"k":1,"o":{"x y":1.5}}', '{"k":"a","l":[]}', '{"k":"a","l":[[1,2],[]]}', '{"k":"a","b":false,"s":"éèà"}', '{"k":"a","any":[{}],"free":{"z":{}}}']
    bad = ["{}", '{"k":"b"}', '{"k":"a","o":{}}', '{"k":"a","o":{"x y":3}}', '{"k":"a","o":{"x y":1,"z":1}}', '{"k":"a","l":[1]}', '{"k":"a","l":[[1.5]]}', '{"k":"a","l":[[1,2,3]]}', '{"k":"a","b":"true"}', '{"k":"a","s":""}', '{"k":"a","s":"abcd"}', '{"k":"a","s":1}', '{"k":"a","q":1}', "[]", "null", "", "{", None]
    rows = [(k, "f", x) for k, x in enumerate(good + bad)]
    got = {r.k: r.v for r in spark.createDataFrame(rows, "k int, n string, a string").select("k", chat_format.valid_arguments(F.col("n"), F.col("a"), {"f": schema}).alias("v")).collect()}
    assert {k for k, v in got.items() if v} == set(range(len(good)))
    with pytest.raises(ValueError, match="oneOf"):
        chat_format.fits(F.lit(1), {"oneOf": []})


def test_chat_on_empty_tables_and_lines(spark, tmp_path):
    calls, results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert chat_format.link_calls(calls, results, chat_format.TOOLS).count() == 0
    turns = spark.createDataFrame([(2, 0, "system", "s"), (2, 1, "user", "q" * 300_000), (2, 2, "assistant", None), (1, 0, "user", "two\nlines"), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    linked = chat_format.link_calls(*chat_format.conversation_calls(turns), chat_format.TOOLS, chat_format.other_turns(turns))
    chat_format.write_conversations(linked, str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert [x["id"] for x in lines] == [None, "1-0", "2-0", "2-1"] and lines[1]["arguments"] == {"at": {"size": "short", "turn": 0}, "lines": ["two", "lines"]}
    assert len(lines[3]["arguments"]["prompt"]) == 300_000


def test_chat_keeps_every_turn(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "tool", "t"), (1, 4, None, "n")]
    rows += [(None, 1, "user", "x"), (None, 1, "user", "y"), (None, 2, "assistant", "z"), (2, 1, "user", "b"), (2, 1, "user", "c"), (2, 2, "assistant", "d"), (2, 2, "assistant", "e")]
    calls, results = chat_format.conversation_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = chat_format.link_calls(calls, results, chat_format.TOOLS, chat_format.other_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    told = [((json.loads(r.json)["arguments"] or {}).get("prompt"), json.loads(r.json)["result"], r.status) for r in found]
    assert sorted(told, key=repr) == sorted([("q", "a", "linked"), (None, "be brief", "other"), (None, "t", "other"), (None, "n", "other"), ("x", None, "unidentified"), ("y", None, "unidentified"), (None, "z", "unidentified"), ("b", "d", "linked"), ("c", None, "duplicate"), (None, "e", "duplicate")], key=repr)
    assert {r.conv_id for r in found if r.status == "unidentified"} == {None}


# queries


ONE_ROW = {"op1_suffix_dedup", "op2_quality_rules", "op4_line_dedup", "op5_language_id", "op6_secret_scan", "op7_personal_data", "op8_simhash_dedup"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_small_tables(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    assert rows
    if name in ONE_ROW:
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("apply", [suffix_dedup.remove_repeats, quality_rules.score_quality, language_id.identify_languages, secret_scan.find_secrets, personal_data.find_personal_data, simhash_dedup.near_duplicates])
def test_empty_tables(spark, apply):
    assert apply(frame(spark, ["x"]).limit(0)).count() == 0
