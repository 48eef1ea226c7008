"""Periodic runs, phrase collocations and exact duplicates against brute-force versions, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import collocations, exact_dedup, periodic_runs
from tallyspark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, tag string, digest string, n string, block string, runs string"
EDGES = [None, "", " \n\t", "a", "é" * 300, "x y " * 3000, "same text here", "same text here", "\x00 b", " same  text here", "same text\there", "."]


def frame(spark, texts, langs=None, ids=None):
    """Documents with extra columns whose names an operator might use."""
    rows = [((ids or range(len(texts)))[i], t, (langs or ["en"] * len(texts))[i], "t", "d", "n", "b", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# periodic runs


def runs_in(w):
    found = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(24, 3 * q) and not any(all(w[s + j] == w[s + j + p] for j in range(n - p)) for p in range(1, q)):
                found.append((s, n, q))
    return sorted(found, key=lambda x: (x[0], x[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def strongest(runs):
    best = None
    for x in runs:
        if best is None or x[1] * best[2] > best[1] * x[2]:
            best = x
    return best


def periodic_texts():
    rnd = random.Random(3)
    texts = [*EDGES, "a " * 23, "a " * 24, "\tb a " * 60, ("a b " * 9 + "c ") * 5]
    for _ in range(120):
        w: list[str] = []
        for _ in range(rnd.choice([2, 4, 8])):
            unit = [rnd.choice("abcdef"[: rnd.choice([1, 2, 6])]) for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 16, 17, 33, 40]))]
            w += unit * rnd.choice([1, 1, 3, 4, 9, 30]) + [rnd.choice("xyz")] * rnd.choice([0, 1])
        texts.append(rnd.choice([" ", "\n", "\x0b"]).join(w[:400]))
    return texts


def test_runs(spark):
    texts = periodic_texts()
    got = {r.doc_id: r for r in periodic_runs.find_runs(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    total = 0
    for i, t in enumerate(texts):
        w = words_in(t)
        want = runs_in(w) if len(w) < 3000 else [(0, len(w), 2)]  # the long one of EDGES
        total += len(want)
        assert [tuple(x) for x in got[i].runs] == want
        assert got[i].n_words == len(w) and got[i].collapsed == collapsed(w, want)
        assert (tuple(got[i].strongest) if got[i].strongest else None) == strongest(want)
    assert total > 100


def test_runs_with_periods_whose_grams_repeat_within_them(spark):
    unit = ["a", "a", "b", "b"] * 20 + ["a", "b"] * 30 + ["c"]  # a period of 141 words, with runs of its own
    text = " ".join(unit * 4)
    (row,) = periodic_runs.find_runs(frame(spark, [text])).collect()
    assert [tuple(x) for x in row.runs] == runs_in(text.split())
    assert (0, 4 * len(unit), len(unit)) in [tuple(x) for x in row.runs]


def test_runs_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    some = 0
    for doc_id, text in docs.items():
        w, h = words_in(text), zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        row = rows[doc_id]
        runs = runs_in(w) if n <= 1500 or h % 10 else None
        if runs is None or n > 4000:
            continue  # brute force takes too long
        some += len(runs)
        best = strongest(runs)
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert some > 5


def test_runs_of_nothing(spark):
    empty = frame(spark, ["a"]).limit(0)
    assert periodic_runs.find_runs(empty).count() == 0
    rows = periodic_runs.find_runs(frame(spark, ["a " * 30] * 3, ids=[None, 7, 7])).collect()
    assert [tuple(r.strongest) for r in rows] == [(0, 30, 1)] * 3 and {r.collapsed for r in rows} == {"a"}
    assert periodic_runs.find_runs(frame(spark, [None], ids=[None]).select("doc_id", periodic_runs.planted(F.col("text"), F.col("doc_id")).alias("text"))).first().n_words == 0


# phrase collocations


def phrases_in(docs, least=10, best=2000):
    one, two, three, totals = Counter(), Counter(), Counter(), Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k, counts in ((1, one), (2, two), (3, three)):
                counts.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    of = lambda x: one[x] if len(x) == 2 else two[x]
    found = defaultdict(list)
    longer = defaultdict(int)
    for x, a in three.items():
        if a >= least:
            for part in ((x[0], *x[1:3]), (x[0], *x[2:4])):
                longer[part] = max(longer[part], a)
    for counts in (two, three):
        for x, a in counts.items():
            if a >= least and not (len(x) == 3 and 100 * longer[x] >= 50 * a):
                score, _, left, right = min((1000000 * a * a // (of(x[: k + 1]) * of((x[0], *x[k + 1 :]))), k, of(x[: k + 1]), of((x[0], *x[k + 1 :]))) for k in range(1, len(x) - 1))
                found[x[0]].append((-score, -a, " ".join(x[1:]).encode(), left, right))
    return {(lang, k + 1, p.decode(), -a, left, right, totals[lang], -s) for lang, rows in found.items() for k, (s, a, p, left, right) in enumerate(sorted(rows)[:best])}


def phrase_docs():
    rnd = random.Random(8)
    words = ["Aa", "b", "É", "dd", "e-e", "\x00", "g", "h", "ij", "k"] + [f"w{k}" for k in range(60)]
    docs = [("en", t) for t in EDGES] + [(None, "one two three. " * 12), ("und", "one two three " * 3), ("fr", "a\tb\x0bc\x0cd e " * 40)]
    for k in range(300):
        text = "".join(words[min(int(rnd.paretovariate(0.7)) - 1, 69)] + rnd.choice([" ", " ", " ", "  ", ", ", "\n", "! ", "\t"]) for _ in range(rnd.choice([5, 60])))
        docs.append((rnd.choice(["en", "en", "de", None]), text))
    return docs


@pytest.mark.parametrize(("bytes_of_range", "best"), [(32_000_000, 2000), (500, 7)])
def test_phrases(spark, monkeypatch, bytes_of_range, best):
    monkeypatch.setattr(collocations, "RANGE_BYTES", bytes_of_range)
    docs = phrase_docs()
    got = collocations.mine_phrases(frame(spark, [t for _, t in docs], [x for x, _ in docs]), best=best).collect()
    want = phrases_in(docs, best=best)
    assert len(got) == len(want) > 20
    assert {tuple(r) for r in got} == want


def test_phrases_of_nothing(spark):
    assert collocations.mine_phrases(frame(spark, ["a"]).limit(0)).count() == 0
    assert collocations.mine_phrases(frame(spark, [None, "", "a b a b"])).count() == 0


def test_pair_tiles():
    rnd = np.random.default_rng(1)
    first, second = (np.concatenate([rnd.integers(0, 40, 200_000), rnd.integers(0, 5000, 5_000)]) for _ in range(2))
    addresses, counts = collocations.count_addresses(first, second, 20)
    assert dict(zip(addresses.tolist(), counts.tolist(), strict=True)) == Counter((first << 20 | second).tolist())
    assert len(set(addresses.tolist())) == len(addresses)  # tiles don't overlap


def test_blocks_are_cut_within_texts_and_by_language(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 100)
    monkeypatch.setattr(collocations, "_AT_ONCE", 50)
    texts = ["a b. " * 200, "c d", "no end " * 100]
    batch = pa.RecordBatch.from_arrays([pa.array([3] * 3), pa.array(["x", "y", "y"]), pa.array(texts)], names=["part", "lang", "text"])
    blocks = list(collocations.cut_blocks(iter([batch])))
    assert len(blocks) > 5 and len({b["block"][0].as_py() for b in blocks}) == len(blocks)
    counts = Counter()
    for b in blocks:
        counts.update({(b["lang"][0].as_py(), w): n for w, n in zip(b["words"][0].as_py(), b["counts"][0].as_py(), strict=True)})
    assert counts == {("x", b"a"): 200, ("x", b"b"): 200, ("y", b"c"): 1, ("y", b"d"): 1, ("y", b"no"): 100, ("y", b"end"): 100}


def test_scores_beyond_64_bits(spark):
    a, left, right = 3 * 10**13 + 7, 5 * 10**13 + 1, 4 * 10**14 + 9
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1000000 * a * a // (left * right)


# exact duplicates


def equal_groups(texts):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


@pytest.mark.parametrize("fan", [1, 4])
def test_exact_duplicates(spark, fan):
    rnd = random.Random(4)
    texts = [*EDGES, " a", "a ", "  a\n", "\ta b\v", " a  b "] + [rnd.choice(["x", "y"]) + rnd.choice([" ", "\t\n", " "]) + rnd.choice("pqr") for _ in range(300)] + ["hot  copy"] * 200
    got = exact_dedup.mark_duplicates(frame(spark, texts), fan=fan).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == equal_groups(texts)
    assert len(got) == len(texts)


@pytest.mark.parametrize("runs", [1, 2, 11, 40])
def test_tree_merge_in_rounds(spark, runs):
    rows = [(i, i, (i * i % 97 - 48) << 57, bytes([i % 7])) for i in range(2000)]
    merged = exact_dedup.tree_merge(spark.createDataFrame(rows, "doc_id long, tag long, digest long, sha binary").repartition(runs), runs, 2).collect()
    want = defaultdict(list)
    for i, _, d, s in rows:
        want[d, s].append(i)
    assert {(r.digest, bytes(r.sha)): (r.doc_id, r.size) for r in merged} == {k: (min(v), len(v)) for k, v in want.items()}
    assert len(merged) == len(want)  # a digest of 64 bits that two texts share doesn't unite them


def test_merge_over_batches():
    names = ["owner", "doc_id", "tag", "digest", "sha", "size"]
    strict = pa.schema([(n, pa.binary() if n == "sha" else pa.int64()) for n in names[:-1]] + [pa.field("size", pa.int64(), nullable=False)])
    digests = [1, 1, 1, 1, 2, 2, 2, 3]
    columns = [[0] * 8, list(range(8)), list(range(8)), digests, [b"x"] * 3 + [b"y"] + [b"z"] * 4, [1] * 8]
    whole = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, strict, strict=True)], schema=strict)
    for n in (1, 2, 3, 8):
        merged = pa.Table.from_batches(list(exact_dedup.merge(whole.slice(k, n) for k in range(0, 8, n)))).to_pylist()
        assert [(r["digest"], r["sha"], r["doc_id"], r["size"]) for r in merged] == [(1, b"x", 0, 3), (1, b"y", 3, 1), (2, b"z", 4, 3), (3, b"z", 7, 1)]


def test_exact_duplicates_of_odd_rows(spark):
    assert exact_dedup.mark_duplicates(frame(spark, ["a"]).limit(0)).count() == 0
    df = frame(spark, ["a", "a", "a", "b", "b", None, "", "c"], ids=[None, 5, 5, None, None, 1, 0, 9])
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark_duplicates(df).collect()), key=repr)
    assert sorted(got, key=repr) == sorted([(None, 5, 3, False), (5, 5, 3, True), (5, 5, 3, False), (None, None, 2, True), (None, None, 2, False), (1, 0, 2, False), (0, 0, 2, True), (9, 9, 1, True)], key=repr)
    kept = exact_dedup.first_of_equal(df)
    assert kept.columns == df.columns and sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == [(0, ""), (5, "a"), (9, "c")]
    assert kept.count() == 4


def test_a_block_is_told_its_pairs_in_lists(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "_TOLD", 3)
    rows = sorted((address, block) for address in range(10) for block in (7, 9) if address < 8 or block == 7)
    sums = {a: sum(x == a for x, _ in rows) for a, _ in rows}
    columns = [[0] * len(rows), [a for a, _ in rows], [b for _, b in rows], ["x"] * len(rows), [5] * len(rows)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "address", "block", "lang", "n"])
    run = collocations.number_frequent(1, 10, ["address"], ["block", "lang"], collocations._packed)
    made = pa.Table.from_batches(list(run(iter([batch])))).to_pylist()
    keys = [r for r in made if r["block"] is None]
    assert {r["address"]: r["total"] for r in keys} == {a: 5 * n for a, n in sums.items() if n > 1}
    numbers = {r["address"]: r["number"] for r in keys}
    assert sorted(numbers.values()) == list(range(8))
    told = [r for r in made if r["block"] is not None]
    assert len(told) == 6 and max(len(r["addresses"]) for r in told) == 3
    assert sorted((r["block"], a, n) for r in told for a, n in zip(r["addresses"], r["numbers"], strict=True)) == sorted((b, a, numbers[a]) for a, b in rows if a in numbers)
