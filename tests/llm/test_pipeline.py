import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import decontamination, near_copies, quality_rules, simhash_dedup

SMALL = "/root/testdata/sf0.001"


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def groups(rows):
    """Document to the least document of its group, by all pairs: fingerprints within the radius or similar shingles."""
    sets = [near_copies.shingles_of((t or "").encode(), 5) for _, t in rows]
    prints = [simhash_dedup.fingerprint_of((t or "").encode(), 5) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and ((prints[i] ^ prints[j]).bit_count() <= simhash_dedup.RADIUS or near_copies.similarity(sets[i], sets[j]) >= 0.8):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for (doc, _), r in zip(rows, root, strict=True):
        least[r] = min(doc, least.get(r, doc))
    return {doc: least[r] for (doc, _), r in zip(rows, root, strict=True)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    verdict = {r.doc_id: r.kept for r in quality_rules.score_quality(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in verdict.items() if v)
    cut = stages["line_dedup"](spark, kept, SMALL)
    assert cut.columns == docs.columns and cut.count() == kept.count()
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)
    near = stages["simhash_near_dedup"](spark, cut, SMALL)
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    assert sorted(r.doc_id for r in near.collect()) == sorted({k for k in groups(rows).values()})
    left = {r.doc_id for r in near.collect()}
    clean = stages["decontamination"](spark, near, SMALL)
    leaks = {r.doc_id for r in decontamination.find_leaks(near, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == left - leaks
    packed = stages["packing"](spark, clean, SMALL)
    assert {r.doc_id for r in packed.collect()} == left - leaks


def test_near_duplicates_keep_one_row(spark):
    copy, other = "a b c d e f", "q r s t u v w"
    rows = [(1, copy, "en", "s", 1), (1, copy, "en", "s", 1), (2, copy, "en", "s", 1), (None, copy, "en", "s", 1), (None, other, "en", "s", 1), (None, other, "en", "s", 1)]
    rows += [(5, copy, "en", "s", 1), (5, "another text of five", "en", "s", 1), (6, None, "en", "s", 0), (7, " ", "en", "s", 0)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCS), SMALL).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[0], rows[4], rows[7], rows[8]], key=repr)


def test_stages_on_edge_cases(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "long words of a text " * 20_000, "en", "s", 420_000), (2, "long words of a text " * 20_000, "en", "s", 420_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("row", "key", "lines", "doc", "kept", "n_dropped", "root")})
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SMALL)
            assert name == "packing" or out.columns == docs.columns
            assert (out.count() > 0) == (df is docs and name != "quality_rules")
    assert corpus_pipeline.lines(spark, docs, SMALL).count() == 5
    assert corpus_pipeline.near_duplicates(spark, docs, SMALL).count() == 2


def test_near_duplicates_of_similarity(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    texts = []
    for n in (40, 80, 200, 400) * 5:
        base = [word() for _ in range(n)]
        for edits in (0, 1, n // 60, n // 45, n // 40):
            copy = list(base)
            for k in rnd.sample(range(n), edits):
                copy[k] = word()
            texts.append(" ".join(copy))
    chain = [word() for _ in range(130)]
    texts += [" ".join(chain[k : k + 100]) for k in (0, 10, 20, 30)]  # similar to the next alone
    sets = [near_copies.shingles_of(t.encode(), 5) for t in texts]
    prints = [simhash_dedup.fingerprint_of(t.encode(), 5) for t in texts]
    assert [near_copies.marks_of(t.encode(), 5)[0] for t in texts] == prints
    root, beyond = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            near = (prints[i] ^ prints[j]).bit_count() <= simhash_dedup.RADIUS
            similar = near_copies.similarity(sets[i], sets[j]) >= 0.8
            beyond += similar and not near
            if near or similar:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert beyond > 50
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == dict(enumerate(root)) == groups(list(enumerate(texts)))
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()) == sorted(set(root))
    assert near_copies.near_copies(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("crowd", "often", "sent"), [(0, 16, 500_000), (32, 3, 500_000), (32, 0, 500_000), (0, 16, 40), (32, 3, 0)])
def test_near_copies_of_a_large_group(spark, monkeypatch, crowd, often, sent):
    monkeypatch.setattr(near_copies, "OFTEN", often)
    monkeypatch.setattr(near_copies, "BROADCAST_ELEMENTS", sent)
    rnd = random.Random(40)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base, texts = [word() for _ in range(120)], []
    kinds = [(rnd.randrange(120), word()) for _ in range(6)]  # edits that several copies share
    for k in range(140):
        copy = list(base)
        for at in rnd.sample(range(120), k % 7):
            copy[at] = word()
        for at, new in rnd.sample(kinds, rnd.choice([0, 0, 1, 3, 4])):
            copy[at] = new
        texts.append(" ".join(copy))
    texts += [" ".join(base[:60] + [word() for _ in range(60)]) for _ in range(20)]  # half in common
    rows = list(enumerate(texts))
    want = groups(rows)
    assert 5 < len(set(want.values())) < 120
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], DOCS)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs, crowd=crowd).collect()} == want


def test_texts_of_many_large_buckets_are_expanded_once(spark, monkeypatch):
    rnd = random.Random(41)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passages = [[word() for _ in range(60)] for _ in range(6)]
    texts = []
    for k in range(120):  # texts that share passages and differ, and copies of some with an edit or more
        base = sum(rnd.sample(passages, 3), []) + [word() for _ in range(rnd.randrange(20, 90))]
        for edits in (0, 2, 5)[: 1 + 2 * (k % 10 == 0)]:
            copy = list(base)
            for at in rnd.sample(range(len(base)), edits):
                copy[at] = word()
            texts.append(" ".join(copy))
    rows, expanded, hubs = list(enumerate(texts)), [], []
    stored, crowded = near_copies.stored, near_copies._crowded

    def counted(df):
        lists = [F.size(c) for c, t in df.dtypes if t == "array<bigint>" and c not in ("buckets", "hubs")]
        table = stored(df)
        expanded.extend(table.agg(F.sum(x)).first()[0] or 0 for x in lists)
        return table

    def watched(at, *rest):
        hubs.append(at.select("hub", "key").distinct().count())
        with monkeypatch.context() as m:
            m.setattr(near_copies, "stored", counted)
            return crowded(at, *rest)

    monkeypatch.setattr(near_copies, "_crowded", watched)
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], DOCS)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, crowd=8).collect()}
    assert got == groups(rows)
    sizes = [len(near_copies.shingles_of(t.encode(), 5)) for t in texts]
    assert hubs[0] > len(texts)  # texts have more than one hub
    assert 0 < max(expanded) <= sum(n // 5 + 1 for n in sizes)


def test_rows_whose_nulls_differ_are_different_rows(spark):
    text = "alpha beta gamma delta epsilon zeta"
    rows = [(None, text, None), (None, None, text), (3, None, None), (None, "x", None), (None, None, "x"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = near_copies.first_of_each(docs).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(None, text, None), (3, None, None), (None, "x", None)], key=repr)
    docs = spark.createDataFrame([(None, text, None), (None, None, text)], "doc_id long, text string, source string")
    assert near_copies.first_of_each(docs).count() == 2


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
