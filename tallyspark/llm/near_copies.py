"""Groups of near copies: shingle similarity of `SIMILAR` or more, besides equal or nearly equal fingerprints.

Texts of similarity 0.8 differ in 4 to 14 of 64 fingerprint bits, a radius at which neither bit blocks nor pivot
distances select anything, so candidates come from MinHash: `BANDS` buckets a text, each of `ROWS` least hashes. Two
texts of similarity s share a bucket with probability 1 - (1 - s**ROWS)**BANDS; at 0.8 one pair in 10^7 is missed.
Candidates whose sizes or sketches (a byte of each least hash) can't belong to similar texts are passed over, the others
verified by the exact similarity of their shingle sets, shared over all.

Links of fingerprints come first. Then each text is held against one of each of its buckets, in buckets of more than
`CROWD` the one that stands in the most others' (the hub). What pairs are left, of texts in different groups yet, is
found without listing a bucket's pairs:

- A bucket of at most `CROWD` texts gives each of them fewer pairs than that; only those of like size are made.
- Texts of larger ones are expanded once each, not once a bucket, into the first of their shingles in an order that is
  one for all texts. Similar texts of sizes m <= n have at least s / (1 + s) * (m + n) shingles in common, so of the
  shorter one's first m / 9 + 1 and the longer one's first n / 5 + 1 one is the same (s = 0.8), and both places leave room
  for the rest. That is exact in any order, and whatever bucket two texts share. In the one taken, shingles that more of
  the large buckets' hubs have come later: passages that many texts share are in most of their hubs. So the rows are at
  most a third of the shingles and two a text.

Pairs within a group can't change it, so large groups of copies aren't paired and nothing is lost.

Edge cases: null and blank texts have no shingle and are linked by their fingerprint, zero; texts under `shingle` words
are one shingle; equal texts are one; rows are judged one by one, so two texts with one doc_id are two documents, and so are two
rows that differ only in which column is null; null
ids are kept and name a group only if all its ids are null; extra columns pass through first_of_each(); an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import digest, discard, row_digest, stored, utf8
from .components import connected_components
from .simhash_dedup import SEED, STEP, link_fingerprints, signed

SIMILAR, ROWS, BANDS = 0.8, 4, 32
#: Equal bytes of two sketches that similar texts have but for one pair in 10^6.
LEAST_EQUAL = 77
#: The most texts of a bucket whose pairs are made.
CROWD = 32
#: Levels of how many hubs have an element, by powers of two; from the last on they aren't told apart.
OFTEN = 16
#: The most texts, a digest each, whose keys are sent to all tasks.
BROADCAST_TEXTS = 1_000_000
#: The most elements of hubs, two numbers each, that are sent to all tasks; in the order the others are as those of no hub.
BROADCAST_ELEMENTS = 500_000

_ODD = np.random.default_rng(11).integers(0, 2**63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = np.random.default_rng(12).integers(0, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles_of(text: bytes, shingle: int) -> set[bytes]:
    words = text.lower().split()
    return set(map(b" ".join, zip(*(words[k:] for k in range(min(shingle, len(words)))), strict=False))) if words else set()


def similarity(a: set[bytes], b: set[bytes]) -> float:
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared) if shared else 0.0


def marks_of(text: bytes, shingle: int) -> tuple[int, int, bytes, list[int]]:
    """(fingerprint, different shingles, sketch, buckets) of a text."""
    words = text.lower().split()
    if not words:
        return 0, 0, b"", []
    parts = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in parts], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), STEP):
        ones += np.unpackbits(hashes[k : k + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    once = np.unique(hashes)
    least = np.array([(once * m).min() for m in _ODD])
    mixed = (least ^ (least >> np.uint64(29))).reshape(BANDS, ROWS) * _BAND
    buckets = np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(31)), axis=1) * _BAND[:, 0]
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0]), len(once), ((least * _ODD) >> np.uint64(56)).astype(np.uint8).tobytes(), buckets.view(np.int64).tolist()


MARKS = "doc_id long, row binary, hash binary, fp long, n long, sketch binary, buckets array<long>"


def _marker(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [marks_of(x, shingle) for x in utf8(batch.column(3))]
            columns = [pa.array([signed(x[0]) for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.binary()), pa.array([x[3] for x in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *columns], names=["doc_id", "row", "hash", "fp", "n", "sketch", "buckets"])

    return run


def equal_bytes():
    """(sketch, sketch) -> how many bytes are equal."""

    @F.arrow_udf(T.IntegerType())
    def apply(a: pa.Array, b: pa.Array) -> pa.Array:
        rows = lambda x: np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, ROWS * BANDS)
        return pa.array((rows(a) == rows(b)).sum(axis=1), pa.int32())

    return apply


def exact_similarity(shingle: int):
    """(text, text) -> similarity of their shingle sets."""

    @F.arrow_udf(T.DoubleType())
    def apply(a: pa.Array, b: pa.Array) -> pa.Array:
        found, last, mine = [], None, set()
        for x, y in zip(utf8(a), utf8(b), strict=True):
            if x != last:
                last, mine = x, shingles_of(x, shingle)
            found.append(similarity(mine, shingles_of(y, shingle)))
        return pa.array(found, pa.float64())

    return apply


def shingle_hashes(shingle: int):
    """text -> its different shingles as hashes."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([[signed(xxhash.xxh64_intdigest(s, SEED)) for s in shingles_of(x, shingle)] for x in utf8(texts)], pa.list_(pa.int64()))

    return apply


def first_elements(shingle: int, listed: np.ndarray, levels: np.ndarray):
    """text -> its first elements, as hashes by level and hash: one of them at least is in each similar text that is no
    longer. listed: elements in order, whose levels are given; the others' is 0."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def apply(texts: pa.Array) -> pa.Array:
        found = []
        for x in utf8(texts):
            own = np.unique(np.array([signed(xxhash.xxh64_intdigest(s, SEED)) for s in shingles_of(x, shingle)], np.int64))
            at = np.minimum(np.searchsorted(listed, own), max(len(listed) - 1, 0))
            level = np.where(listed[at] == own, levels[at], 0) if len(listed) else np.zeros(len(own), np.int64)
            found.append(own[np.lexsort((own, level))][: len(own) - math.ceil(SIMILAR * len(own) - 1e-9) + 1])
        return pa.array(found, pa.list_(pa.int64()))

    return apply


def _texts_of(keys: DataFrame, once: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text) of some texts, each once."""
    wanted = stored(keys.distinct().join(once.select("key", "hash"), "key"))
    if wanted.count() <= BROADCAST_TEXTS:  # else the documents are shuffled to them
        wanted = F.broadcast(wanted)
    return texts.join(wanted, "hash").groupBy("key").agg(F.first("text").alias("text"))


def _crowded(at: DataFrame, once: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(a, b): pairs that can be similar, of different groups, from members (hub, key, n, root) of large buckets."""
    share = SIMILAR / (1 + SIMILAR)
    members = stored(at.select("key", "n", "root").distinct())
    held = stored(_texts_of(members.select("key"), once, texts))
    hubs = held.join(at.select(F.col("hub").alias("key")).distinct(), "key")
    counts = hubs.select(F.explode(shingle_hashes(shingle)(F.col("text"))).alias("e")).groupBy("e").agg(F.count("*").alias("df"))
    level = F.least(F.lit(OFTEN), F.length(F.bin("df"))).cast("long")
    listed = counts.orderBy(F.desc("df"), "e").limit(BROADCAST_ELEMENTS).select("e", level.alias("level")).toArrow().sort_by("e")
    first = first_elements(shingle, *(listed.column(c).to_numpy() for c in ("e", "level")))
    index = stored(held.select("key", first(F.col("text")).alias("first")).join(members, "key"))
    # of the shorter text fewer come first, since both sizes bound what they have in common
    fewer = F.slice("first", F.lit(1), (F.col("n") - F.ceil(2 * share * F.col("n") - 1e-9) + 1).cast("int"))
    x, y = (index.select(F.posexplode(part).alias(f"at_{c}", "e"), *[F.col(k).alias(f"{k}_{c}") for k in ("key", "n", "root")]) for part, c in ((fewer, "a"), (F.col("first"), "b")))
    common = F.ceil(share * (F.col("n_a") + F.col("n_b")) - 1e-9)
    sized = (F.struct("n_a", "key_a") < F.struct("n_b", "key_b")) & (F.col("n_a") >= SIMILAR * F.col("n_b"))
    room = (F.col("at_a") <= F.col("n_a") - common) & (F.col("at_b") <= F.col("n_b") - common)
    ends = F.when(F.col("root_a") < F.col("root_b"), F.struct(F.col("key_a").alias("a"), F.col("key_b").alias("b"))).otherwise(F.struct(F.col("key_b").alias("a"), F.col("key_a").alias("b")))
    pairs = stored(x.join(y, "e").filter(sized & room & (F.col("root_a") != F.col("root_b"))).select(ends.alias("x")).select("x.a", "x.b").distinct())
    discard(members, held, index)
    return pairs


def _verified(pairs: DataFrame, once: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(a, b): fingerprints of the pairs (a, b) of keys that are similar."""
    end = lambda c: once.select(F.col("key").alias(c), F.col("fp").alias(f"fp_{c}"), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    sized = pairs.join(end("a"), "a").join(end("b"), "b").filter(F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b"))
    likely = stored(sized.filter(equal_bytes()(F.col("sketch_a"), F.col("sketch_b")) >= LEAST_EQUAL).select("a", "b", "fp_a", "fp_b"))
    held = stored(_texts_of(likely.select(F.col("a").alias("key")).union(likely.select(F.col("b").alias("key"))), once, texts))
    both = likely.join(held.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(held.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    similar = stored(both.filter(exact_similarity(shingle)(F.col("text_a"), F.col("text_b")) >= SIMILAR).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))
    discard(likely, held)
    return similar


def _united(rooted: DataFrame, links: DataFrame) -> DataFrame:
    """rooted (fp, first, root) after links (a, b) of fingerprints: roots that they connect become one."""
    if links.isEmpty():
        return rooted
    root = lambda c: rooted.select(F.col("fp").alias(c), F.col("root").alias(f"root_{c}"))
    edges = links.join(root("a"), "a").join(root("b"), "b").filter("root_a != root_b").select("root_a", "root_b")
    united = connected_components(edges, "root_a", "root_b").select(F.col("vertex").alias("root"), "component")
    after = stored(rooted.join(united, "root", "left").select("fp", "first", F.coalesce("component", "root").alias("root")))
    discard(rooted, links)
    return after


def near_copies(docs: DataFrame, shingle: int = 5, text_col: str = "text", id_col: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """(doc_id, row, component_id, root) for each row of docs: row stands for all its columns, root names its group,
    component_id is the group's least doc_id."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_digest(docs).alias("row"), digest(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))
    marked = stored(texts.mapInArrow(_marker(shingle), MARKS))
    rows, texts = marked.select("doc_id", "row", "fp"), texts.select("hash", "text")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    # different texts, by a number each
    once = stored(marked.filter("n > 0").dropDuplicates(["hash"]).select(F.monotonically_increasing_id().alias("key"), "hash", "fp", "n", "sketch", F.array_distinct("buckets").alias("buckets")))
    placed = once.select("key", "fp", "n", F.explode("buckets").alias("bucket"))
    # texts of one bucket; those of one fingerprint are linked already
    stats = stored(placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("key").alias("least"), F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high").select("bucket", "size", "least"))
    together = stored(placed.join(stats, "bucket"))
    large = together.filter(F.col("size") > crowd)
    fame = large.groupBy("key").agg(F.sum("size").alias("fame"))
    hubs = stored(large.join(fame, "key").groupBy("bucket").agg(F.max_by("key", F.struct("fame", "key")).alias("hub")))

    rooted = _united(stored(prints.withColumn("root", F.col("fp"))), stored(link_fingerprints(prints)))
    torn = lambda at: at.join(stored(at.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("bucket")), "bucket")
    at = stored(torn(together.join(rooted.select("fp", "root"), "fp").select("bucket", "key", "least", "root")))
    named = at.join(hubs, "bucket", "left").withColumn("head", F.coalesce("hub", "least"))
    heads = named.filter("key = head").select("bucket", "head", F.col("root").alias("head_root"))
    stars = at.join(heads, "bucket").filter("root != head_root").select(F.least("head", "key").alias("a"), F.greatest("head", "key").alias("b")).distinct()
    rooted = _united(rooted, _verified(stars, once, texts, shingle))
    discard(at)
    at = torn(together.join(rooted.select("fp", "root"), "fp").select("bucket", "key", "size", "n", "root"))
    # similar texts are of one size level or of neighbouring ones
    level = F.floor(F.log(F.col("n").cast("double")) / -math.log(SIMILAR))
    at = stored(at.withColumn("level", level))
    x, y = (at.filter(F.col("size") <= crowd).select("bucket", F.col("key").alias(c), F.col("root").alias(f"root_{c}"), F.col("n").alias(f"n_{c}"), "level") for c in "ab")
    y = y.withColumn("level", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)))
    sized = F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b")
    rest = x.join(y, ["bucket", "level"]).filter((F.col("root_a") < F.col("root_b")) & sized).select("a", "b")
    crowds = at.filter(F.col("size") > crowd)
    if not crowds.isEmpty():
        rest = rest.union(_crowded(crowds.join(hubs, "bucket"), once, texts, shingle))
    rooted = _united(rooted, _verified(rest.distinct(), once, texts, shingle))
    discard(at)
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = stored(rows.join(rooted.join(names, "root").select("fp", "component_id", "root"), "fp").select("doc_id", "row", "component_id", "root"))
    discard(marked, prints, once, stats, together, hubs, rooted)
    return found


def first_of_each(docs: DataFrame, shingle: int = 5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each group of near copies: of the least doc_id, and of its rows the one with the least digest."""
    groups = near_copies(docs, shingle, text_col, id_col)
    chosen = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("one")).select(F.col("one.row").alias("row"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_digest(docs).alias("row"))
    # rows that are equal in all columns meet by the digest that the join has dealt them by
    kept = whole.join(stored(chosen), "row", "left_semi").dropDuplicates(["row"])
    return kept.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
