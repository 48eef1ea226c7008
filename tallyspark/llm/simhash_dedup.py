"""Near-duplicate groups by SimHash, with pivot distance tables.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Equal fingerprints are folded
first; what follows works on distinct ones:

1. A table holds each fingerprint's Hamming distances to reference fingerprints (pivots). By the triangle inequality two
   fingerprints within radius r differ by at most r in every coordinate. Distances can be taken block by block too: of
   four 16-bit blocks at least two are untouched if r is 2, and the coordinates of an untouched block are equal for every
   pivot. Distances to 16 independent pivots tell a block's bits apart, so a block's bits stand for its coordinates, and
   the pairs of blocks are the buckets in which pairs are sought: each link appears in one of the six at least. Whole
   coordinates can't take their place: one pivot's range of +-2 holds 34 % of random pairs, four hold 1.7 %, eight
   0.04 %, and k of them would have to be looked up in 2.3**k cells.
2. In a bucket of at most `crowd` fingerprints all pairs are compared: those with a coordinate difference over r are
   discarded, the survivors are verified bit by bit.
3. Members of larger buckets are not paired. Their pivots are all points at distance 0 or 1 from them; two fingerprints
   within 2 of each other share such a pivot, and two that share one are within 1 + 1 = 2 (the upper bound of the
   triangle inequality), so each is linked to one member of every pivot it shares. That is exact and linear.

Groups are the connected components of these links.

Edge cases: null, empty and blank texts have fingerprint zero and are linked like others; rows are judged one by one,
so a repeated row or doc_id is one more copy and a null doc_id never becomes a component's name unless all are null;
extra columns stay out of the result; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8
from .components import connected_components

SEED, RADIUS, BLOCK, CROWD = 42, 2, 16, 32
#: Reference fingerprints for whole-word coordinates: bits of the golden ratio's multiples, as good as random.
PIVOTS = tuple((k * 0x9E3779B97F4A7C15) % 2**64 for k in range(1, 17))
#: Shingles whose bits are counted at once: 2 MB of bits.
STEP = 32_768


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def fingerprint_of(text: bytes, shingle: int) -> int:
    """The unsigned fingerprint of lower-cased UTF-8 bytes."""
    words = text.lower().split()
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(parts), STEP):
        hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in parts[k : k + STEP]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0])


def fingerprint(shingle: int):
    """text -> signed 64-bit fingerprint."""

    @F.arrow_udf(T.LongType())
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([signed(fingerprint_of(x, shingle)) for x in utf8(texts)], pa.int64())

    return apply


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _coordinates(x: Column) -> Column:
    return F.array(*[_distance(x, F.lit(signed(p))).cast("tinyint") for p in PIVOTS])


def link_fingerprints(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): links between the values of distinct.fp whose components are those of all pairs within RADIUS."""
    blocks = [F.shiftrightunsigned("fp", BLOCK * k).bitwiseAND(F.lit(2**BLOCK - 1)) for k in range(64 // BLOCK)]
    keys = F.array(*[F.struct(F.lit(n).alias("n"), (F.shiftleft(blocks[i], BLOCK) + blocks[j]).alias("k")) for n, (i, j) in enumerate(combinations(range(len(blocks)), len(blocks) - RADIUS))])
    placed = distinct.select("fp", F.explode(keys).alias("at")).select("fp", "at.*")
    sizes = placed.groupBy("n", "k").agg(F.count("*").alias("size")).filter("size > 1")
    shared = placed.join(sizes, ["n", "k"])
    few = shared.filter(F.col("size") <= crowd)
    # a bucket of `crowd` rows at most, gathered once, and its pairs
    gathered = few.groupBy("n", "k").agg(F.array_sort(F.collect_list("fp")).alias("all"))
    tabled = gathered.select(F.transform("all", lambda x: F.struct(x.alias("fp"), _coordinates(x).alias("d"))).alias("all"))
    pairs = tabled.select(F.explode("all").alias("x"), "all").select("x", F.explode(F.filter("all", lambda y: y["fp"] > F.col("x.fp"))).alias("y"))
    near = pairs.filter(F.array_max(F.zip_with("x.d", "y.d", lambda a, b: F.abs(a.cast("int") - b.cast("int")))) <= RADIUS)
    verified = near.filter(_distance(F.col("x.fp"), F.col("y.fp")) <= RADIUS).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    # larger buckets: pivots at distance 0 or 1
    many = shared.filter(F.col("size") > crowd).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << k)) for k in range(64)])
    around = many.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("pivot"))
    hubs = around.groupBy("pivot").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    crowded = around.join(hubs, "pivot").filter("fp != hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    return verified.union(crowded).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, text_col: str = "text", id_col: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs."""
    marked = docs.select(F.col(id_col).alias("doc_id"), fingerprint(shingle)(F.col(text_col)).alias("fp"))
    return group_fingerprints(marked, crowd)


def group_fingerprints(marked: DataFrame, crowd: int = CROWD) -> DataFrame:
    """near_duplicates() for rows that have their fingerprint already, as fp."""
    from .common import cut_lineage

    marked = cut_lineage(marked)  # 16 bytes a row; the hashing isn't repeated
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = connected_components(link_fingerprints(distinct, crowd), "a", "b")
    members = distinct.join(linked, distinct.fp == linked.vertex, "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    names = members.groupBy("root").agg(F.min("first").alias("component_id"))
    named = members.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
