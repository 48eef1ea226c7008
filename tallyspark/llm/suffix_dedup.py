"""Exact substring removal: bucket-pointer refinement over suffixes.

Every suffix has a bucket, first that of its 8-byte prefix. A bucket is refined by the bucket identifiers of later
offsets: the identifier for 16 bytes comes from those for 8 bytes at p and p + 8, that for 32 from those for 16, and so
on to 64, 128 and 200, each level from the refined identifiers of the level before. An identifier is a 64-bit mix of
what it stands for, so all documents share it without a sort of all suffixes, and buckets of one are dropped early:

1. Only anchors are shuffled at first, the suffixes whose 32-byte bucket is the least of some 200-byte string around
   them: any two equal strings have the same anchor at the same place. A bucket with one anchor holds no repeat.
2. An anchor's context is all that the 200-byte strings around it can touch. Anchors with equal contexts have all of it
   repeated; nothing of it needs to be looked at string by string.
3. Where a bucket holds different contexts, one of each is fetched, and the bucket is refined to the 200-byte buckets
   that have this anchor: a bucket of at most `CROWD` contexts within a task, a larger one by counting all its 200-byte
   strings across the cluster.

Identifiers are thus hashes, not the ranks that a sort at every level would give them: ranks of all suffixes would be
shuffled anew for each level, a hundred times the input. Where a bucket is settled its strings are sorted by identifier.

Keys are pairs of mixes, 128 bits together. Only counts and minima of a bucket are taken, pre-aggregated before the
shuffle; members are marked by joins that Spark splits where a bucket is large. Texts are shuffled compressed.

Edge cases: a null text is empty; a text under `span` bytes has nothing removed; a repeated row, also of the same
doc_id, is an occurrence elsewhere, so all of it goes if it has `span` bytes; null ids are kept; extra columns stay
out; an empty table gives an empty result. Texts have under 2**31 bytes, as a Spark string has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, slices, stored

SPAN, GRAM = 200, 32
#: Starts of GRAM-byte strings in a string of SPAN bytes.
WIDTH = SPAN - GRAM + 1
#: Bytes whose buckets are worked out at once; a longer text is worked out alone.
AT_ONCE = 1 << 18
#: The most contexts of a bucket that one task compares.
CROWD = 20_000
#: An address is a text's CRC-32 and a byte offset.
OFFSET_BITS = 31

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bucket of strings that begin with bucket a and continue with bucket b."""
    h = (b ^ (b >> np.uint64(29))) * _B
    h ^= a
    h ^= h >> np.uint64(32)
    h *= _A
    h += a * _C
    h ^= h >> np.uint64(29)
    h *= _C
    h ^= h >> np.uint64(32)
    return h


def refine(ids: np.ndarray, offset: int) -> np.ndarray:
    return mix(ids[:-offset], ids[offset:]) if len(ids) > offset else ids[:0]


def buckets(data: np.ndarray) -> dict[int, np.ndarray]:
    """Identifiers by length, for each start in data (uint8)."""
    if len(data) < SPAN:
        return {n: np.zeros(0, np.uint64) for n in (GRAM, 128, SPAN)}
    ids = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    by16 = refine(ids, 8)
    by32 = refine(by16, 16)
    by128 = refine(refine(by32, 32), 64)
    return {GRAM: by32, 128: by128, SPAN: refine(by128, SPAN - 128)}


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of x[p : p + width], for each p where that fits."""
    n, done = len(x) - width + 1, 1
    while 2 * done <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[:n], x[width - done : width - done + n])


def anchors_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(least, anchors): the least GRAM-byte bucket of each 200-byte string (0 where it crosses texts), and the starts
    of GRAM-byte strings that are the least of one."""
    n = len(data) - SPAN + 1
    least = _sliding(ids[GRAM], WIDTH, np.minimum)[:n].copy()
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    least[np.arange(n) + SPAN > ends[owner[:n]]] = 0
    around = np.zeros(len(ids[GRAM]) + WIDTH - 1, np.uint64)
    around[WIDTH - 1 : WIDTH - 1 + n] = least
    top = _sliding(around, WIDTH, np.maximum)
    return least, np.nonzero((top == ids[GRAM]) & (top != 0))[0]


def contexts(anchors: np.ndarray, first: np.ndarray, last: np.ndarray, ids: dict[int, np.ndarray]) -> np.ndarray:
    """Buckets of all that strings around each anchor can touch, within its text [first, last)."""
    left, right = np.maximum(first, anchors - (WIDTH - 1)), np.minimum(last, anchors + SPAN)
    long = ids[128]
    shape = ((anchors - left) << 10 | (right - anchors)).astype(np.uint64)
    return mix(mix(mix(long[left], long[(left + right - 128) // 2]), long[right - 128]), shape)


def _groups(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch.column(text)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(lengths, AT_ONCE):
        yield a, b, [x or b"" for x in texts[a:b].cast(pa.binary()).to_pylist()]


def _laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) for x in texts])
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64)


ANCHOR = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", "context", "k", "at")] + [T.StructField("run", T.IntegerType())])


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (k, crc, text): the anchors; a run of neighbours with one context is one row."""
    for batch in batches:
        for a, b, texts in _groups(batch, 2):
            keep = [i for i, x in enumerate(texts) if len(x) >= SPAN]
            if not keep:
                continue
            data, starts, ends = _laid([texts[i] for i in keep])
            k = np.array(batch.column(0)[a:b].to_pylist(), np.int64)[keep]
            crc = np.array(batch.column(1)[a:b].to_pylist(), np.int64)[keep]
            ids = buckets(data)
            _, found = anchors_of(data, starts, ends, ids)
            owner = np.searchsorted(ends, found, side="right")
            gram, context = ids[GRAM][found], contexts(found, starts[owner], ends[owner], ids)
            new = np.ones(len(found), bool)
            new[1:] = (np.diff(found) != 1) | (context[1:] != context[:-1]) | (np.diff(owner) != 0)
            head = np.nonzero(new)[0]
            run = np.diff(np.append(head, len(found)))
            own = owner[head]
            at = crc[own] << OFFSET_BITS | (found[head] - starts[own])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram[head].view(np.int64), context[head].view(np.int64), k[own], at, run.astype(np.int32))], names=ANCHOR.names)


CONTEXT = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", "k", "at", "n", "size")] + [T.StructField("left", T.IntegerType()), T.StructField("bytes", T.BinaryType())])


def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (k, crc, packed text, list of (p, gram, n, size)): the contexts at those places."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows: list[tuple] = []
        for k, crc, packed, wanted in zip(*(batch.column(i) for i in range(4)), strict=True):
            text = unpack.decompress(packed.as_py(), max_output_size=1 << OFFSET_BITS)
            k, crc = k.as_py(), crc.as_py() << OFFSET_BITS
            for p, gram, n, size in zip(*(x.to_pylist() for x in wanted.values.flatten()), strict=True):
                first = max(0, p - (WIDTH - 1))
                rows.append((gram, k, crc | p, n, size, p - first, text[first : p + SPAN]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.int32(), pa.binary()], strict=True)], names=CONTEXT.names)


def _strings(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, p, bucket) of the 200-byte strings of contexts in which the context's anchor is the first that is least."""
    data, starts, ends = _laid([x[-1] for x in rows])
    ids = buckets(data)
    least, _ = anchors_of(data, starts, ends, ids)
    owner, anchor = np.repeat(np.arange(len(rows)), ends - starts), starts + np.array([x[5] for x in rows])
    mine = ids[GRAM][anchor]
    same = np.nonzero(ids[GRAM] == mine[owner[: len(ids[GRAM])]])[0]
    same = same[same < anchor[owner[same]]]
    earlier = np.full(len(rows), -1)  # where the anchor's bucket stands last before it
    np.maximum.at(earlier, owner[same], same)
    owner = owner[: len(least)]
    p = np.nonzero((least == mine[owner]) & (least != 0) & (np.arange(len(least)) > earlier[owner]))[0]
    return owner[p], p - starts[owner[p]], ids[SPAN][p]


def _runs(owner: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of neighbours of one owner."""
    if not len(p):
        return p, p
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p) != 1) | (np.diff(owner) != 0)
    head = np.nonzero(new)[0]
    return head, np.append(head[1:], len(p)) - 1


SPANS = "k long, at long, length int"


def _covered(rows: list[tuple], owner: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    head, tail = _runs(owner, p)
    at = np.array([x[2] - x[5] for x in rows], np.int64)
    k = np.array([x[1] for x in rows], np.int64)
    return pa.RecordBatch.from_arrays([pa.array(k[owner[head]]), pa.array(at[owner[head]] + p[head]), pa.array((p[tail] - p[head] + SPAN).astype(np.int32))], names=["k", "at", "length"])


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From contexts sorted by bucket: what 200-byte strings repeat of contexts that occur once."""

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        parts = []
        for a, b in slices(np.array([len(x[-1]) for x in rows]), AT_ONCE):  # of a large bucket only its strings' keys are held together
            owner, p, bucket = _strings(rows[a:b])
            parts.append((owner + a, p, mix(np.array([x[0] for x in rows[a:b]], np.int64).view(np.uint64)[owner], bucket)))
        owner, p, key = (np.concatenate(x) for x in zip(*parts, strict=True))
        n = np.minimum(np.array([x[3] for x in rows]), 2)
        _, place = np.unique(key, return_inverse=True)
        again = (np.bincount(place, n[owner]) > 1)[place] & (n[owner] == 1)
        return _covered(rows, owner[again], p[again])

    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(len(CONTEXT))), strict=True):
            if held > AT_ONCE and rows[-1][0] != row[0]:
                yield compare(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[-1])
    if rows:
        yield compare(rows)


STRING = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", "whole", "n", "k", "at")])


def list_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From contexts: their 200-byte buckets, one by one."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            rows = list(zip(*(batch.column(i)[at : at + 512].to_pylist() for i in range(len(CONTEXT))), strict=True))
            owner, p, bucket = _strings(rows)
            gram, k, place, n = (np.array([f(x) for x in rows], np.int64)[owner] for f in (lambda x: x[0], lambda x: x[1], lambda x: x[2] - x[5], lambda x: min(x[3], 2)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, bucket.view(np.int64), n, k, place + p)], names=STRING.names)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, packed text, starts, ends): what is left of each text."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, packed, starts, ends in zip(*(batch.column(i) for i in range(4)), strict=True):
            text = unpack.decompress(packed.as_py(), max_output_size=1 << OFFSET_BITS) if packed.is_valid and len(packed.as_py()) else b""
            n, spans, kept = 0, 0, text
            if starts.is_valid:
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, starts.values.to_numpy(), 1)
                np.add.at(change, np.minimum(ends.values.to_numpy(), len(text)), -1)
                gone = np.cumsum(change[:-1]) > 0
                n = int(gone.sum())
                spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((doc.as_py(), len(text), n, spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.string(), pa.binary()), strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]) if rows else batch.slice(0, 0)


@F.arrow_udf(T.BinaryType())
def _packed(texts: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=3)
    return pa.array([pack.compress(x or b"") for x in texts.cast(pa.binary()).to_pylist()], pa.binary())


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(k, crc, starts, ends) of the texts of keyed (k, crc, text) that hold repeated strings."""
    anchors = keyed.select("k", "crc", "text").mapInArrow(find_anchors, ANCHOR)
    # small sides are stored before they are joined: Spark splits a bucket with many rows only where a shuffle feeds each side
    shared = stored(anchors.groupBy("gram").agg(F.sum("run").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")).filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed")))
    hits = stored(anchors.join(shared, "gram"))
    # where contexts differ: how often each occurs, and one of its places
    classes = stored(hits.filter("mixed").groupBy("gram", "context").agg(F.sum("run").alias("n"), F.min(F.struct("k", "at")).alias("one")))
    whole = hits.filter("not mixed").select("k", "at", "run").union(hits.filter("mixed").join(classes.filter("n > 1"), ["gram", "context"]).select("k", "at", "run"))
    crc, offset = F.shiftright("at", OFFSET_BITS), F.col("at").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1))
    sizes = stored(classes.groupBy("gram").agg(F.count("*").alias("size")))
    wanted = classes.join(sizes, "gram").select("gram", "one.*", "n", "size").groupBy("k", crc.alias("crc")).agg(F.collect_list(F.struct(offset.alias("p"), "gram", "n", "size")).alias("wanted"))
    texts = keyed.filter(F.octet_length("text") >= SPAN).select("k", "crc", _packed("text").alias("packed")).groupBy("k", "crc").agg(F.first("packed").alias("packed"))
    found = stored(texts.join(wanted, ["k", "crc"]).select("k", "crc", "packed", "wanted").mapInArrow(cut_contexts, CONTEXT))
    few, many = found.filter(F.col("size") <= CROWD), found.filter(F.col("size") > CROWD)
    settled = few.repartition("gram").sortWithinPartitions("gram").mapInArrow(settle, SPANS)
    strings = many.mapInArrow(list_strings, STRING)
    again = stored(strings.groupBy("gram", "whole").agg(F.sum("n").alias("total")).filter("total > 1").select("gram", "whole"))
    single = strings.filter("n = 1").join(again, ["gram", "whole"]).select("k", "at", F.lit(SPAN).alias("length"))
    span = lambda low, high: F.struct(low.cast("int").alias("s"), high.cast("int").alias("e"))
    spans = whole.select("k", crc.alias("crc"), span(F.greatest(F.lit(0), offset - (WIDTH - 1)), offset + F.col("run") - 1 + SPAN).alias("x")).union(settled.union(single).select("k", crc.alias("crc"), span(offset, offset + F.col("length")).alias("x")))
    covered = stored(spans.groupBy("k", "crc").agg(F.collect_set("x").alias("x")).select("k", "crc", F.col("x.s").alias("starts"), F.col("x.e").alias("ends")))
    discard(shared, hits, classes, sizes, found, again)
    return covered


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row; kept has the remaining bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumns({"k": F.xxhash64("text"), "crc": F.crc32("text")})
    spans = repeated_spans(keyed)
    return keyed.select("doc_id", "k", "crc", _packed("text").alias("packed")).join(spans, ["k", "crc"], "left").select("doc_id", "packed", "starts", "ends").mapInArrow(remove, RESULT)
