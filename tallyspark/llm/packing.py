"""Packing along a space-filling curve.

A document's vector counts its byte pairs, hashed; its projection to three dimensions is a point of the unit cube, whose
place on a Hilbert curve, followed by a hash that spreads equal points, is the sort key. The documents are range-sorted
by that key, laid end to end, and cut every `length` tokens, so a sequence holds neighbours of the curve and only the
very last one can need padding. A range is for `RANGE_BYTES` of text, so what a task sorts doesn't grow with the table
until there are `MOST_RANGES`. Their bounds come from a histogram: bytes of text by the first bits of the key, and of those
cells that hold more than a range by further bits, level by level, at most `CELLS` cells at once. Each is a sum that tasks
begin and the shuffle ends; no task and no row sees more.

The merges run in a compiled library that reads the tokenizer file's vocabulary and added tokens; tests hold its ids
against the tokenizer's own.

Edge cases: a null or empty text is the closing id alone; repeated rows and null ids are packed row by row, ordered by
key, id and token ids, so rows that tie in all of them are alike; extra columns stay out; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, discard, slices, stored, utf8

LENGTH, CLOSING_ID = 1024, 0
#: Text of a range, and the most ranges, a number each on the driver and in every task (beyond, ranges grow).
RANGE_BYTES, MOST_RANGES = 24_000_000, 65_536
#: Bits of a key that the first histogram counts by, and the most cells of one.
FIRST_BITS, CELLS = 16, 1 << 20
#: Dimensions, bits of each on the curve, what a projection is stretched by, and bits of the spreading hash.
DIMENSIONS, BITS, SPREAD, TIE_BITS = 3, 10, 2.5, 32


def _ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer file as byte strings with their ids."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves
    written = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return {bytes(written[c] for c in token): k for token, k in vocabulary.items() if all(c in written for c in token)}


def _special(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file, which are found in texts before any merge."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if odd := [t["content"] for t in added if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]:
        raise ValueError(f"added tokens that take in what is around them: {odd}")
    return {t["content"]: t["id"] for t in added}


def encoder(path: str) -> Callable[[str], list[int]]:
    """A function from a text to its ids, without the tokens that a tokenizer adds or the closing id."""
    import tiktoken

    ranks, special = _ranks(path), _special(path)
    for token in special:
        ranks.pop(token.encode(), None)
    coding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: coding.encode(text, allowed_special="all")


def projection() -> np.ndarray:
    """For each pair of bytes the projection of its hashed unit vector, from a mix of its bits."""
    x = np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return np.stack([(x >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.float32) / 32768 - 1 for k in range(DIMENSIONS)])


def curve_places(texts: list[bytes], project: np.ndarray) -> np.ndarray:
    """The place of each text on the curve."""
    mean = np.zeros((len(texts), DIMENSIONS), np.float32)
    for k, text in enumerate(texts):
        if len(text) > 1:
            data = np.frombuffer(text, np.uint8)
            pairs = (data[:-1].astype(np.uint16) << 8) | data[1:]
            mean[k] = [row[pairs].mean() for row in project]
    return hilbert(np.clip((mean * SPREAD + 0.5) * 2**BITS, 0, 2**BITS - 1).astype(np.int64))


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows), by Skilling's transform."""
    x = points.astype(np.int64).copy()
    n, q = x.shape[1], 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[:, i] & q) > 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] = np.where(on, x[:, 0] ^ p, x[:, 0] ^ swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t, q = np.zeros(len(x), np.int64), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[:, n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    out = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[:, i] >> b) & 1)
    return out


KEYED = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "bytes")])
TOKENS = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc_id", "key")), *(T.StructField(c, T.LongType()) for c in ("bucket", "n")), T.StructField("ids", T.BinaryType())])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(ids, texts, keys) of some rows at a time, from (doc_id, tie, text)."""
    project = projection()
    for batch in batches:
        texts = batch.column(2)
        for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 1 << 22):
            some = texts[a:b]
            yield batch.column(0)[a:b], some, curve_places(list(utf8(some)), project) << TIE_BITS | batch.column(1)[a:b].to_numpy(zero_copy_only=False)


def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts, keys in _keys(batches):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())], names=KEYED.names)


KEY_BITS = DIMENSIONS * BITS + TIE_BITS


def range_bounds(keyed: DataFrame, range_bytes: int, most: int) -> list[int]:
    """Keys at which ranges of about range_bytes begin, but for the first, at most `most`, from keyed (key, bytes)."""
    def cells(rows: DataFrame, bits: int) -> dict[int, int]:
        counted = rows.groupBy(F.shiftright("key", KEY_BITS - bits).alias("cell")).agg(F.sum("bytes").alias("bytes"))
        return {r.cell: r.bytes for r in counted.filter("bytes > 0").collect()}

    bits, now, leaves = min(FIRST_BITS, CELLS.bit_length() - 1), {}, []
    now = cells(keyed, bits)
    goal = max(range_bytes, -(-sum(now.values()) // most))
    while True:
        heavy = {c for c, n in now.items() if n > goal} if bits < KEY_BITS else set()
        leaves += [(c << (KEY_BITS - bits), n) for c, n in now.items() if c not in heavy]
        if not heavy:
            break
        more = min(KEY_BITS - bits, max(1, (CELLS // len(heavy)).bit_length() - 1))
        chosen = keyed.sparkSession.createDataFrame([(c,) for c in heavy], "cell long")  # of `most` rows at most
        now = cells(keyed.join(F.broadcast(chosen), F.shiftright("key", KEY_BITS - bits) == F.col("cell"), "left_semi"), bits + more)
        bits += more
    bounds, held = [], 0
    for start, n in sorted(leaves):
        if held and held + n > goal:
            bounds.append(start)
            held = 0
        held += n
    return bounds


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, text_col: str = "text", id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The pieces of each document; with_ids adds each piece's ids as an array.

    The driver sees two numbers a range, its bound and its tokens, and the cells of histograms.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, F.length(text_col)).bitwiseAND(F.lit((1 << TIE_BITS) - 1)).alias("tie"), F.col(text_col).alias("text"))
    keyed = stored(rows.mapInArrow(place, KEYED))
    bounds = np.array(range_bounds(keyed, RANGE_BYTES, MOST_RANGES), np.int64)
    discard(keyed)
    with open(path, encoding="utf-8") as f:
        wide = max(json.load(f)["model"]["vocab"].values()) >= 1 << 16  # of ids
    stored_ids = "<u4" if wide else "<u2"

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shrink = encoder(path), zstandard.ZstdCompressor(level=1)
        for names, texts, keys in _keys(batches):
            ids = [array("I" if wide else "H", [*encode(x or ""), CLOSING_ID]) for x in texts.to_pylist()]
            packed = [shrink.compress(x.tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(keys), pa.array(np.searchsorted(bounds, keys, side="right")), pa.array([len(x) for x in ids], pa.int64()), pa.array(packed, pa.binary())], names=TOKENS.names
            )

    laid = cut_lineage(rows.mapInArrow(tokenize, TOKENS).repartitionById(len(bounds) + 1, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "key", "doc_id", "ids"))
    starts, total = {}, 0
    for bucket, n in sorted(laid.groupBy("bucket").agg(F.sum("n")).collect()):
        starts[bucket] = total
        total += n

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, expand = None, 0, zstandard.ZstdDecompressor()
        for batch in batches:
            rows: list[tuple] = []
            for doc, bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if bucket != now:
                    now, at = bucket, starts[bucket]
                ids = np.frombuffer(expand.decompress(packed.as_py()), stored_ids).astype("<u4")
                start = 0
                while start < len(ids):
                    n = min(len(ids) - start, length - at % length)
                    piece = ids[start : start + n]
                    rows.append((doc, start, n, zlib.crc32(piece.tobytes()), len(ids), at // length, at % length, *([piece.tolist()] if with_ids else [])))
                    start, at = start + n, at + n
            if rows:
                types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f"c{k}" for k in range(len(types))])

    return laid.select("doc_id", "bucket", "ids").mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)
