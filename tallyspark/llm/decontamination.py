"""Benchmark decontamination by SimHash of item-sized windows.

A document's windows have as many words as the item they are held against. Each is compared in three steps that lose
nothing but what the fingerprint's radius does:

1. A window of similarity s or more lacks at most 1 - s of an item's shingles, so it holds one of the item's probes: its
   rarest shingles among the items, more than 1 - s of all. Windows without a probe of an item aren't looked at, and
   shingles that many items share are probes of hardly any.
2. Window and item have a 64-bit SimHash of their shingles. A multi-index of 8 blocks lists for each value of each block
   the items whose block differs in at most `RADIUS` // 8 bits: if two fingerprints differ in `RADIUS` bits or fewer, one
   block does. Items that it lists stay if the distance over all 64 bits is within the radius. At similarity 0.8
   fingerprints differ in 9.7 bits on average with a deviation of 2.9, so a radius of 22 misses one in 10^5 or fewer.
   At that radius the index lists 71 % of all items for any fingerprint, which is why the probes come first.
3. Survivors are verified by the exact weighted similarity of their shingles, the sum of least over the sum of greatest
   multiplicities.

The items are the query set: they are read in blocks of about `BLOCK_BYTES`, a bound that the driver and each task hold,
with one pass over the documents a block, whose matches are stored before the next block is read. No document is
shuffled.

Edge cases: null, empty and blank texts hold nothing; an item under `shingle` words is one shingle of all its words, one
without words is passed over; a document shorter than the item is one window; rows are judged one by one, repeated or
not, and null ids are kept; ties of similarity go to the first window; extra columns stay out; empty tables give an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, utf8

SHINGLE, SIMILAR, RADIUS = 5, 0.8, 22
BLOCKS = 8
#: Bytes of item texts in a pass, and of document texts at a time in a task.
BLOCK_BYTES, AT_ONCE = 8_000_000, 1 << 20

_FOLD = np.array([32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """R**i and R**-i modulo 2**64, as far as asked."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, r)])) for r in (_R, _R_INVERSE))


def word_hashes(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, word starts, word ends, word hashes) of texts that a blank follows each."""
    data = _FOLD[np.frombuffer(b"".join(x + b" " for x in texts), np.uint8)]
    powers.reach(len(data) + 1)
    solid = np.concatenate([[False], data != 32, [False]])
    edges = np.nonzero(solid[1:] != solid[:-1])[0]
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[: len(data)])])
    return data, starts, ends, _mixed((sums[ends] - sums[starts]) * powers.down[starts])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n words in a row; for fewer words one of all."""
    if not len(words):
        return words
    n = min(n, len(words))
    count = len(words) - n + 1
    h = words[:count].copy()
    for k in range(1, n):
        h = _mixed(h * _R + words[k : k + count])
    return h


def simhash(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints, as 8 bytes each, of n hashes from each start: a bit is the majority of the hashes' bits."""
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1), axis=0, out=sums[1:])
    return np.packbits(2 * (sums[starts + n] - sums[starts]) > n, axis=1)


def _shingles(words: list[bytes], n: int) -> Counter:
    n = min(n, len(words))
    return Counter(zip(*(words[k:] for k in range(n)), strict=False)) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    shared = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return shared / (a.total() + b.total() - shared) if shared else 0.0


def index(items: list[tuple[Any, bytes]], shingle: int, similar: float, radius: int) -> dict[str, Any]:
    """What a task needs to know of a block of items."""
    powers, names, texts, words, prints, owned = Powers(), [], [], [], [], []
    for name, text in items:
        data, starts, _, hashes = word_hashes([text], powers)
        if len(starts):
            mine = shingle_hashes(hashes, shingle)
            names.append(name)
            texts.append(data.tobytes())
            words.append(len(starts))
            prints.append(simhash(mine, np.zeros(1, np.int64), len(mine)))
            owned.append(mine)
    all_, n_items = np.unique(np.concatenate([np.unique(x) for x in owned]), return_counts=True) if owned else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    probes, owner = [], []
    for k, mine in enumerate(owned):
        own, times = np.unique(mine, return_counts=True)
        order = np.argsort(n_items[np.searchsorted(all_, own)], kind="stable")
        enough = np.cumsum(times[order]) > (1 - similar) * len(mine) + 1e-9
        few = own[order[: int(np.argmax(enough)) + 1]]
        probes.append(few)
        owner.append(np.full(len(few), k))
    at, whose = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((probes, np.uint64), (owner, np.int64)))
    order = np.argsort(at, kind="stable")
    known, first = np.unique(at[order], return_index=True)
    prints = np.concatenate(prints) if prints else np.zeros((0, BLOCKS), np.uint8)
    bits = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
    near = np.stack([np.packbits(bits[:, prints[:, k]] <= radius // BLOCKS, axis=1) for k in range(BLOCKS)])  # block, value, items as bits
    return {"names": names, "texts": texts, "words": np.array(words, np.int64), "prints": prints, "near": near, "known": known, "first": np.append(first, len(at)), "owners": whose[order]}


def search(words: np.ndarray, found: np.ndarray, at: np.ndarray, text, known: dict[str, Any], shingle: int, similar: float, radius: int) -> list[tuple]:
    """(item, similarity, start, words) of a document with probes `found` (places in known) at words `at`."""
    many = known["first"][found + 1] - known["first"][found]
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    item, place = known["owners"][np.repeat(known["first"][found], many) + nth], np.repeat(at, many)
    size = np.minimum(known["words"][item], len(words))
    best: dict[int, tuple] = {}
    for n in np.unique(size).tolist():
        here = size == n
        span, last = max(1, n - shingle + 1), len(words) - n  # shingles of a window, and its last start
        shifted = place[here][:, None] - np.arange(span)
        pair = np.stack([np.repeat(item[here], span), shifted.ravel()], axis=1)
        pair = np.unique(pair[(pair[:, 1] >= 0) & (pair[:, 1] <= last)], axis=0)
        if not len(pair):
            continue
        starts, which = np.unique(pair[:, 1], return_inverse=True)
        low, high = int(starts[0]), int(starts[-1]) + n
        prints = simhash(shingle_hashes(words[low:high], min(shingle, n)), starts - low, span)[which]
        i = pair[:, 0]
        listed = np.zeros(len(pair), bool)
        for k in range(BLOCKS):
            listed |= (known["near"][k][prints[:, k], i >> 3] >> (7 - (i & 7)).astype(np.uint8) & 1).astype(bool)
        listed[listed] = np.bitwise_count(prints[listed] ^ known["prints"][i[listed]]).sum(axis=1) <= radius
        last_item, mine = -1, Counter()
        for k, s in pair[listed].tolist():
            if k != last_item:
                last_item, mine = k, _shingles(known["texts"][k].split(), shingle)
            value = similarity(mine, _shingles(text(s, s + n), shingle))
            if value >= similar and (k not in best or (-value, s) < (-best[k][0], best[k][1])):
                best[k] = (value, s, n)
    return [(known["names"][k], *best[k]) for k in sorted(best)]


MATCH = "item_id long, similarity double, start long, n_words long"


def _matcher(items: list[tuple[Any, bytes]], shingle: int, similar: float, radius: int):
    known = index(items, shingle, similar, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = batch.column(1)
            rows: list[tuple] = []
            for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), AT_ONCE):
                some = list(utf8(texts[a:b]))
                data, starts, ends, hashes = word_hashes(some, powers)
                bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(x) + 1 for x in some])]))
                # shingles as if all were one text: those that cross documents are sorted out below
                found, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for n in sorted({shingle} | {m for m in known["words"].tolist() if m < shingle}):
                    if len(hashes) >= n and len(known["known"]):
                        all_ = shingle_hashes(hashes, n)
                        place = np.minimum(np.searchsorted(known["known"], all_), len(known["known"]) - 1)
                        hit = np.nonzero(known["known"][place] == all_)[0]
                        owner = np.searchsorted(bounds, hit, side="right")
                        hit = hit[hit + n <= bounds[owner]]
                        found.append(place[hit])
                        at.append(hit)
                found, at = np.concatenate(found), np.concatenate(at)
                owner = np.searchsorted(bounds, at, side="right") - 1
                for doc in np.unique(owner).tolist():
                    low, high = bounds[doc], bounds[doc + 1]
                    mine = owner == doc
                    text = lambda s, e, low=low: data[starts[low + s] : ends[low + e - 1]].tobytes().split()
                    rows += [(batch.column(0)[a + doc].as_py(), *x) for x in search(hashes[low:high], found[mine], at[mine] - low, text, known, shingle, similar, radius)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (batch.column(0).type, pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "item_id", "similarity", "start", "n_words"])

    return run


def find_leaks(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, similar: float = SIMILAR, radius: int = RADIUS, text_col: str = "text", id_col: str = "doc_id", item_text_col: str = "text", item_id_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): the best window of each document for each item that it holds; doc_id
    has the type that id_col has."""
    wanted = items.select(F.col(item_id_col).cast("long").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    total = wanted.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    parts = []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for k in range(blocks):
        block = wanted if blocks == 1 else wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        held = [(r.item, r.text.encode()) for r in block.orderBy("item", "text").collect()]
        matches = rows.mapInArrow(_matcher(held, shingle, similar, radius), f"doc_id {rows.schema[0].dataType.simpleString()}, {MATCH}")
        parts.append(matches if blocks == 1 else stored(matches))
    return reduce(DataFrame.union, parts)
