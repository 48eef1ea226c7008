"""Phrase collocations: frequent phrases of two and three words, counted by direct addresses in tiles of word pairs.

1. Texts are cut into blocks of one language, about `BLOCK_BYTES` each, as numbers of the block's own word list, with a
   zero where a piece ends. A block's list of words, each with its count, is exchanged by word: the words that occur
   `least` times or more get numbers by rank of frequency (a rank within each of the exchange's ranges, dealt in turn), and
   each block is told the numbers of its words. Other words can't be part of a candidate and become ends too.
2. Neighbouring numbers are an address in the square of words by words. Ranking gathers frequent pairs in few tiles of
   `TILE` x `TILE` addresses: a tile with at least one pair for `DENSE` addresses is counted by a dense bincount, all
   others by sorting their addresses (coordinates with counts). Counts of blocks meet by address, pairs that occur `least`
   times or more are numbered by rank again, and each block is told the numbers of its pairs, a list from each range.
3. Pairs and the word after them are again a square, counted alike: phrases of three words. Every part of a candidate is
   itself a candidate or a frequent word, so nothing that counts is lost on the way.

Exchanges are by a hash of the word or address: a block sends one row for each, so the most frequent ones come to as many
rows as there are blocks, and ranges are alike in size. Neither words nor pairs are gathered on the driver or broadcast.

Scores are exact in decimals of 38 digits: all terms fit while no count reaches 10**15.

Edge cases: a null text is empty and a null language `und`; texts and pieces without words give nothing; repeated rows
count as often as they stand; of a very long text any part between two pieces may begin a new block; extra columns stay
out; an empty table gives an empty result. Ranks of ties among words change only the order in which tiles are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored, utf8

LEAST, BEST, SHADOWED = 10, 2000, 50
#: Bytes of text in a block, and in a range of an exchange.
BLOCK_BYTES, RANGE_BYTES = 8_000_000, 16_000_000
#: Addresses along a side of a tile, and the most of them for each pair of a tile that is counted densely.
TILE, DENSE = 1024, 16
#: Parts of a language whose best phrases meet at once.
UNITED = 64

#: What ends a piece, and A-Z folded; a byte that UTF-8 never has stands for the end.
_END = b"\xff"
_FOLD = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c for c in range(256))
#: Bytes of a text whose words are listed at once.
_AT_ONCE = 1 << 20
#: Places of a block whose pairs are looked up at once.
_PLACES = 1 << 17
#: The most addresses of a row that a block is told.
_TOLD = 100_000


class _Numbers(dict):
    """Words to numbers in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _parts(text: bytes) -> Iterator[bytes]:
    """A folded text in parts that end where a piece does, of about _AT_ONCE bytes where it has pieces that short."""
    at = 0
    while len(text) - at > 2 * _AT_ONCE:
        end = text.find(_END, at + _AT_ONCE)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


BLOCK = "block long, lang string, seq binary, words array<binary>, counts array<long>"


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (part, lang, text): blocks. A block's number is its task's part and a counter."""
    shrink = zstandard.ZstdCompressor(level=1)
    open_: dict[str, tuple[_Numbers, list[np.ndarray], list[int]]] = {}
    made, part = 0, 0

    def close(lang: str) -> pa.RecordBatch:
        nonlocal made
        numbers, seqs, _ = open_.pop(lang)
        seq = np.concatenate(seqs)
        counts = np.bincount(seq, minlength=len(numbers))
        made += 1
        values = [[part << 32 | made], [lang], [shrink.compress(seq.tobytes())], [list(numbers)[1:]], [counts[1:].tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, (pa.int64(), pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())), strict=True)], names=["block", "lang", "seq", "words", "counts"])

    for batch in batches:
        if batch.num_rows:
            part = batch.column(0)[0].as_py()
        for lang, text in zip(batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
            for some in _parts(text.translate(_FOLD)):
                if lang not in open_:
                    open_[lang] = _Numbers({_END: 0}), [np.zeros(1, np.int32)], [0]
                numbers, seqs, size = open_[lang]
                words = some.replace(_END, b" \xff ").split()
                seqs.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                seqs.append(np.zeros(1, np.int32))
                size[0] += len(some)
                if size[0] >= BLOCK_BYTES:
                    yield close(lang)
                elif sum(x[2][0] for x in open_.values()) > 2 * BLOCK_BYTES:  # many languages
                    yield close(max(open_, key=lambda x: open_[x][2][0]))
    for lang in list(open_):
        yield close(lang)


def _one_a_key(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from rows.filter(rows["first"]).drop_columns("first").to_batches(max_chunksize=100_000)


def _packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """From a range's (address, block, lang, total, number, first): a row an address without a block, and what each block
    is told, as lists of at most _TOLD addresses and their numbers."""
    ones = rows.filter(rows["first"])
    nothing = lambda n, kind: pa.nulls(n, kind)
    many = pa.list_(pa.int64())
    names = ["block", "lang", "address", "total", "number", "addresses", "numbers"]
    for b in ones.to_batches(max_chunksize=100_000):
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([nothing(n, pa.int64()), *(b.column(c) for c in ("lang", "address", "total", "number")), nothing(n, many), nothing(n, many)], names=names)
    blocks = rows["block"].to_numpy()
    order = np.argsort(blocks, kind="stable")
    blocks, addresses, numbers = blocks[order], rows["address"].to_numpy()[order], rows["number"].to_numpy()[order]
    heads = np.append(np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])), len(blocks)).tolist()
    for head, end in zip(heads, heads[1:], strict=False):
        for k in range(head, end, _TOLD):
            lists = [pa.array([x[k : min(k + _TOLD, end)]], many) for x in (addresses, numbers)]
            yield pa.RecordBatch.from_arrays([pa.array([int(blocks[k])], pa.int64()), nothing(1, pa.string()), *[nothing(1, pa.int64())] * 3, *lists], names=names)


def number_frequent(ranges: int, least: int, key: list[str], carried: list[str], given: Callable[[pa.Table], Iterator[pa.RecordBatch]] | None = None):
    """From rows (at, *key, *carried, n) sorted by key: those of keys whose n sum up to least or more, with the sum and
    the key's number, by rank in the range `at`; or what `given` makes of a range's. What is kept of a range is held until
    its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        rest, at = None, 0

        def settle(rows: pa.Table, ends: np.ndarray) -> None:
            """Keeps of rows, whole groups that begin at ends, the frequent ones."""
            sums = np.add.reduceat(rows["n"].to_numpy(), ends)
            sizes = np.diff(np.append(ends, rows.num_rows))
            good = np.repeat(sums >= least, sizes)
            if good.any():
                kept.append(rows.select([*key, *carried]).append_column("total", pa.array(np.repeat(sums, sizes))).append_column("first", pa.array(np.bincount(ends, minlength=rows.num_rows) > 0)).filter(pa.array(good)))

        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0)[0].as_py()
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            rows = rows.combine_chunks()
            changes = [pc.not_equal(rows[c].combine_chunks()[1:], rows[c].combine_chunks()[:-1]).to_numpy(zero_copy_only=False) for c in key]
            heads = np.append(0, np.flatnonzero(reduce(np.logical_or, changes)) + 1)
            if len(heads) > 1:
                settle(rows.slice(0, heads[-1]), heads[:-1])
            rest = rows.slice(heads[-1])  # the last key may go on
        if rest is not None:
            settle(rest, np.zeros(1, np.int64))
        if kept:
            rows = pa.concat_tables(kept).combine_chunks()
            first, total = rows["first"].to_numpy(), rows["total"].to_numpy()
            rank = np.empty(int(first.sum()), np.int64)
            rank[np.argsort(-total[first], kind="stable")] = np.arange(len(rank))
            rows = rows.append_column("number", pa.array((rank * ranges + at)[np.cumsum(first) - 1])).select([*key, *carried, "total", "number", "first"])
            yield from given(rows) if given else rows.to_batches(max_chunksize=100_000)

    return run


def _exchanged(rows: DataFrame, ranges: int, least: int, key: list[str], carried: list[str], kinds: str, given: Callable[[pa.Table], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """rows (*key, *carried, n) of frequent keys with total and number; first marks one row of each key. Or what `given`
    makes of them, as `kinds`."""
    dealt = rows.withColumn("at", F.pmod(F.xxhash64(*key), F.lit(ranges)).cast("int")).select("at", *key, *carried, "n")
    # by a hash first, which is quicker to sort than words
    order = [F.xxhash64(*key), *key] if key != ["address"] else key
    return stored(dealt.repartitionById(ranges, F.col("at")).sortWithinPartitions(*order).mapInArrow(number_frequent(ranges, least, key, carried, given), kinds if given else f"{kinds}, total long, number long, first boolean"))


def count_addresses(first: np.ndarray, second: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(addresses, counts) of pairs of numbers: tile by tile densely where pairs are many, else sorted."""
    side = TILE.bit_length() - 1
    tiles = (first >> side) << (bits - side) | (second >> side)
    order = np.argsort(tiles, kind="stable")
    tiles, inner = tiles[order], ((first & (TILE - 1)) << side | (second & (TILE - 1)))[order]
    heads = np.flatnonzero(np.append(True, tiles[1:] != tiles[:-1])) if len(tiles) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(tiles)))
    dense = sizes * DENSE >= TILE * TILE
    found, counts = [], []
    for head, size in zip(heads[dense].tolist(), sizes[dense].tolist(), strict=True):
        cells = np.bincount(inner[head : head + size], minlength=TILE * TILE)
        full = np.flatnonzero(cells)
        row, column = int(tiles[head]) >> (bits - side), int(tiles[head]) & ((1 << (bits - side)) - 1)
        found.append(((row << side) + (full >> side)) << bits | ((column << side) + (full & (TILE - 1))))
        counts.append(cells[full])
    thin = order[np.repeat(~dense, sizes)]
    addresses, n = np.unique(first[thin] << bits | second[thin], return_counts=True)
    return np.concatenate([*found, addresses]), np.concatenate([*counts, n])


def _sequence(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def _told(found: pa.ChunkedArray, numbers: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, their numbers) of what a block is told."""
    found, numbers = found.to_numpy(), numbers.to_numpy()
    order = np.argsort(found)
    return found[order], numbers[order]


def renumber(blocks: pa.Table, told: pa.Table) -> pa.Table:
    """A block in the numbers of frequent words; -1 at the ends of pieces and for other words."""
    if not blocks.num_rows or not told.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "seq": pa.array([], pa.binary())})
    seq = _sequence(blocks["seq"][0].as_py(), np.int32)
    places, numbers = _told(told["place"], told["number"])
    of = np.full(int(max(seq.max(), places[-1])) + 1, -1)
    of[places] = numbers
    packed = zstandard.ZstdCompressor(level=1).compress(of[seq].tobytes())
    return pa.table({"block": blocks["block"], "lang": blocks["lang"], "seq": pa.array([packed], pa.binary())})


def _counted(block: pa.Array, lang: pa.Array, first: np.ndarray, second: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    addresses, n = count_addresses(first, second, bits)
    for k in range(0, len(n), 100_000):
        some = addresses[k : k + 100_000]
        whole = lambda x: pa.array([x.as_py()] * len(some), x.type)  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays([pa.array(some), whole(block), whole(lang), pa.array(n[k : k + 100_000])], names=["address", "block", "lang", "n"])


def pair_counter(bits: int):
    """From blocks of word numbers: the addresses of their pairs, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, packed in zip(*(batch.column(i) for i in range(3)), strict=True):
                seq = _sequence(packed.as_py(), np.int64)
                pair = (seq[:-1] >= 0) & (seq[1:] >= 0)
                yield from _counted(block, lang, seq[:-1][pair], seq[1:][pair], bits)

    return run


def triple_counter(bits: int):
    """From a block of word numbers and the numbers of its frequent pairs: the addresses of a pair and the word after
    it, of words whose last two are a frequent pair too."""

    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        parts: list[pa.RecordBatch] = []
        if blocks.num_rows and told.num_rows:
            seq = _sequence(blocks["seq"][0].as_py(), np.int64)
            keys, numbers = _told(pc.list_flatten(told["addresses"]), pc.list_flatten(told["numbers"]))
            pair = np.full(len(seq), -1)
            for k in range(0, len(seq) - 1, _PLACES):
                first, second = seq[k : k + _PLACES], seq[k + 1 : k + _PLACES + 1]
                address = first[: len(second)] << bits | second
                at = np.minimum(np.searchsorted(keys, address), len(keys) - 1)
                pair[k : k + len(second)] = np.where((first[: len(second)] >= 0) & (second >= 0) & (keys[at] == address), numbers[at], -1)
            triple = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
            parts = list(_counted(blocks["block"][0], blocks["lang"][0], pair[triple], seq[triple + 2], bits))
        schema = pa.schema([("address", pa.int64()), ("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64())])
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(p.columns, schema=schema) for p in parts], schema)

    return run


def _bits(df: DataFrame, column: str) -> int:
    return max(TILE.bit_length() - 1, int(df.agg(F.max(column)).first()[0] or 0).bit_length())


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    whole = lambda x: x.cast("decimal(15,0)")
    top = (F.lit(1_000_000).cast("decimal(7,0)") * whole(a) * whole(a)).cast("decimal(38,0)")
    return F.call_function("div", top, (whole(left) * whole(right)).cast("decimal(38,0)"))


def mine_phrases(docs: DataFrame, least: int = LEAST, best: int = BEST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the best phrases that occur least times or more."""
    rows = docs.select(F.spark_partition_id().cast("long").alias("part"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    blocks = stored(rows.mapInArrow(cut_blocks, BLOCK))
    listed = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "w")).select("lang", F.col("w.words").alias("word"), "block", (F.col("k") + 1).cast("long").alias("place"), F.col("w.counts").alias("n"))
    said = _exchanged(listed, ranges, least, ["lang", "word"], ["block", "place"], "lang string, word binary, block long, place long")
    sums = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    by = lambda df: df.groupBy("block")
    numbered = stored(by(blocks.select("block", "lang", "seq")).cogroup(by(said.select("block", "place", "number"))).applyInArrow(renumber, "block long, lang string, seq binary"))
    totals = stored(sums)
    words = stored(said.filter("first").select("lang", "number", F.col("word").cast("string").alias("word"), F.col("total").alias("f")))
    bits = _bits(words, "number")
    discard(blocks)
    discard(said)

    kinds = "address long, block long, lang string"
    paired = _exchanged(numbered.mapInArrow(pair_counter(bits), f"{kinds}, n long"), ranges, least, ["address"], ["block", "lang"], "block long, lang string, address long, total long, number long, addresses array<long>, numbers array<long>", _packed)
    pairs = stored(paired.filter("block is null").select("lang", "number", "address", F.col("total").alias("a")))
    if bits + _bits(pairs, "number") > 63:
        raise ValueError("pairs and words have more numbers than an address has")
    triples_in = by(numbered).cogroup(by(paired.filter("block is not null").select("block", "addresses", "numbers"))).applyInArrow(triple_counter(bits), f"{kinds}, n long")
    tripled = _exchanged(triples_in, ranges, least, ["address"], ["lang"], "address long, lang string, total long, number long", _one_a_key)
    triples = tripled.select("lang", "address", F.col("total").alias("a"))
    discard(numbered, paired)
    return _ranked_phrases(words, pairs, triples, totals, bits, best, ranges)


def _ranked_phrases(words: DataFrame, pairs: DataFrame, triples: DataFrame, totals: DataFrame, bits: int, best: int, ranges: int) -> DataFrame:
    high, low = F.shiftright("address", bits), F.col("address").bitwiseAND(F.lit((1 << bits) - 1))
    word = lambda k: words.select(F.col("number").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"))
    two = stored(pairs.select("lang", "number", "address", "a", high.alias("w1"), low.alias("w2")).join(word(1), "w1").join(word(2), "w2"))
    # of three words: the first two as a pair, the last, and the last two as a pair
    three = triples.select("lang", "a", high.alias("pair"), low.alias("w3")).join(two.select(F.col("number").alias("pair"), "word1", "word2", "f1", "w2", F.col("a").alias("f12")), "pair").join(word(3), "w3")
    last = two.select(F.col("number").alias("last_pair"), F.col("address").alias("last"), F.col("a").alias("f23"))
    three = stored(three.withColumn("last", F.shiftleft(F.col("w2"), bits).bitwiseOR(F.col("w3"))).join(last, "last"))
    around = three.select(F.col("pair").alias("number"), "a").union(three.select(F.col("last_pair").alias("number"), "a")).groupBy("number").agg(F.max("a").alias("longer"))
    alone = two.join(around, "number", "left").filter(F.coalesce(100 * F.col("longer") < SHADOWED * F.col("a"), F.lit(True)))
    cut = lambda k, left, right: F.struct(_score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    scored = alone.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", cut(1, "f1", "f2").alias("s"))
    scored = scored.union(three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3")).alias("s")))
    order = [F.col("s.score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of parts of a language first, then of ever fewer parts: a window holds `best` rows of each part it unites
    parts, salts = scored.withColumn("salt", F.xxhash64("phrase")), ranges
    while salts > 1:
        salted = Window.partitionBy("lang", F.pmod("salt", F.lit(salts))).orderBy(*order)
        parts, salts = parts.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= best), salts // UNITED
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").cast("long").alias("score"))
