"""Periodic runs: stretches of words that repeat with a period, found along same-document diagonals.

A run is a stretch of words with smallest period q and at least `LEAST` words and `TIMES` periods that no neighbouring
word extends. It meets itself, moved by q, in max(LEAST, TIMES * q) - q words at least: 16 or more for any q, and over k
words for q over k / 2. So the periods are taken in levels, up to 16, to 32, to 64 and so on, and each level indexes the
k-grams of its greatest period k, which every run of the level is sure to hold at two places q apart:

1. k-grams are numbered exactly, those of 2k words from the pair of numbers of their halves. Only places whose k-gram
   stands elsewhere in the same document go on to the next length, so most texts end at a few words.
2. Seeds are pairs of neighbouring places of one k-gram whose distance (lag) belongs to the level. In a run of period q
   the k-gram at each place stands next q words on and not before: two periods of at most k that meet in k words would
   have a common smaller one. So neighbouring places suffice, and a k-gram with m places gives m - 1 pairs.
3. Seeds of a lag are extended along their diagonal in order of place. The lag's entry in the table of furthest covered
   places is where the last extension ended, and a seed that it covers starts none.

Edge cases: null, empty and blank texts have no words and no runs; texts under `LEAST` words have no runs; repeated rows
and ids, null ids too, are judged row by row; extra columns stay out; an empty table gives an empty result. A text's
words are held in one task, about 100 bytes each while it is searched; the next text isn't begun with it once a slice
holds `AT_ONCE` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, slices, words_of

LEAST, TIMES = 24, 3
#: The least overlap of a run with itself, which is the length of the first level's k-grams.
SEED = 16
#: Bytes of text that are searched together.
AT_ONCE = 1 << 22

RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"


def _repeated(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, numbers) of keys that occur more than once, by number and place; places come in order."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.cumsum(new) - 1
    many = (np.bincount(number) > 1)[number]
    return places[order[many]], number[many]


def _extended(places: np.ndarray, lags: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the stretches that seeds of one level lie on."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    # a seed k words long is covered if its lag's last extension reaches the word before its last one
    covered = np.zeros(len(places), bool)
    covered[1:] = (lags[1:] == lags[:-1]) & (places[1:] == places[:-1] + 1)
    first = np.flatnonzero(~covered)
    last = np.append(first[1:], len(places))[: len(first)] - 1
    yield from zip(places[first].tolist(), (places[last] - places[first] + lags[first] + k).tolist(), lags[first].tolist(), strict=True)


def runs_of(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period. words are numbers, equal for equal words of one
    document alone; ends has for each word where its document ends."""
    found, n, k = [], len(words), 1
    places, number = _repeated(words, np.arange(n))
    while len(places):
        if k >= SEED:
            lags = places[1:] - places[:-1]
            seed = (number[1:] == number[:-1]) & (lags <= k) & (lags > (k // 2 if k > SEED else 0))
            found += [x for x in _extended(places[:-1][seed], lags[seed], k) if x[1] >= max(LEAST, TIMES * x[2])]
        numbers = np.full(n + k, -1)
        numbers[places] = number
        places = np.sort(places)
        places = places[(places + 2 * k <= ends[places]) & (numbers[places + k] >= 0)]
        places, number = _repeated(numbers[places] * n + numbers[places + k], places)
        k *= 2
    return sorted(found, key=lambda x: (x[0], x[2]))


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; of equals the first, then the one of least period."""
    best = None
    for x in runs:
        if best is None or x[1] * best[2] > best[1] * x[2]:
            best = x
    return best


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, text): the runs of each text, and its words without the repeats."""
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    struct = lambda x: dict(zip(("start", "length", "period"), x, strict=True)) if x else None
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        for a, b in slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), AT_ONCE):
            lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts[a:b]))
            flat = lists.flatten()
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            blank = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # the one word of a text without words
            owner = np.repeat(np.arange(b - a), counts)
            if blank.any():
                flat = flat.filter(pa.array(~blank))
                owner = owner[~blank]
                counts = np.bincount(owner, minlength=b - a)
            stops = np.cumsum(counts)
            starts = stops - counts
            ids = flat.dictionary_encode()
            words = owner * max(1, len(ids.dictionary)) + ids.indices.to_numpy(zero_copy_only=False)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in range(b - a)]
            keep = np.ones(len(words), bool)
            for start, length, period in runs_of(words, stops[owner]):
                runs[owner[start]].append((start - int(starts[owner[start]]), length, period))
                keep[start + period : start + length] = False
            left = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=b - a))]).astype(np.int32)
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), flat.filter(pa.array(keep))), " ")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], pa.array(counts), pa.array([[struct(x) for x in found] for found in runs], pa.list_(run)), pa.array([struct(_strongest(found)) for found in runs], run), collapsed],
                names=["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )


def find_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, runs, strongest, collapsed) for each row: its runs by start and period, the one with the most
    periods, and its words joined by blanks without those that lie in a run after the run's first period."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(search, FOUND)


def planted(text: Column, doc_id: Column) -> Column:
    """A text in which, for about one doc_id in ten, the words from some place on repeat with some period, both told by
    the identifier's CRC-32; other texts, and those of null ids, as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        taken = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(taken, " "))

    return F.when(h % 10 == 0, bind(words_of(text), repeat)).otherwise(text)
