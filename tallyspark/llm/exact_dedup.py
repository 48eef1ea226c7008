"""Exact duplicates by a tree-merge of sorted digest runs.

Each text gets a 64-bit digest, that orders the runs, and its SHA-256, that verifies them: rows of one digest are equal
only if that, 256 bits of it, is too. Each partition sorts its rows into a run and folds equal ones to the row of the
smallest identifier and a count. Partitions then exchange runs in rounds, as in a binomial tree by recursive halving:
the partitions whose numbers differ in one binary digit keep one half each of the digests they have, and after a round
for each digit a partition has one range of digests, complete. `FAN` digits are exchanged at once, so a partition merges
up to 2**FAN runs a round, and each merge again folds equal digests and retains the smallest identifier.

A digest has at most one row a run from the first round on, however many copies a text has, so no group is gathered; a
merge reads sorted rows and holds one. Groups of one never leave the result of the merge: only groups of more rows are
joined with the rows, a join that Spark splits where a group is large.

Edge cases: texts are equal when they are after each `[\\x20\\x09-\\x0D]+` is replaced by one space; a null text is empty;
null ids come after all others, so they name a group only if all its ids are null; of rows with one id and equal texts
exactly one is kept; extra columns stay out of mark_duplicates() and pass through first_of_equal(); an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, utf8

#: Binary digits of a partition's number that one round exchanges.
FAN = 4
MARKED = "doc_id long, tag long, digest long, sha binary"
RUN = "owner int, doc_id long, tag long, digest long, sha binary, size long"
_SPACE = frozenset(b" \t\n\x0b\f\r")


def normalised(text: bytes) -> bytes:
    """text with each stretch of white space as one space."""
    inner = b" ".join(text.split())
    if not inner:
        return b" " if text else b""
    return b" " * (text[0] in _SPACE) + inner + b" " * (text[-1] in _SPACE)


def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, tag, text): digests."""
    for batch in batches:
        digests, shas = [], []
        for text in map(normalised, utf8(batch.column(2))):
            digests.append(xxhash.xxh3_64_intdigest(text))
            shas.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(shas, pa.binary())], names=["doc_id", "tag", "digest", "sha"])


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of RUN, sorted by digest, SHA-256, identifier and tag: one of each text, the first, with their number."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.table(batch.columns, names=batch.schema.names)  # without what the schema says of nulls
        rows = (rows if last is None else pa.concat_tables([pa.Table.from_batches([last]), rows])).combine_chunks()
        digest, sha = rows["digest"].to_numpy(), rows["sha"].combine_chunks()
        new = np.ones(len(digest), bool)
        new[1:] = (digest[1:] != digest[:-1]) | pc.not_equal(sha[1:], sha[:-1]).to_numpy(zero_copy_only=False)
        head = np.flatnonzero(new)
        folded = rows.take(pa.array(head)).set_column(5, "size", pa.array(np.add.reduceat(rows["size"].to_numpy(), head))).combine_chunks().to_batches()[0]
        last = folded.slice(len(head) - 1)
        yield folded.slice(0, len(head) - 1)
    if last is not None:
        yield last


def _merged(run: DataFrame) -> DataFrame:
    return run.sortWithinPartitions("digest", "sha", F.col("doc_id").asc_nulls_last(), "tag").mapInArrow(merge, RUN)


def tree_merge(marked: DataFrame, runs: int, fan: int = FAN) -> DataFrame:
    """RUN, one row for each text of marked, from runs that are its partitions (numbered below runs)."""
    digits = max(1, (runs - 1).bit_length())
    top = F.shiftrightunsigned("digest", 64 - digits).cast("int")
    run = _merged(marked.select((F.spark_partition_id() % (1 << digits)).alias("owner"), "doc_id", "tag", "digest", "sha", F.lit(1).cast("long").alias("size")))
    for done in range(0, digits, fan):
        now = min(fan, digits - done)
        mask = ((1 << now) - 1) << (digits - done - now)
        to = F.col("owner").bitwiseAND(F.lit(((1 << digits) - 1) ^ mask)).bitwiseOR(top.bitwiseAND(F.lit(mask)))
        run = _merged(run.withColumn("owner", to).repartitionById(1 << digits, F.col("owner")))
    return run


def _marked(docs: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """(rows, groups of more than one row) of docs (doc_id, tag, text)."""
    marked = stored(docs.select("doc_id", "tag", "text").mapInArrow(mark, MARKED))
    merged = tree_merge(marked, marked.rdd.getNumPartitions(), fan)
    return marked, stored(merged.filter("size > 1").select("digest", "sha", F.col("doc_id").alias("keep_id"), F.col("tag").alias("keep_tag"), "size"))


def mark_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", fan: int = FAN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row: the identifier of the row that stays of its group of
    equal texts, the group's rows, whether this row stays, and the SHA-256 of the normalised text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("tag"), F.col(text_col).alias("text"))
    marked, groups = _marked(rows, fan)
    alone = F.col("size").isNull()
    return marked.join(groups, ["digest", "sha"], "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("tag") == F.col("keep_tag"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def first_of_equal(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", fan: int = FAN) -> DataFrame:
    """The rows of docs that stay, whole."""
    whole = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("tag")))
    marked, groups = _marked(whole.select(F.col(f"doc.`{id_col}`").cast("long").alias("doc_id"), "tag", F.col(f"doc.`{text_col}`").alias("text")), fan)
    gone = stored(marked.join(groups, ["digest", "sha"]).filter("tag != keep_tag").select("tag"))
    discard(marked, groups)
    return whole.join(gone, "tag", "left_anti").select(*[F.col(f"doc.`{c}`") for c in docs.columns])
