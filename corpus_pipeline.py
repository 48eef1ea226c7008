"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs, so further
columns pass through them. An empty table gives an empty result in each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontamination, line_dedup, near_copies, packing, quality_rules
from tallyspark.llm.common import digest, discard, stored, table

#: The near-duplicate stage's shingles, in words.
NEAR_SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and blank texts have no words and go; rows are judged one by one."""
    return docs.filter(quality_rules.quality(F.col("text"))["kept"])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; n_chars follows where a line went. No row goes."""
    cut = line_dedup.drop_recurring_lines(docs, n_lines="line_dedup n_lines", n_dropped="line_dedup n_dropped")
    n_chars = F.when(F.col("line_dedup n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: fingerprints within the operator's radius, or shingle similarity of 0.8
    or more. The least doc_id stays, null ids last; different texts of one doc_id are different documents; null and blank
    texts are one group."""
    return near_copies.first_of_each(docs, shingle=NEAR_SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. A row goes by its text, so null and repeated ids are no matter; null
    texts stay, and all rows stay if the benchmark is empty."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"), digest(F.col("text")).alias("key"))
    leaks = decontamination.find_leaks(keyed.select("key", "text"), table(spark, sf_dir, "benchmark"), id_col="key").select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(stored(leaks), "key", "left_anti").select(*[F.col(f"doc.`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, of every row; a null text is the closing id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can't hash the shingles; the stages' tests are against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        discard(before)  # of the tables, what stored() wrote
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
