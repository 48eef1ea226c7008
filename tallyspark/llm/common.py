"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

#: The white space of the contracts, \x20 and \x09-\x0D, as the characters themselves.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. A local session without one, as in tests, gets a temporary folder;
    on a cluster that is an error, since machines share no such folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


#: Names of the tables that this process has written and may delete.
_WRITTEN: set[str] = set()
#: Spark's own setting that drops a query's shuffle files when it ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """For writes whose result is read from what they wrote: their shuffle files go when they end."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """df, checkpointed: the same partitions, read from the shared folder."""
    shared_folder(df.sparkSession)
    with _dropping_shuffles(df.sparkSession):
        return df.select("*").checkpoint()  # what a frame drops is settled when it is made


def only_row(df: DataFrame) -> Row | None:
    """The first row of an aggregate, whose shuffle files go."""
    with _dropping_shuffles(df.sparkSession):
        return df.select("*").first()


def stored(df: DataFrame) -> DataFrame:
    """df, written as a table in the shared folder and read again: columns make it smaller than a checkpoint."""
    spark = df.sparkSession
    name = f"table-{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    _WRITTEN.add(name)
    with _dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that stored() wrote and nothing reads any more; other tables stay."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if folder.rpartition("/")[2] in _WRITTEN:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def first_by_hash(df: DataFrame, columns: list[str], n: int, by: str | None = None) -> list[Row]:
    """About n rows of df, or n of each value of a column, with the least hashes of some columns, in order; tasks send
    n hashes at most, or a bound a value, not rows."""
    hashed = df.withColumn("__h", F.xxhash64(*columns))
    if by is None:
        bound = hashed.select("__h").orderBy("__h").limit(n).agg(F.max("__h")).first()[0]
        return [] if bound is None else hashed.filter(F.col("__h") <= bound).orderBy("__h", *columns).limit(n).collect()
    w = Window.partitionBy(by).orderBy("__h", *columns)
    # first the hashes alone: Spark drops all but n of a value in each task before it shuffles
    ranked = hashed.select(by, "__h").withColumn("__k", F.row_number().over(Window.partitionBy(by).orderBy("__h"))).filter(F.col("__k") <= n)
    bounds = ranked.groupBy(by).agg(F.max("__h").alias("__bound")).collect()
    if not bounds:
        return []
    most = F.create_map(*[F.lit(x) for r in bounds for x in (r[0], r["__bound"])])
    few = hashed.filter(F.col("__h") <= F.try_element_at(most, F.col(by)))
    return few.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= n).drop("__k").orderBy(by, "__h", *columns).collect()


def digest(x: Column) -> Column:
    """128 bits of the SHA-256 of a text, which stand for it; null for null."""
    return F.substring(F.unhex(F.sha2(x, 256)), 1, 16)


def row_digest(df: DataFrame) -> Column:
    """128 bits that stand for a row of df in all its columns: which of them are null counts too."""
    return digest(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once: lambdas would evaluate an outer expression for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; none for null."""
    found = F.split(F.btrim(text, F.lit(SPACES)), r"[\x20\x09-\x0D]+")
    return F.when(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)) == "", F.array().cast("array<string>")).otherwise(found)


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; empty for null."""
    for x in texts.cast(pa.large_binary()):
        yield x.as_py() or b""


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths sum to most at most, or that hold a single row."""
    start = total = 0
    for k, n in enumerate(lengths.tolist()):
        if k > start and total + n > most:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
