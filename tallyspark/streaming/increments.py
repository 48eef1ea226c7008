"""New files of a landing folder, conformed and appended as they come; and what is kept of them as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Text members have no row groups to stream.
TEXT = (".csv", ".txt", ".csv.gz", ".txt.gz")
_STORE, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_increments(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 16) -> DataFrame:
    """A stream of the parquet files of a folder; text members are refused, also in the folder."""
    names = [path.rstrip("/")]
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names += [s.getPath().getName() for s in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(jpath, "*")) or []]
    if text := [n for n in names if n.lower().endswith(TEXT)]:
        raise ValueError(f"only parquet members can be read in chunks, not {text[0]}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State of queries that start meanwhile lies in files beside each task, not in its heap."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def append_increments(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, partition: str | None = None) -> None:
    """Runs what has arrived through transform and appends it, once per file across runs.

    The file sink commits a batch by its number, so a batch that is run again after a failure isn't written twice.
    transform is stateless or keeps its state in the stream, as drop_repeated() does.
    """
    writer = transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    with _state_on_disk(stream.sparkSession):
        (writer.partitionBy(partition) if partition else writer).start().awaitTermination()


def drop_repeated(df: DataFrame) -> DataFrame:
    """df without repeated rows, of this batch or any before: of a stream the state holds a digest of each row, 16 bytes.
    Rows that differ in which column is null are different. It grows with the different rows, as the result does."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.withColumn("__row", F.substring(F.unhex(F.sha2(row, 256)), 1, 16)).dropDuplicates(["__row"]).drop("__row")


def _newest(period: str, ties: Sequence[str]) -> Callable[[Any], tuple]:
    """The order of rows from the newest: later periods first, none last, then ties as Spark orders them."""
    return lambda r: (r[period] is None, 0 if r[period] is None else -r[period], *[(r[t] is not None, r[t]) for t in ties])


class _LastRows(StatefulProcessor):
    def __init__(self, schema: StructType, n: int, period: str, ties: Sequence[str]) -> None:
        self.schema, self.n, self.order = schema, n, _newest(period, ties)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        names = self.schema.names
        kept = [Row(**dict(zip(names, r, strict=True))) for r in self.rows.get()]
        for row in rows:
            kept.append(Row(**{c: row[c] for c in names}))
            if len(kept) > 2 * self.n:  # a series of any length
                kept = sorted(kept, key=self.order)[: self.n]
        kept = sorted(kept, key=self.order)[: self.n]
        self.rows.put([tuple(r) for r in kept])
        yield from kept

    def close(self) -> None:
        pass


def keep_last(stream: DataFrame, series: Sequence[str], n: int, target: str, checkpoint: str, period: str = "TIME_PERIOD", ties: Sequence[str] = ()) -> None:
    """Takes what has arrived into the last n rows of each series, which are kept as state, and writes the series that
    changed below target, a folder a batch; read_last() reads them. A batch that is run again replaces its folder. period
    is a number. A series' state is n rows, whatever has arrived of it; late periods count as others do."""
    schema = stream.schema
    changed = stream.groupBy(*series).transformWithState(_LastRows(schema, n, period, ties), schema, "Update", "None")

    def write(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={k}")

    with _state_on_disk(stream.sparkSession):
        changed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start().awaitTermination()


def read_last(spark: SparkSession, target: str, series: Sequence[str], schema: StructType) -> DataFrame:
    """The rows that keep_last() keeps: of each series those of the last batch that changed it."""
    rows = spark.read.schema(StructType(list(schema)).add("batch", "long")).parquet(target)
    newest = F.max("batch").over(Window.partitionBy(*series))
    return rows.withColumn("__newest", newest).filter("batch = __newest").drop("batch", "__newest")
