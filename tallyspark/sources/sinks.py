"""Writing tables, and results kept by what made them."""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_lake(df: DataFrame, path: str, partition: str | None = "year", mode: str = "overwrite") -> None:
    """Parquet by year, so that year filters skip folders. Rows of a year meet first, so a folder gets few files; Spark
    splits a year that is too large for a task and joins small ones."""
    if partition in df.columns:
        df.hint("rebalance", F.col(partition)).write.mode(mode).partitionBy(partition).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """A table of the session's catalog, its files at path: rows lie in buckets by the keys, sorted, a file each. Tables of
    one number of buckets are joined and grouped by these keys without a shuffle."""
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)


def clean_member(name: Column) -> Column:
    """A member's file name as a table name: parquet, lower case, no blanks."""
    return F.lower(F.replace(F.replace(F.replace(name, F.lit(".txt"), F.lit(".parquet")), F.lit(".csv"), F.lit(".parquet")), F.lit(" "), F.lit("_")))


def result_key(**params) -> str:
    """The first 16 hexadecimal digits of the SHA-256 of sorted parameters."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()[:16]


def key_column(columns: list[str]) -> Column:
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(columns))), 256), 1, 16)


#: The file that names an entry's attempt.
POINTER = "current.json"


class Kept:
    """Results kept under a folder by what made them.

    An entry is a folder named by its key, of attempts and a pointer to the one that counts. A result is written to an
    attempt of its own, and then the pointer is replaced in one move, so a reader never sees half a result, the readers of
    the one before keep theirs, and of two writers the later one's counts, whole. The attempt before stays until the next.
    An entry whose files can't be read, or that is older than max_age seconds, is built anew. When entries hold more than
    max_bytes after a write, those that were used longest ago go. A disabled store builds each time and keeps nothing.
    """

    def __init__(self, spark: SparkSession, root: str, enabled: bool = True, max_age: float | None = None, max_bytes: int | None = None) -> None:
        self.spark, self.root, self.enabled, self.max_age, self.max_bytes = spark, root.rstrip("/"), enabled, max_age, max_bytes
        self.hits = self.misses = 0

    def path(self, **params) -> str:
        return f"{self.root}/{result_key(**params)}"

    def _file(self, path: str):
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jpath

    def _pointer(self, path: str) -> dict | None:
        """attempt, and made, the second it was, of an entry."""
        fs, at = self._file(f"{path}/{POINTER}")
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def _point(self, path: str, attempt: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, new = self._file(f"{path}/{POINTER}-{attempt}")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps({"attempt": attempt, "made": time.time()}).encode()))
        out.close()
        options = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getField("OVERWRITE").get(None)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(new), fs.makeQualified(self._file(f"{path}/{POINTER}")[1]), options)

    def _readable(self, path: str) -> DataFrame | None:
        now = self._pointer(path)
        if now is None or (self.max_age is not None and time.time() - now["made"] > self.max_age):
            return None
        fs, done = self._file(f"{path}/{now['attempt']}/_SUCCESS")
        if not fs.exists(done):
            return None
        try:
            df = self.spark.read.parquet(f"{path}/{now['attempt']}")
            df.select(F.lit(1).alias("one")).agg(F.count("*")).first()  # reads every footer
            return df
        except (PySparkException, Py4JJavaError):
            return None

    def get(self, build: Callable[[], DataFrame], **params) -> DataFrame:
        """build()'s result, or what was kept of it."""
        if not self.enabled:
            return build()
        path = self.path(**params)
        found = self._readable(path)
        if found is not None:
            self.hits += 1
            fs, pointer = self._file(f"{path}/{POINTER}")
            fs.setTimes(pointer, int(time.time() * 1000), -1)  # when it was last used
            return found
        self.misses += 1
        before, attempt = self._pointer(path), uuid.uuid4().hex
        build().write.parquet(f"{path}/{attempt}")
        self._point(path, attempt)
        fs, entry = self._file(path)
        for s in fs.listStatus(entry):
            if s.isDirectory() and s.getPath().getName() not in (attempt, (before or {}).get("attempt")) and self._abandoned(s):
                fs.delete(s.getPath(), True)
        self._evict(path)
        return self.spark.read.parquet(f"{path}/{attempt}")

    def _abandoned(self, status) -> bool:
        """Whether an attempt isn't being written: it ended, or nothing happened to it for a day."""
        fs, done = self._file(f"{status.getPath().toString()}/_SUCCESS")
        return fs.exists(done) or time.time() - status.getModificationTime() / 1000 > 86_400

    def _entries(self) -> list:
        """Folders below the root that are named as entries are; others are none of this store's."""
        fs, root = self._file(self.root)
        return [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and re.fullmatch("[0-9a-f]{16}", s.getPath().getName())] if fs.exists(root) else []

    def _evict(self, but: str) -> None:
        if self.max_bytes is None:
            return
        fs, mine = self._file(but)
        held = []
        for entry in self._entries():
            pointer = self._file(f"{entry.toString()}/{POINTER}")[1]
            used = fs.getFileStatus(pointer).getModificationTime() if fs.exists(pointer) else 0
            held.append((entry.getName() == mine.getName(), used, entry.getName(), fs.getContentSummary(entry).getLength(), entry))
        total = sum(x[3] for x in held)
        for new, _, _, size, entry in sorted(held, key=lambda x: x[:3]):
            if total <= self.max_bytes or new:
                break
            fs.delete(entry, True)
            total -= size

    def clear(self, **params) -> bool:
        """Deletes an entry, or all entries without parameters; nothing else that stands in the folder."""
        fs, path = self._file(self.path(**params))
        if params:
            return bool(fs.delete(path, True))
        return all([bool(fs.delete(entry, True)) for entry in self._entries()])

    def stats(self) -> dict[str, int]:
        """Entries, their bytes, and this store's hits and misses."""
        fs, _ = self._file(self.root)
        entries = self._entries()
        return {"entries": len(entries), "bytes": sum(fs.getContentSummary(e).getLength() for e in entries), "hits": self.hits, "misses": self.misses}

    def enable(self) -> None:
        self.enabled = True

    def disable(self) -> None:
        self.enabled = False


def materialize(spark: SparkSession, build: Callable[[], DataFrame], root: str, **params) -> DataFrame:
    """build()'s result, kept under a key of params."""
    return Kept(spark, root).get(build, **params)


def clear(spark: SparkSession, root: str, **params) -> bool:
    return Kept(spark, root).clear(**params)
