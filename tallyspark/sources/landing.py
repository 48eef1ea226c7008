"""Landed tables: a dataset's text files as parquet by year, with a log of what was taken in.

A table is a folder with

- `data/attempt=<id>/year_folder=<year>/*.parquet`: what one landing wrote, rows as raw text with the file of each,
- `log/<version>.json`: commits. One names the attempts that make up the table, its columns, the statistics of its
  columns, a digest of the listing that it took in, and the file beside it that has this listing.

A commit is written beside the log and moved to its place, which fails where another landing has been quicker; that one's
version is then taken into account and the landing begins anew. Attempts that no commit names are never read, so a crash
between write and commit leaves the version before. The move is atomic on file systems that rename (local, HDFS).

land() compares the listing (path, length, time) with the log. Files that are new are read and added; of files that are
gone or have changed, the attempts that hold their rows are written anew without them. So the work follows what changed.

Statistics are counted per year folder and drilldown value, which all reads pin: rows, values and values that aren't of
their column's type, so counts of any years are sums. They give a read its types and empty columns without a pass over
the data. Codes of areas and prices are listed, up to `MOST_CODES`, to tell whether any of them translates.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import YEAR
from ..operators.projections import failed_casts, nulls_from_tokens, quoted
from .readers import FILE, encoded, observations_by_file
from .sinks import write_lake

#: The folder column of landed tables; the year stays a column of its own.
YEAR_FOLDER = "year_folder"
#: The raw column whose value each read of a table that has it pins.
PINNED = "MD_DIM"
#: Columns whose codes are listed, and the most codes of one.
CODED, MOST_CODES = ("DONOR", "RECIPIENT", "PRICE_BASE"), 5_000
#: Attempts of a table above which a landing writes the whole table anew.
MOST_ATTEMPTS = 64
#: Landings that a landing gives way to.
RETRIES = 5


@dataclass
class Version:
    """What a commit says. stats: (year folder, pinned value, column) to (rows with a value, values that aren't of its
    type); codes: column to its codes, None if they are too many."""

    number: int
    listing: str
    files: str
    attempts: list[str]
    columns: list[tuple[str, str]]
    stats: list[tuple[str | None, str | None, dict[str, tuple[int, int]]]] = field(default_factory=list)
    codes: dict[str, list[str] | None] = field(default_factory=dict)

    def counts(self, years: Callable[[str | None], bool], pinned: str | None = None) -> dict[str, tuple[int, int]]:
        """Raw column to (values, values that aren't of its type) over some years and, if given, one drilldown value."""
        total = {raw: (0, 0) for raw, _ in self.columns}
        for year, drilldown, counted in self.stats:
            if years(year) and (pinned is None or drilldown == pinned):
                for c, (n, bad) in counted.items():
                    total[c] = (total[c][0] + n, total[c][1] + bad)
        return total

    def years(self) -> list[int]:
        """Years that the table has rows of, by its folders."""
        return sorted({int(y) for y, _, _ in self.stats if y is not None and y.isdigit()})


class Landed:
    """The landed table of a dataset at path, taken in from the files below source."""

    def __init__(self, spark: SparkSession, dataset: str, source: str, path: str) -> None:
        self.spark, self.dataset, self.source, self.path = spark, dataset, source.rstrip("/"), path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._conf, self._fs_package = spark.sparkContext._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs
        self._jvm = jvm

    # files

    def _at(self, path: str):
        p = self._fs_package.Path(path)
        return p.getFileSystem(self._conf), p

    def _read(self, path: str) -> Any:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, path: str, value: Any) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()

    def listing(self) -> dict[str, tuple[int, int]]:
        """Data files below the source: path to length and time; names, as the driver plans a scan with."""
        fs, root = self._at(self.source)
        found = {}
        if not fs.exists(root):
            raise FileNotFoundError(self.source)
        top = len(fs.makeQualified(root).toString())
        files = fs.listFiles(root, True)
        while files.hasNext():
            status = files.next()
            at = status.getPath()
            if not any(x.startswith(("_", ".")) for x in at.toString()[top:].split("/") if x):
                found[at.toString()] = (status.getLen(), status.getModificationTime())
        return dict(sorted(found.items()))

    # log

    def version(self) -> Version | None:
        """The last commit."""
        fs, log = self._at(f"{self.path}/log")
        if not fs.exists(log):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return None
        x = self._read(f"{self.path}/log/{max(numbers):010d}.json")
        stats = [(y, p, {c: tuple(v) for c, v in counted.items()}) for y, p, counted in x["stats"]]
        return Version(max(numbers), x["listing"], x["files"], x["attempts"], [tuple(c) for c in x["columns"]], stats, x["codes"])

    def _commit(self, version: Version, files: Mapping[str, Sequence]) -> bool:
        """False if the version's number is taken."""
        self._write(f"{self.path}/log/{version.files}", files)
        pending = f"{self.path}/pending/{uuid.uuid4().hex}.json"
        self._write(pending, vars(version))
        fs, target = self._at(f"{self.path}/log/{version.number:010d}.json")
        if fs.exists(target):
            return False
        context = self._fs_package.FileContext.getFileContext(target.getFileSystem(self._conf).getUri(), self._conf)
        options = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self._at(pending)[1], target, options)  # fails where there is a file
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def _taken(self, version: Version) -> dict[str, tuple[int, int, str]]:
        return {f: tuple(x) for f, x in self._read(f"{self.path}/log/{version.files}").items()}

    # landing

    def land(self, multi_line: bool | None = None, aside: bool = False) -> Version:
        """Takes in what has changed since the last commit; returns the version that has it."""
        for _ in range(RETRIES):
            now, files = self.version(), self.listing()
            listing = _digest(files)
            if now is not None and now.listing == listing:
                return now
            made = self._next(now, files, listing, multi_line, aside)
            if made is not None:
                return made
        raise RuntimeError(f"other landings of {self.path} were quicker {RETRIES} times")

    def _next(self, now: Version | None, files: dict[str, tuple[int, int]], listing: str, multi_line: bool | None, aside: bool) -> Version | None:
        taken = self._taken(now) if now else {}
        gone = {f for f, x in taken.items() if files.get(f) != tuple(x[:2])}
        added = [f for f in files if f not in taken or f in gone]
        attempt = uuid.uuid4().hex
        parts, names = [], dict(now.columns) if now else {}
        # the parser's names of new columns give way to those that the table has
        if added:
            df, found = observations_by_file(self.spark, added, multi_line, aside)
            if found:
                for raw, name in found.items():
                    names.setdefault(raw, name if name.lower() not in {x.lower() for x in names.values()} else f"{name}_{len(names)}")
                parts.append(df.select(FILE, *[quoted(n).alias(names[raw]) for raw, n in found.items()]))
        old = {taken[f][2] for f in gone} & set(now.attempts if now else [])  # one without a row is no part of the table
        if now and len(now.attempts) >= MOST_ATTEMPTS:
            old = set(now.attempts)
        if old and now:
            held = self._attempts(now, sorted(old)).drop(YEAR_FOLDER)
            parts.append(self._without(held, gone))
        attempts = [a for a in (now.attempts if now else []) if a not in old]
        stats, codes = [], {}
        if parts:
            df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
            year = quoted(names[YEAR]) if YEAR in names else F.lit(None).cast("string")
            write_lake(df.withColumn(YEAR_FOLDER, year), f"{self.path}/data/attempt={attempt}", YEAR_FOLDER)
            attempts.append(attempt)
        version = Version((now.number if now else 0) + 1, listing, f"{attempt}.files", attempts, list(names.items()))
        if parts:
            stats, codes = self._profile(version, attempt)
            if not stats:  # no row
                attempts.remove(attempt)
        # what the attempts that stay have counted, kept by attempt beside the log
        self._write(f"{self.path}/stats/{attempt}.json", {"stats": stats, "codes": codes})
        version.stats, version.codes = _merged([self._read(f"{self.path}/stats/{a}.json") for a in attempts])
        moved = {f: a for f, (_, _, a) in taken.items() if a not in old and f not in gone}
        return version if self._commit(version, {f: [*x, moved.get(f, attempt)] for f, x in files.items()}) else None

    def _without(self, df: DataFrame, gone: set[str]) -> DataFrame:
        names = [encoded(self.spark, f) for f in sorted(gone)]
        if len(names) <= 1000:
            return df.filter(~F.col(FILE).isin(*names)) if names else df
        return df.join(self.spark.createDataFrame([(f,) for f in names], f"{FILE} string"), FILE, "left_anti")

    def _profile(self, version: Version, attempt: str) -> tuple[list, dict]:
        """Counts of an attempt by year folder and drilldown value, and its codes."""
        df, names = self._attempts(version, [attempt]), dict(version.columns)
        clean = nulls_from_tokens(df)
        failed = failed_casts(clean, self.dataset, names)
        keyed = clean.withColumns({"__year": F.col(YEAR_FOLDER), "__pinned": quoted(names[PINNED]) if PINNED in names else F.lit(None).cast("string")})
        counted = [F.struct(F.count(quoted(n)).alias("n"), failed.get(raw, F.lit(0).cast("long")).alias("bad")).alias(f"c{k}") for k, (raw, n) in enumerate(version.columns)]
        rows = keyed.groupBy("__year", "__pinned").agg(*counted).collect()  # a row a year and drilldown value
        stats = [[r["__year"], r["__pinned"], {raw: [r[f"c{k}"]["n"], r[f"c{k}"]["bad"]] for k, (raw, _) in enumerate(version.columns)}] for r in rows]
        codes: dict[str, list[str] | None] = {}
        for raw in CODED:
            if raw in names:
                found = [r[0] for r in clean.select(quoted(names[raw])).dropna().distinct().limit(MOST_CODES + 1).collect()]
                codes[raw] = sorted(found) if len(found) <= MOST_CODES else None
        return stats, codes

    # reading

    def _attempts(self, version: Version, attempts: Iterable[str]) -> DataFrame:
        fields = [T.StructField(n, T.StringType()) for n in (FILE, *(name for _, name in version.columns), "attempt", YEAR_FOLDER)]
        paths = [f"{self.path}/data/attempt={a}" for a in attempts]
        if not paths:
            return self.spark.createDataFrame([], T.StructType(fields)).drop("attempt")
        return self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/data").parquet(*paths).drop("attempt")

    def read(self, version: Version, years: Column | None = None) -> tuple[DataFrame, dict[str, str]]:
        """The table as of a version as text columns, and raw names to those in the frame; no job is run. years: a
        predicate on YEAR_FOLDER, by which folders are skipped."""
        df = self._attempts(version, version.attempts)
        if years is not None:
            df = df.filter(years)
        return df.drop(FILE, YEAR_FOLDER), dict(version.columns)

    def vacuum(self, keep: int = 2) -> int:
        """Deletes attempts that none of the last versions names; returns how many. Readers of older versions lose them,
        and so does a landing that hasn't committed yet, so none may run."""
        last = self.version()
        if last is None:
            return 0
        named: set[str] = set()
        for k in range(max(1, last.number - keep + 1), last.number + 1):
            named |= set(self._read(f"{self.path}/log/{k:010d}.json")["attempts"])
        fs, data = self._at(f"{self.path}/data")
        if not fs.exists(data):
            return 0
        idle = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName().removeprefix("attempt=") not in named]
        return sum(bool(fs.delete(p, True)) for p in idle)


def _digest(files: Mapping[str, tuple[int, int]]) -> str:
    h = hashlib.sha256()
    for f, (length, time) in files.items():
        h.update(f"{f}\0{length}\0{time}\n".encode())
    return h.hexdigest()


def _merged(parts: Sequence[Mapping]) -> tuple[list, dict]:
    """Statistics of attempts as those of one table."""
    total: dict[tuple, dict[str, tuple[int, int]]] = {}
    codes: dict[str, list[str] | None] = {}
    for part in parts:
        for year, pinned, counted in part["stats"]:
            to = total.setdefault((year, pinned), {})
            for c, (n, bad) in counted.items():
                a, b = to.get(c, (0, 0))
                to[c] = (a + n, b + bad)
        for c, found in part["codes"].items():
            both = None if found is None or codes.get(c, []) is None else sorted({*codes.get(c, []), *found})
            codes[c] = both if both is None or len(both) <= MOST_CODES else None
    return [(y, p, counted) for (y, p), counted in total.items()], codes
