"""Landed tables: labelled observation files, bulk members, dataset variants and periods."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.projections import DEFAULT_NULLS, isnt, nulls_from_tokens, quoted

DELIMITERS = (",", "|", "\t", ";")
#: Lines of a file that the delimiter is judged by.
SAMPLE_LINES = 50
LABEL_SUFFIX = "_label"


def mangle(header: Sequence[str]) -> list[str]:
    """Repeated names get .1, .2 and so on."""
    seen: Counter = Counter()
    out = []
    for name in header:
        out.append(f"{name}.{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return out


def safe_names(header: Sequence[str]) -> dict[str, str]:
    """Raw name to a name that differs from the others in more than case: a later twin gets a suffix."""
    taken: set[str] = set()
    names = {}
    for raw in header:
        name = raw if raw.lower() not in taken else f"{raw}{LABEL_SUFFIX}"
        taken.add(name.lower())
        names[raw] = name
    return names


#: Small jobs, of one row each, that run at the same time.
AT_ONCE = 16


def plain_path(path: Column) -> Column:
    """A file's name in `_metadata` as encoded() gives it."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def encoded(spark: SparkSession, path: str) -> str:
    """A file's name as Spark writes it in `_metadata`."""
    return re.sub("^file:/+", "file:/", spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().toString())


def _survey(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str, bool]]:
    """(file, header, quoted) of files with a line, in one job: their first lines, and whether quotes of a line don't pair,
    so that a quoted value may hold a line end. A row a file comes to the driver, as its name did."""
    at = F.when(F.col("start") == 0, F.monotonically_increasing_id())  # rows of a file's first block, in order
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    found = lines.withColumns({"at": at, "odd": odd}).groupBy("file").agg(F.min_by("value", "at").alias("header"), F.max("odd").alias("odd"))
    rows = found.select(plain_path(F.col("file")).alias("file"), F.coalesce("header", F.lit("")).alias("header"), "odd").collect()
    given = {encoded(spark, p): p for p in paths}
    return sorted((given[r.file], r.header.lstrip("\ufeff"), r.odd) for r in rows)


def split_header(line: str, sep: str = ",") -> list[str]:
    """The names of a header; an empty name keeps its place."""
    return next(csv.reader([line], delimiter=sep), [])


#: Columns of a read that says where rows come from and which aren't whole; no raw table has such names.
FILE, BROKEN = "__file", "__broken"


def _read(spark: SparkSession, paths: Sequence[str], names: Sequence[str], sep: str, multi_line: bool, marked: bool = False) -> DataFrame:
    """Text columns of files of one header; marked: with the file of each row, and its text if it has fewer or more values
    than the header. Spark tells such rows only where it parses all columns."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, *([BROKEN] if marked else []))])
    options = {"columnPruning": False, "columnNameOfCorruptRecord": BROKEN} if marked else {}
    df = spark.read.options(**options).csv(list(paths), header=True, schema=schema, enforceSchema=True, sep=sep, quote='"', escape='"', multiLine=multi_line, nullValue="")
    return df.select(*[quoted(c) for c in names], plain_path(F.col("_metadata.file_path")).alias(FILE), BROKEN) if marked else df


def _marked(spark: SparkSession, files: Sequence[str], multi_line: bool | None) -> tuple[DataFrame, dict[str, str]] | None:
    """(rows with FILE and BROKEN, names) of labelled files; None if none has a line."""
    by: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for f, line, odd in _survey(spark, files) if files else []:
        if line:
            header = tuple(mangle([x or f"_c{k}" for k, x in enumerate(split_header(line))]))
            by.setdefault((header, odd if multi_line is None else multi_line), []).append(f)
    if not by:
        return None
    names = safe_names(list(dict.fromkeys(x for header, _ in by for x in header)))
    parts = [_read(spark, fs, [names[x] for x in header], ",", lines, marked=True).withColumn("__width", F.lit(len(header))) for (header, lines), fs in by.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), names


def _values(record: Column) -> Column:
    """How many values a record has, commas within quotes aside."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def observations_by_file(spark: SparkSession, files: Sequence[str], multi_line: bool | None = None, aside: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """As read_observations(), of listed files and with a column FILE."""
    found = _marked(spark, files, multi_line)
    if found is None:
        return spark.createDataFrame([], T.StructType([])), {}
    df, names = found
    # Spark refuses a read of nothing but the broken rows' column, as a count would be
    whole = F.col(BROKEN).isNull() & (F.coalesce(F.length(quoted(df.columns[0])), F.lit(0)) >= 0)
    if not aside:
        said = F.concat(F.lit("a row that isn't whole in "), FILE, F.lit(": "), F.col(BROKEN))
        whole = F.when(whole, True).otherwise(F.raise_error(said))
    return df.filter(whole).drop(BROKEN, "__width"), names


def read_observations(spark: SparkSession, path: str, multi_line: bool | None = None, aside: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """A labelled file or folder as text columns, and raw names to the names in the frame.

    Files with one header are one scan; columns of different headers are united by name. One job looks at all files first.
    A file in which quotes of a line don't pair may hold values with line ends, and is read as one task; Spark splits the
    others (multi_line decides this for all files). A row with fewer or more values than the header raises when it is
    read, or is left out with aside; broken_rows() lists such rows.
    """
    df, names = observations_by_file(spark, _list(spark, path), multi_line, aside)
    return (df.drop(FILE) if names else df), names


def broken_rows(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """(file, reason, record): rows of labelled files that aren't whole, with their text."""
    found = _marked(spark, _list(spark, path), multi_line)
    if found is None:
        return spark.createDataFrame([], "file string, reason string, record string")
    n, wide = _values(F.col(BROKEN)), F.col("__width")
    reason = F.when(n < wide, F.concat(n, F.lit(" values of "), wide)).when(n > wide, F.concat(n, F.lit(" values for "), wide)).otherwise("quotes that don't pair")
    kept = found[0].filter(F.col(BROKEN).isNotNull() & (F.coalesce(F.length(quoted(found[0].columns[0])), F.lit(0)) >= 0))
    return kept.select(F.col(FILE).alias("file"), reason.alias("reason"), F.col(BROKEN).alias("record"))


def read_conformed(spark: SparkSession, path: str, multi_line: bool | None = None) -> tuple[DataFrame, dict[str, str]]:
    df, names = read_observations(spark, path, multi_line)
    return nulls_from_tokens(df), names


def _list(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files below path: names only, which the driver plans a scan with anyway."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    found, todo = [], [s.getPath() for s in root.getFileSystem(conf).globStatus(root) or []]
    if not todo:
        raise FileNotFoundError(path)
    fs = root.getFileSystem(conf)
    for top in todo:
        files = fs.listFiles(top, True)
        while files.hasNext():
            at = files.next().getPath()
            if not any(x.startswith(("_", ".")) for x in at.toString()[len(top.toString()) :].split("/") if x):
                found.append(at.toString())
    return sorted(found)


def read_parquet_members(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> DataFrame:
    """All members, columns united, with the folder columns below base. Where types differ, members of one schema are one
    scan, and columns whose types differ become text."""
    try:
        reader = spark.read.option("mergeSchema", True)
        df = (reader.option("basePath", base) if base else reader).parquet(*paths)
        df.schema  # noqa: B018  a merge that fails says so here
        return df
    except Exception as e:
        if "MERGE" not in str(e).upper():
            raise
    with ThreadPool(AT_ONCE) as pool:
        schemas = pool.map(lambda p: spark.read.parquet(p).schema, paths)
    by: dict[str, tuple[T.StructType, list[str]]] = {}
    for p, schema in zip(paths, schemas, strict=True):
        by.setdefault(schema.json(), (schema, []))[1].append(p)
    types: dict[str, set[str]] = {}
    for schema, _ in by.values():
        for f in schema:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    parts = [spark.read.schema(schema).parquet(*members) for schema, members in by.values()]
    one = lambda p: p.select(*[quoted(c).cast("string").alias(c) if len(types[c]) > 1 else quoted(c) for c in p.columns])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, parts))


def detect_delimiter(lines: Sequence[str]) -> str:
    """The candidate that each line has equally often; comma first; else the more frequent of pipe and comma."""
    bare = [re.sub(r'"[^"]*"', "", x) for x in lines if x]
    steady = [d for d in DELIMITERS if bare and bare[0].count(d) and len({x.count(d) for x in bare}) == 1]
    if steady:
        return max(steady, key=lambda d: (d == ",", bare[0].count(d)))
    text = "\n".join(bare)
    return "|" if text.count("|") > text.count(",") else ","


#: What a column of text is tried as, in this order.
TRIED = ("bigint", "double", "boolean")


def with_inferred_types(df: DataFrame) -> DataFrame:
    """df with each text column of the first type that fits all its values, in one pass; columns without values stay text."""
    text = [c for c, t in df.dtypes if t == "string"]
    if not text:
        return df
    failed = [F.count_if(isnt(quoted(c), t)).alias(f"{k} {t}") for k, c in enumerate(text) for t in TRIED]
    row = df.agg(*failed, *[F.count(quoted(c)).alias(f"{k} n") for k, c in enumerate(text)]).first()
    types = {c: next((t for t in TRIED if not row[f"{k} {t}"]), None) if row[f"{k} n"] else None for k, c in enumerate(text)}
    return df.select(*[quoted(c).cast(types[c]).alias(c) if types.get(c) else quoted(c) for c in df.columns])


def read_delimited_members(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """All members, each with its own delimiter, columns united, types inferred after null tokens. Members of one header
    and delimiter are one scan."""
    with ThreadPool(AT_ONCE) as pool:
        samples = pool.map(lambda p: [r[0] for r in spark.read.text(p).limit(SAMPLE_LINES).collect()], paths)
    by: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for p, lines in zip(paths, samples, strict=True):
        if lines:
            sep = detect_delimiter(lines)
            by.setdefault((sep, tuple(mangle([x or f"_c{k}" for k, x in enumerate(split_header(lines[0].lstrip("\ufeff"), sep))]))), []).append(p)
    if not by:
        return spark.createDataFrame([], T.StructType([]))
    parts = [with_inferred_types(nulls_from_tokens(_read(spark, members, header, sep, multi_line), DEFAULT_NULLS)) for (sep, header), members in by.items()]
    types: dict[str, set[str]] = {}
    for p in parts:
        for c, t in p.dtypes:
            types.setdefault(c, set()).add(t)
    wide = {c: "double" if ts == {"bigint", "double"} else "string" for c, ts in types.items() if len(ts) > 1}
    parts = [p.select(*[quoted(c).cast(wide[c]).alias(c) if c in wide else quoted(c) for c in p.columns]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """Members of a landed archive: parquet if there is any, else delimited text."""
    files = _list(spark, path)
    parquet = [f for f in files if f.lower().endswith(".parquet")]
    text = [f for f in files if f.lower().endswith((".csv", ".txt", ".csv.gz", ".txt.gz"))]
    if parquet:
        return read_parquet_members(spark, parquet, None if set(path) & set("*?[{") else path)
    if text:
        return read_delimited_members(spark, text)
    raise ValueError("No parquet, csv, or txt files")


# Where each bulk table lands below a root.
BULK = {"crs": "bulk/crs", "crs_reduced": "bulk/crs_reduced", "dac2a": "bulk/dac2a", "multisystem": "bulk/multisystem"}


def bulk_crs(spark: SparkSession, root: str, reduced_version: bool = False) -> DataFrame:
    """The landed project table, or its landed reduced version."""
    return read_bulk(spark, f"{root.rstrip('/')}/{BULK['crs_reduced' if reduced_version else 'crs']}")


def crs_file(spark: SparkSession, root: str, period: int | str) -> DataFrame:
    """The years of one file of the project table: a year or a label such as 1973-94."""
    df = bulk_crs(spark, root)
    return of_period(df, period, next(c for c in df.columns if c.lower() == "year"))


def bulk_dac2a(spark: SparkSession, root: str) -> DataFrame:
    return read_bulk(spark, f"{root.rstrip('/')}/{BULK['dac2a']}")


def bulk_multisystem(spark: SparkSession, root: str) -> DataFrame:
    return read_bulk(spark, f"{root.rstrip('/')}/{BULK['multisystem']}")


def reduced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The variant with fewer columns; a columnar scan reads only these."""
    return df.select(*[quoted(c) for c in columns if c in df.columns])


def period_bounds(label: int | str) -> tuple[int, int]:
    """A year, or a label such as 1995-99 or 2004-05, as first and last year."""
    found = re.fullmatch(r"(\d{4})(?:-(\d{2}|\d{4}))?", str(label).strip())
    if not found:
        raise ValueError(f"not a year or period: {label!r}")
    low = int(found[1])
    high = low if found[2] is None else int(found[2]) if len(found[2]) == 4 else low - low % 100 + int(found[2])
    if high < low:
        raise ValueError(f"the period {label!r} ends before it begins")
    return low, high


def of_period(df: DataFrame, label: int | str, column: str = "year") -> DataFrame:
    return df.filter(F.col(column).between(*period_bounds(label)))


def read_project_table(spark: SparkSession, path: str) -> DataFrame:
    """The landed sheet of projects, as parquet or delimited text with all columns as text."""
    if any(f.endswith(".parquet") for f in _list(spark, path)):
        return spark.read.parquet(path)
    # descriptions hold line ends
    return nulls_from_tokens(spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True), DEFAULT_NULLS)
