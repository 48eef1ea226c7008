"""Landed metadata: codelists, mappings, structure files, error payloads and archives."""

from __future__ import annotations

import io
import json
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from itertools import islice
from typing import IO

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from ..operators.codes import overlay

ENVELOPE = "codelists struct<codelist:array<struct<`codelist-items`:struct<`codelist-item`:array<struct<status:string,code:string,name:string,dotstatcode:string,`iso-alpha-3-code`:string>>>>>>"
# What an answer says when a table is not found.
NOT_FOUND = ("Could not find Dataflow", "Could not find DSD", "Dataflow not found", "NoRecordsFound")

# The white space that is trimmed from a payload.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Codes that replace or complete the area codelists, in this order.
AREA_CORRECTIONS = {20000: "DAC_EC", 10280: "F5_X", 6790: "S7_X", 10330: "O7_X", 8600: "O8_X", 10350: "O9_X", 918: "4EU001", 20004: "DACEU_EC"}
#: Which landed codelist translates a dataset, below the folder of codelists.
AREA_LISTS = {"dac1": "dac1_codes_area.json", "dac2a": "dac2_codes_area.json", "crs": "dac2_codes_area.json", "cpa": "dac2_codes_area.json", "multisystem": "dac2_codes_area.json"}


def codelist_items(raw: DataFrame, column: str = "value") -> DataFrame:
    """(code, value) of the active rows of codelist envelopes; of a repeated code the last wins."""
    parsed = raw.select(F.from_json(column, ENVELOPE).alias("x"))
    items = parsed.select(F.posexplode(F.get("x.codelists.codelist", F.lit(0))["codelist-items"]["codelist-item"]).alias("at", "i"))
    value = F.coalesce(F.nullif(F.col("i.dotstatcode"), F.lit("")), F.nullif(F.col("i.`iso-alpha-3-code`"), F.lit("")))
    active = items.filter(F.lower("i.status") == "active").select("at", F.col("i.code").alias("code"), value.alias("value")).filter("value is not null")
    return active.groupBy("code").agg(F.max_by("value", "at").alias("value"))


def read_codelist(spark: SparkSession, path: str) -> DataFrame:
    found = codelist_items(spark.read.text(path, wholetext=True))
    if found.isEmpty():
        raise ValueError(f"no active codes in {path}")
    return found


def read_mapping(spark: SparkSession, path: str, keys_as_int: bool = True) -> DataFrame:
    """(code, value, ord) of a JSON object, in its order; keys that aren't digits go where keys are numbers."""
    text = F.col("value")
    pairs = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json(text, "map<string,string>")).alias("ord", "code", "value"))
    out = pairs.select("code", "value", F.col("ord").cast("long").alias("ord"))
    if not keys_as_int:
        return out
    return out.filter(F.col("code").rlike("^[0-9]+$")).withColumn("code", F.col("code").cast("int"))


def area_codes(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(code, value, ord): the landed area codelist of a dataset, root/codelists, with the corrections over it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/codelists/{AREA_LISTS[dataset]}")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        raise FileNotFoundError(f"no codelist {at}: legacy codes need one, or areas, or dotstat_codes=False")
    base = read_mapping(spark, at.toString())
    fixed = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(v).alias("value"), F.lit(n).cast("long").alias("ord")) for n, (c, v) in enumerate(AREA_CORRECTIONS.items(), 1)])
    return overlay(base, spark.range(1).select(F.inline(fixed)))


#: Bytes of a codelist that the driver reads itself.
DRIVER_BYTES = 4_000_000


def area_values(spark: SparkSession, root: str, dataset: str) -> set[str] | None:
    """The values of area_codes(), read without a job; None if the landed codelist is large."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/codelists/{AREA_LISTS[dataset]}")
    fs = path.getFileSystem(conf)
    parts = [path] if fs.getFileStatus(path).isFile() else [s.getPath() for s in fs.listStatus(path) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    if fs.getContentSummary(path).getLength() > DRIVER_BYTES:
        return None
    listed: dict[str, str] = {}
    for part in parts:
        stream = fs.open(part)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        listed |= json.loads(text) if text.strip() else {}
    return {*({int(k): v for k, v in listed.items() if re.fullmatch("[0-9]+", k)} | AREA_CORRECTIONS).values()}


def dataflow_version(xml: Column) -> Column:
    return F.nullif(F.xpath_string(xml, F.lit("//*[local-name()='Dataflow']/@version")), F.lit(""))


def dimension_count(xml: Column) -> Column:
    return F.xpath_int(xml, F.lit("count(//*[local-name()='Dimension'])"))


def read_structure(spark: SparkSession, path: str) -> dict[str, int | str | None]:
    """Version and number of key dimensions of a structure file; an error if it has neither."""
    row = spark.read.text(path, wholetext=True).select(dataflow_version(F.col("value")).alias("version"), dimension_count(F.col("value")).alias("dimensions")).first()
    if row is None or (row.version is None and not row.dimensions):
        raise ValueError(f"no dataflow or dimensions in {path}")
    return row.asDict()


def bulk_file_id(text: Column, label: str) -> Column:
    """What stands between a label and the next closing tag, trimmed, after its last =."""
    found = F.trim(F.regexp_extract(text, rf"(?s)\Q{label}\E(.*?)</", 1))
    return F.nullif(F.element_at(F.split(found, "="), -1), F.lit(""))


def is_error_payload(text: Column) -> Column:
    said = F.lit(False)
    for phrase in NOT_FOUND:
        said |= text.contains(phrase)
    bare = F.btrim(text, F.lit(WHITE))
    return said | ((F.length(bare) < 50) & ~bare.startswith('"') & ~text.contains(",") & ~text.contains("\n"))


def quarantine(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) payloads of a landing folder: (path, value)."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return raw.filter(~is_error_payload(F.col("value"))), raw.filter(is_error_payload(F.col("value")))


def audit_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, ok, reason) of each archive: one file in memory at a time."""

    def audit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        bad = z.testzip()
                    reason = f"bad member {bad}" if bad else None
                except (zipfile.BadZipFile, EOFError, NotImplementedError, OSError, RuntimeError) as e:
                    reason = f"not a readable zip: {e}"
                yield pd.DataFrame({"path": [name], "ok": [reason is None], "reason": [reason]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(audit, "path string, ok boolean, reason string")


def _members(content: bytes, endings: tuple[str, ...]) -> Iterator[tuple[str, IO[bytes]]]:
    """The members of an archive as they unpack."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for member in sorted(z.namelist()):
            if member.lower().endswith(endings):
                with z.open(member) as f:
                    yield member, f


def _spooled(member: IO[bytes]) -> IO[bytes]:
    """A member on the task's disk, where parquet can seek."""
    held = tempfile.TemporaryFile()
    shutil.copyfileobj(member, held, 1 << 20)
    held.seek(0)
    return held


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_parquet_archives(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the parquet members of archives, decoded by tasks, a batch of rows at a time. Columns of all members are
    united; those whose types differ become text."""
    raw = _archives(spark, path)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for _, member in _members(content.as_py(), (".parquet",)):
                    with _spooled(member) as f:
                        yield pa.RecordBatch.from_arrays([pa.array([from_arrow_schema(pq.read_schema(f)).json()])], names=["schema"])

    schemas = [T.StructType.fromJson(json.loads(r.schema)) for r in raw.select("content").mapInArrow(probe, "schema string").distinct().orderBy("schema").collect()]
    if not schemas:
        raise ValueError("No parquet members")
    types: dict[str, set] = {}
    for f in (f for schema in schemas for f in schema):
        types.setdefault(f.name, set()).add(f.dataType)
    merged = T.StructType([T.StructField(c, ts.pop() if len(ts) == 1 else T.StringType()) for c, ts in types.items()])
    arrow = to_arrow_schema(merged)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for _, member in _members(content.as_py(), (".parquet",)):
                    with _spooled(member) as held:
                        for rows in pq.ParquetFile(held).iter_batches():
                            columns = [rows.column(f.name).cast(f.type) if f.name in rows.schema.names else pa.nulls(rows.num_rows, f.type) for f in arrow]
                            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return raw.select("content").mapInArrow(decode, merged)


#: Lines of a member that are held at once.
LINES_AT_ONCE = 50_000


def read_text_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, at, line) of the delimited members of archives, unpacked line by line."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for member, f in _members(content.as_py(), (".csv", ".txt")):
                    text, at = io.TextIOWrapper(f, "utf-8", errors="replace", newline=None), 0
                    while found := [x.rstrip("\n") for x in islice(text, LINES_AT_ONCE)]:
                        n = len(found)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array([member] * n), pa.array(range(at, at + n), pa.int64()), pa.array(found)], names=["path", "member", "at", "line"])
                        at += n

    return _archives(spark, path).mapInArrow(lines, "path string, member string, at long, line string")


def land_archives(spark: SparkSession, path: str, target: str) -> str:
    """Unpacks archives to a folder that read_bulk() reads, and returns it: parquet members as one table if there are any,
    else each delimited member as text, under its clean name. A member's lines stay in order, header first: one task
    unpacks, sorts and writes an archive."""
    from .sinks import clean_member

    target = target.rstrip("/")
    try:
        read_parquet_archives(spark, path).write.mode("overwrite").parquet(f"{target}/parquet")
        return f"{target}/parquet"
    except ValueError:
        found = read_text_archives(spark, path)
    name = F.concat_ws("-", F.regexp_extract("path", "([^/]+?)(?:[.]zip)?$", 1), F.regexp_replace(F.regexp_replace(clean_member(F.col("member")), "[.]parquet$", ""), "/", "-"))
    ordered = found.select(name.alias("member"), "at", F.col("line").alias("value")).sortWithinPartitions("member", "at").drop("at")
    (ordered.write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("member").text(f"{target}/text"))
    return f"{target}/text"
