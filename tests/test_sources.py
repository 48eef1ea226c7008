import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyspark.functions import urls
from tallyspark.sources import metadata, readers, sinks
from tallyspark.operators import codes
from tallyspark.streaming.increments import append_increments, drop_repeated, keep_last, read_increments, read_last


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_case_twins_and_repeated_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'DONOR,Donor,RMNCH,RMNCH,OBS_VALUE\nFRA,"France, the",1,yes,2.5\n_Z,NA,,x,nan\n')
    df, names = readers.read_conformed(spark, path)
    assert df.columns == ["DONOR", "Donor_label", "RMNCH", "RMNCH.1", "OBS_VALUE"]
    assert names["Donor"] == "Donor_label"
    assert [tuple(r) for r in df.collect()] == [("FRA", "France, the", "1", "yes", "2.5"), (None, None, None, "x", None)]


@pytest.mark.parametrize(("lines", "sep"), [(["a,b,c", "1,2,3"], ","), (["a|b|c", "1|2|3"], "|"), (["a\tb", "1\t2"], "\t"), (["a;b", "1;2"], ";"), (["one", "two"], ","), (['a|"x|y"', "1|2"], "|"), (["a|b|c,d", "x|y"], "|")])
def test_delimiter(lines, sep):
    assert readers.detect_delimiter(lines) == sep


def test_bulk_dispatch(spark, tmp_path):
    write(tmp_path / "t/x.csv", "a,b\n1,u\n")
    write(tmp_path / "t/y.txt", "a|c\n2|NA\n")
    rows = {(r.a, r.b, r.c) for r in readers.read_bulk(spark, str(tmp_path / "t")).collect()}
    assert rows == {(1, "u", None), (2, None, None)}
    pq.write_table(pa.table({"a": [7]}), tmp_path / "t/z.parquet")
    assert readers.read_bulk(spark, str(tmp_path / "t")).collect()[0].a == 7
    write(tmp_path / "n/readme.md", "x")
    with pytest.raises(ValueError, match="No parquet, csv, or txt files"):
        readers.read_bulk(spark, str(tmp_path / "n"))


def test_parquet_members_of_different_types(spark, tmp_path):
    pq.write_table(pa.table({"a": [1], "b": ["x"]}), tmp_path / "1.parquet")
    pq.write_table(pa.table({"a": ["q"], "c": [2.0]}), tmp_path / "2.parquet")
    rows = {tuple(r) for r in readers.read_bulk(spark, str(tmp_path)).select("a", "b", "c").collect()}
    assert rows == {("1", "x", None), ("q", None, 2.0)}


def test_periods():
    assert [readers.period_bounds(x) for x in (1999, "1995-99", "1973-94", "2004-05")] == [(1999, 1999), (1995, 1999), (1973, 1994), (2004, 2005)]
    with pytest.raises(ValueError):
        readers.period_bounds("199")


def test_codelist(spark, tmp_path):
    items = [{"status": "Active", "code": "1", "dotstatcode": "AUT"}, {"status": "active", "code": "2", "iso-alpha-3-code": "BEL", "dotstatcode": ""}, {"status": "inactive", "code": "3", "dotstatcode": "X"}, {"status": "active", "code": "4"}, {"status": "active", "code": "1", "dotstatcode": "AUZ"}]
    path = write(tmp_path / "c.json", json.dumps({"codelists": {"codelist": [{"codelist-items": {"codelist-item": items}}]}}))
    assert {tuple(r) for r in metadata.read_codelist(spark, path).collect()} == {("1", "AUZ"), ("2", "BEL")}
    empty = write(tmp_path / "e.json", json.dumps({"codelists": {"codelist": []}}))
    with pytest.raises(ValueError):
        metadata.read_codelist(spark, empty)


def test_mapping(spark, tmp_path):
    path = write(tmp_path / "m.json", json.dumps({"10": "A", "2": "B", "(.*)": "\\1"}))
    assert [tuple(r) for r in metadata.read_mapping(spark, path).orderBy("ord").collect()] == [(10, "A", 0), (2, "B", 1)]
    assert metadata.read_mapping(spark, path, keys_as_int=False).count() == 3


def test_structure(spark, tmp_path):
    prefixed = write(tmp_path / "a.xml", '<m:S xmlns:m="u:m"><m:Dataflow id="x" version="2.3"/>' + "<m:Dimension/>" * 7 + "<m:TimeDimension/></m:S>")
    assert metadata.read_structure(spark, prefixed) == {"version": "2.3", "dimensions": 7}
    with pytest.raises(ValueError):
        metadata.read_structure(spark, write(tmp_path / "b.xml", "<a/>"))


def test_error_payloads(spark):
    rows = [("Could not find Dataflow x, y",), ("short",), ('"short"',), ("a,b",), ("x\ny",), ("w" * 60,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(metadata.is_error_payload(F.col("t"))).collect()]
    assert got == [True, True, False, False, False, False]


def test_archives(spark, tmp_path):
    for name, a in (("x", [1, 2]), ("y", [3])):
        pq.write_table(pa.table({"a": a, "b": ["q"] * len(a)}), tmp_path / "m.parquet")
        (tmp_path / "z").mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / f"z/{name}.zip", "w") as z:
            z.write(tmp_path / "m.parquet", "Test Data.parquet")
            z.writestr("t.csv", "c1,c2\n1,2\n")
    path = str(tmp_path / "z")
    assert sorted(r.a for r in metadata.read_parquet_archives(spark, path).collect()) == [1, 2, 3]
    assert metadata.read_text_archives(spark, path).filter("at = 0 and line = 'c1,c2'").count() == 2
    (tmp_path / "z/bad.zip").write_bytes(bytes(range(256)) * 4)
    audit = {r.path.rpartition("/")[2]: (r.ok, r.reason) for r in metadata.audit_archives(spark, path).collect()}
    assert audit["x.zip"] == (True, None) and not audit["bad.zip"][0] and "zip" in audit["bad.zip"][1]


def test_results_are_kept(spark, tmp_path):
    made = []
    build = lambda: made.append(1) or spark.range(3)
    for _ in range(2):
        assert sinks.materialize(spark, build, str(tmp_path), a=1, b=[2]).count() == 3
    assert made == [1]
    assert sinks.result_key(a=1, b=2) == sinks.result_key(b=2, a=1) != sinks.result_key(a=1, b=3)
    assert sinks.clear(spark, str(tmp_path), a=1, b=[2])
    sinks.materialize(spark, build, str(tmp_path), a=1, b=[2])
    assert made == [1, 1]


def test_stream_equals_batch(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.range(100).selectExpr("id", "id % 3 AS g").write.parquet(src)
    schema = spark.read.parquet(src).schema
    keep = lambda df: df.filter("g = 1")
    append_increments(read_increments(spark, src, schema, 1), keep, out, cp)
    spark.range(100, 110).selectExpr("id", "id % 3 AS g").write.mode("append").parquet(src)
    append_increments(read_increments(spark, src, schema, 1), keep, out, cp)
    assert sorted(spark.read.parquet(out).collect()) == sorted(keep(spark.read.parquet(src)).collect())
    with pytest.raises(ValueError):
        read_increments(spark, "x.csv", schema)


def test_addresses(spark):
    a = "https://h/rest/data/OECD.DCD.FSD,DSD_A@DF_A,1.8/all"
    b = "https://h/v2/OECD.DCD.FSD/DSD_B@DF_B/2.0/*"
    row = lambda u: spark.createDataFrame([(u,)], "u string").select(urls.dataflow_id(F.col("u")), urls.dataflow_version(F.col("u")), urls.with_version(F.col("u"), "3.1")).first()
    assert tuple(row(a)) == ("DSD_A@DF_A", "1.8", a.replace("1.8", "3.1"))
    assert tuple(row(b)) == ("DSD_B@DF_B", "2.0", b.replace("2.0", "3.1"))
    assert tuple(row("https://h/x"))[:2] == (None, None)
    assert tuple(row("https://h/d/OTHER.AG,DF_X,1.3/all")) == (None, "1.3", "https://h/d/OTHER.AG,DF_X,3.1/all")
    assert tuple(row("https://h/d/OTHER.AG/DF_X/1.3/all")) == (None, "1.3", "https://h/d/OTHER.AG/DF_X/3.1/all")
    for whole in ("https://h/OECD.DCD.FSD/DSD_A@DF_A/1.3.1/all", "https://h/OECD.DCD.FSD,DSD_A@DF_A,1.3"):
        assert tuple(row(whole)) == ("DSD_A@DF_A", None, whole)


def test_empty_and_differing_headers(spark, tmp_path):
    write(tmp_path / "e/a.csv", "a,,c\n1,2,3\n")
    df, names = readers.read_observations(spark, str(tmp_path / "e"))
    assert df.columns == ["a", "_c1", "c"] and tuple(df.first()) == ("1", "2", "3")
    write(tmp_path / "h/1.csv", "DONOR,SECTOR\nUSA,1\n")
    write(tmp_path / "h/2.csv", "SECTOR,DONOR,MORE\n2,FRA,x\n")
    write(tmp_path / "h/3.csv", "SECTOR,DONOR,MORE\n3,DEU,y\n")
    write(tmp_path / "h/_SUCCESS", "")
    df, names = readers.read_observations(spark, str(tmp_path / "h"))
    assert {tuple(r) for r in df.select("DONOR", "SECTOR", "MORE").collect()} == {("USA", "1", None), ("FRA", "2", "x"), ("DEU", "3", "y")}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2  # a scan a header


def test_line_ends_in_values(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n1,"two\nlines"\n')
    df, _ = readers.read_observations(spark, path, multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", "two\nlines")]


def test_text_is_split(spark, tmp_path):
    path = write(tmp_path / "s.csv", "a,b\n" + "".join(f"{k},{'x' * 90}\n" for k in range(20_000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        df, _ = readers.read_observations(spark, path)
        assert df.rdd.getNumPartitions() > 3 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_types_of_members(spark, tmp_path):
    write(tmp_path / "t/a.csv", "n,x,f,b,e\n1,NA,1.5,True,\nNA,2,2,False,\n")
    write(tmp_path / "t/b.txt", "n|f\n3|z\n")
    df = readers.read_bulk(spark, str(tmp_path / "t"))
    assert dict(df.dtypes) == {"n": "bigint", "x": "bigint", "f": "string", "b": "boolean", "e": "string"}
    assert {(r.n, r.x, r.f) for r in df.collect()} == {(1, None, "1.5"), (None, 2, "2.0"), (3, None, "z")}


def test_archives_land(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for name, data in (("x", {"a": [1, 2], "b": ["q", "r"]}), ("y", {"a": ["t"], "c": [2.5]})):
        pq.write_table(pa.table(data), tmp_path / "m.parquet")
        with zipfile.ZipFile(tmp_path / f"p/{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.write(tmp_path / "m.parquet", "data/Test.parquet")
    df = readers.read_bulk(spark, metadata.land_archives(spark, str(tmp_path / "p"), str(tmp_path / "out")))
    assert {(r.a, r.b, r.c) for r in df.collect()} == {("1", "q", None), ("2", "r", None), ("t", None, 2.5)}
    (tmp_path / "q").mkdir()
    with zipfile.ZipFile(tmp_path / "q/Some Set.zip", "w") as z:
        z.writestr("Part A.txt", "k|v\n" + "".join(f"{k}|w{k}\n" for k in range(120_000)))
        z.writestr("b.csv", "k,u\n7,8\n")
    path = metadata.land_archives(spark, str(tmp_path / "q"), str(tmp_path / "out"))
    df = readers.read_bulk(spark, path)
    assert df.filter("v = concat('w', k)").count() == 120_000 and [r.u for r in df.filter("u is not null").collect()] == [8]


def test_payload_white_space(spark):
    rows = [("\u2003\t" + "w" * 49 + "\x1f\xa0",), (" " * 60 + "short",), ('\x0b"quoted"',)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(metadata.is_error_payload(F.col("t"))).collect()]
    assert got == [True, True, False]


def test_kept_results(spark, tmp_path):
    made = []
    build = lambda: made.append(1) or spark.range(5)
    store = sinks.Kept(spark, str(tmp_path / "kept"))
    assert store.get(build, a=1).count() == store.get(build, a=1).count() == 5 and len(made) == 1
    entry = tmp_path / "kept" / sinks.result_key(a=1)
    folder = lambda: entry / json.loads((entry / sinks.POINTER).read_text())["attempt"]
    for f in folder().glob("part-*"):
        f.write_bytes(b"not parquet")
    for f in folder().glob(".*.crc"):
        f.unlink()
    assert store.get(build, a=1).count() == 5 and len(made) == 2  # a file that can't be read
    (folder() / "_SUCCESS").unlink()
    assert store.get(build, a=1).count() == 5 and len(made) == 3  # a write that didn't end
    stats = store.stats()
    assert (stats["entries"], stats["hits"], stats["misses"]) == (1, 1, 3) and stats["bytes"] > 0
    store.disable()
    store.get(build, a=1)
    store.enable()
    assert len(made) == 4 and store.clear() and store.stats()["entries"] == 0


def test_lake_splits_a_large_year(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "50000")
    try:
        sinks.write_lake(spark.range(200_000).selectExpr("id", "if(id < 10, 2001, 2000) as year", "uuid() as u").repartition(8), str(tmp_path / "lake"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "lake/year=2000").glob("part-*"))) > 1
    assert len(list((tmp_path / "lake/year=2001").glob("part-*"))) == 1


def test_corrections_over_the_area_list(spark, tmp_path):
    write(tmp_path / "codelists/dac1_codes_area.json", json.dumps({"1": "AUT", "918": "old", "20004": "DACEUEC", "20918": "4EU001", "(.*)": "\\1"}))
    areas = metadata.area_codes(spark, str(tmp_path), "dac1")
    got = {r.code: r.value for r in areas.collect()}
    # the values that corrections fix
    assert got[1] == "AUT" and got[918] == "4EU001" and got[20004] == "DACEU_EC" and got[10280] == "F5_X"
    from tallyspark.operators import codes

    inverse = {r.value: r.code for r in codes.invert(areas).collect()}
    assert inverse["4EU001"] == 20918 and "DACEUEC" not in inverse and inverse["AUT"] == 1


def test_request_addresses(spark):
    url = lambda **k: spark.range(1).select(urls.request_url(F.lit(k.pop("flow", "DF_DAC1")), **k)).first()[0]
    assert url() == "https://sdmx.oecd.org/public/rest/data/OECD.DCD.FSD,DF_DAC1,/all?format=csvfilewithlabels"
    assert url(version=F.lit("1.0"), key=F.lit("1..2010..1140.."), start=2020, end=2023).endswith("DF_DAC1,1.0/1..2010..1140..?format=csvfilewithlabels&startPeriod=2020&endPeriod=2023")
    assert url(api_version=2, start=2020, end=2023) == "https://sdmx.oecd.org/public/rest/v2/data/dataflow/OECD.DCD.FSD/DF_DAC1/+/*?format=csvfilewithlabels&c[TIME_PERIOD]=ge:2020+le:2023"
    assert url(api_version=2, end=2023, last=5).endswith("?format=csvfilewithlabels&c[TIME_PERIOD]=ge:1950+le:2023&lastNObservations=5")
    assert url(api_version=2, start=2020, file_format="jsondata").endswith("?format=jsondata&c[TIME_PERIOD]=ge:2020")
    assert url(flow="DSD_CRS@DF_CRS", version=F.lit("1.0"), start=0).startswith("https://sdmx.oecd.org/dcd-public/rest/data/OECD.DCD.FSD,DSD_CRS@DF_CRS,1.0/all?format=csvfilewithlabels")
    ends = spark.createDataFrame([("https://h/OECD.DCD.FSD/DSD_A@DF_A/",), ("https://h/OECD.DCD.FSD/DSD_A@DF_A",), ("https://h/OECD.DCD.FSD/A/1.0/all",), ("https://h/OECD.DCD.FSD",)], "u string")
    assert [r[0] for r in ends.select(urls.flow_id(F.col("u"))).collect()] == ["DSD_A@DF_A", "DSD_A@DF_A", None, None]


def test_kept_results_are_replaced_and_go(spark, tmp_path):
    import time

    root = tmp_path / "kept"
    store = sinks.Kept(spark, str(root), max_age=1)
    first = store.get(lambda: spark.range(5), a=1)
    (root / "notes").mkdir()
    (root / "notes/mine.txt").write_text("x")
    time.sleep(1.1)
    second = store.get(lambda: spark.range(7), a=1)  # past its age
    assert first.count() == 5 and second.count() == 7 and store.misses == 2  # a reader of the old one keeps it
    inner = lambda: sinks.Kept(spark, str(root)).get(lambda: spark.range(9), b=1).select("id")
    assert sinks.Kept(spark, str(root), max_age=0).get(inner, b=1).count() == 9  # another writer of the key, meanwhile
    assert sinks.Kept(spark, str(root)).get(lambda: spark.range(1), b=1).count() == 9
    size = store.stats()["bytes"] // 2
    small = sinks.Kept(spark, str(root), max_bytes=size + 1)
    small.get(lambda: spark.range(3), a=1)  # used now, so b goes first
    small.get(lambda: spark.range(3), c=1)
    assert not (root / sinks.result_key(b=1)).exists() and (root / sinks.result_key(c=1)).exists()
    assert store.clear() and (root / "notes/mine.txt").exists() and store.stats()["entries"] == 0


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("x", "y"):
            sinks.write_bucketed(spark.range(1000).selectExpr("id % 50 as k", f"id as {name}"), f"bucketed_{name}", str(tmp_path / name), ["k"], 4)
        joined = spark.table("bucketed_x").groupBy("k").agg(F.sum("x").alias("x")).join(spark.table("bucketed_y"), "k")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("x", "y"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


def test_text_members_are_no_stream(spark, tmp_path):
    write(tmp_path / "t/a.csv", "a\n1\n")
    with pytest.raises(ValueError, match="a.csv"):
        read_increments(spark, str(tmp_path / "t"), spark.range(1).schema)


def test_repeated_rows_across_batches(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "unit_measure_code string, unit_measure_name string, amounttype_code string, amount_type string, v int"
    rows = [("USD", "d", "V", "p", 1), ("USD", "d", "V", "p", 1), ("XDC", "n", "V", "p", 2), (None, "n", "V", "p", 3), ("USD", None, None, "p", 4), ("USD", None, "p", None, 4)]
    for k in range(3):
        spark.createDataFrame(rows[: 2 * k + 2], schema).coalesce(1).write.mode("append").parquet(src)
        stream = read_increments(spark, src, spark.read.parquet(src).schema, 1)
        append_increments(stream, lambda df: drop_repeated(codes.folded_units(df)), out, cp)  # another run each time
        assert sorted(map(tuple, spark.read.parquet(out).collect()), key=repr) == sorted(map(tuple, codes.unit_to_amount_type(spark.read.parquet(src)).collect()), key=repr)


def test_last_rows_as_state(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "s string, TIME_PERIOD int, v double"
    batches = [[("a", 2001, 1.0), ("a", 2003, 2.0), ("b", None, 3.0), ("a", 2002, 4.0)], [("a", 1999, 5.0), (None, 2000, 6.0)], [("a", 2002, 0.5), ("b", 2010, 7.0), ("a", 2009, None)]]
    for rows in batches:  # late years too
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        kept = spark.read.parquet(src)
        keep_last(read_increments(spark, src, kept.schema, 1), ["s"], 2, out, cp, ties=["v"])
        got = read_last(spark, out, ["s"], kept.schema).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, codes.last_observations(kept, ["s"], 2, ties=["v"]).collect()), key=repr)


def test_casts_are_tried_on_texts_that_look_like_the_type_alone(spark):
    from tallyspark.operators.projections import isnt

    texts = ["1", " 1 ", "+1", "-01", "1.5", "1.", "-.5", "1e10", "1d", "0x1p3", "inf", "-Infinity", "nan", "NATION_6", "1-URGENT", "TRUE", "yes ", "n", "", " ", "9223372036854775808", "300", "1\x7f", "x", None]
    df = spark.createDataFrame([(x,) for x in texts], "v string")
    for kind in ("bigint", "int", "smallint", "tinyint", "double", "boolean"):
        plain = F.col("v").isNotNull() & F.col("v").try_cast(kind).isNull()
        assert df.filter(plain != isnt(F.col("v"), kind)).collect() == []
        # a text cast that fails costs an exception, so none is tried without a look at the text
        plan = df.agg(F.count_if(isnt(F.col("v"), kind)))._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" in plan.upper()
    typed = readers.with_inferred_types(df.select("v", F.when(F.col("v").isNotNull(), "7").alias("n")))
    assert dict(typed.dtypes) == {"v": "string", "n": "bigint"}
