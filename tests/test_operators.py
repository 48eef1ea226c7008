import pytest
from pyspark.sql import functions as F

from tallyspark.operators import codes, filters, projections
from tallyspark.plans import datasets
from tallyspark.sources.specs import SPECS, spec_of, struct_of


def test_specs():
    kept = {k: sum(f.keep for f in v) for k, v in SPECS.items()}
    assert kept == {"dac1": 16, "dac2a": 16, "multisystem": 21, "crs": 60, "cpa": 60, "aiddata": 118}
    assert sum(f.flag for f in SPECS["aiddata"]) == 41 and len(struct_of("crs")) == 59
    with pytest.raises(ValueError):
        spec_of("nothing")


@pytest.mark.parametrize(
    ("dataset", "wanted", "key"),
    [
        ("dac1", {"donor": "1", "measure": 2010, "unit_measure": None, "flow_type": 1140}, "1..2010..1140.."),
        ("dac1", {"donor": "1", "sector": "_Z", "measure": "2010", "flow_type": "1140", "unit_measure": "USD", "price_base": "V"}, "1._Z.2010..1140.USD.V"),
        ("dac1", {}, "......"),
        ("dac2a", {"donor": ["FRA", "USA"], "recipient": "503", "measure": "1010"}, "FRA+USA.503.1010.."),
        ("crs", {"donor": "1", "recipient": "503", "sector": "100", "measure": "1010", "channel": "1", "modality": "M01", "flow_type": "1140", "price_base": "V", "unit_measure": "USD"}, "1.503.100.1010.1.M01.1140.V.DD..USD"),
        ("crs", {"microdata": False}, "........_T.."),
        ("multisystem", {"donor": 4}, "4......._T.."),
    ],
)
def test_keys(dataset, wanted, key):
    assert filters.build_key(dataset, wanted) == key


def test_filters(spark):
    rows = [("FRA", "_Z", "V"), ("USA", "1", "Q"), ("DEU", "_T", "V"), (None, "1", "V")]
    df = spark.createDataFrame(rows, "DONOR string, SECTOR string, PRICE_BASE string")
    at = lambda p: sorted(r.DONOR or "" for r in df.filter(p).collect())
    assert at(filters.dimension_predicate("dac1", {"sector": "_Z"})) == ["FRA"]
    assert at(filters.key_predicate("dac1", "FRA+DEU......V")) == ["DEU", "FRA"]
    assert at(filters.key_predicate("dac1", "all")) == ["", "DEU", "FRA", "USA"]
    with pytest.raises(ValueError):
        filters.key_predicate("dac1", "FRA.")
    with pytest.raises(TypeError, match="colour"):
        filters.dimension_predicate("dac1", {"colour": 1})
    with pytest.raises(TypeError):
        filters.dimension_predicate("multisystem", {"microdata": True})


def test_years(spark):
    df = spark.createDataFrame([(2000,), (2002,), (None,)], "y int")
    assert filters.filter_years(df, None, None, "y").count() == 3
    assert [r.y for r in filters.filter_years(df, 2000, None, "y").orderBy("y").collect()] == [2000, 2002]
    with pytest.raises(ValueError, match="2000, 2002"):
        filters.filter_years(df, 2001, None, "y")


def test_guard():
    with pytest.warns(UserWarning, match="channel, modality"):
        assert filters.guard_totals("crs", {"microdata": False})
    assert filters.guard_totals("crs", {}) is None
    assert filters.guard_totals("crs", {"microdata": False, "channel": "_T", "modality": "_T"}) is None
    with pytest.warns(UserWarning, match="sector"):
        filters.guard_totals("multisystem", {"recipient": "KEN"})


def test_inversion_takes_the_last(spark):
    rows = [(918, "4EU001", 0), (20918, "4EU001", 5), (1, "AUT", 1), (9, None, 2)]
    areas = spark.createDataFrame(rows, "code int, value string, ord long")
    got = {r.value: r.code for r in codes.invert(areas).collect()}
    assert got["4EU001"] == 20918 and got["AUT"] == 1
    assert {r.value: r.code for r in codes.invert(areas, {"4EU001": 918}).collect()}["4EU001"] == 918
    df = spark.createDataFrame([("AUT", 1.0), ("4EU001", 2.0), ("nobody", 3.0), (None, 4.0)], "donor_code string, v double")
    out = codes.map_area_codes(df, areas)
    assert out.columns == ["donor_code", "v"] and dict(out.dtypes)["donor_code"] == "int"
    assert {r.v: r.donor_code for r in out.collect()} == {1.0: 1, 2.0: 20918, 3.0: None, 4.0: None}


def test_overlay_keeps_places(spark):
    base = spark.createDataFrame([(1, "A", 0), (2, "B", 1)], "code int, value string, ord long")
    top = spark.createDataFrame([(9, "N", 0), (1, "Z", 1)], "code int, value string, ord long")
    assert [(r.code, r.value) for r in codes.overlay(base, top).orderBy("ord").collect()] == [(1, "Z"), (2, "B"), (9, "N")]


def test_unit_fold(spark):
    rows = [("USD", "dollar", "V", "cur", 1), ("USD", "dollar", "V", "cur", 1), ("XDC", "national", "V", "cur", 2), (None, None, "V", "cur", 3)]
    df = spark.createDataFrame(rows, "unit_measure_code string, unit_measure_name string, amounttype_code string, amount_type string, value int")
    assert sorted(tuple(r) for r in codes.unit_to_amount_type(df).collect()) == [("V", "cur", 1), ("XDC", "national", 2)]


def test_drift(spark):
    old = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "code int, value string")
    new = spark.createDataFrame([(2, "B"), (3, "X"), (4, "D")], "code int, value string")
    assert {r.code: r.status for r in codes.drift(old, new).collect()} == {1: "historical", 2: "same", 3: "changed", 4: "added"}
    assert codes.has_drift(old, new) and not codes.has_drift(old, old)
    assert codes.column_drift(old, ["code", "name"]) == {"missing": ["name"], "unexpected": ["value"]}
    with pytest.raises(ValueError, match="breaking"):
        codes.check_dimensions(6, "dac1")


def test_flags_casts_and_empty_columns(spark):
    df = spark.createDataFrame([("Yes", None), ("No", None), ("maybe", None), (None, None)], "f string, e string")
    assert [r[0] for r in df.select(projections.yes_no(F.col("f"))).collect()] == [1, 0, None, None]
    assert projections.drop_empty_columns(df).columns == ["f"]
    assert projections.drop_empty_columns(df.limit(0)).columns == []
    with pytest.raises(KeyError):
        projections.preprocess(df, "aiddata")


def test_fallback(spark):
    good = spark.createDataFrame([("_T", "5"), ("1", "6")], "CHANNEL string, SECTOR string")
    types = projections.fallback_types(good, "crs")
    assert types["CHANNEL"] == "string" and types["SECTOR"] == "int"
    with pytest.raises(ValueError, match="SECTOR"):
        projections.fallback_types(spark.createDataFrame([("1", "x")], "CHANNEL string, SECTOR string"), "crs")


def test_totals_keep_null_groups_apart(spark):
    df = spark.createDataFrame([("a", None, "x", 1), ("a", "c", "x", 2)], "d string, c string, m string, v int")
    got = {(r.c, r.m): r.value for r in codes.with_totals(df, ["d"], ["c", "m"], "v").collect()}
    assert got == {("_T", "_T"): 3, (None, "_T"): 1, ("c", "_T"): 2, ("_T", "x"): 3, (None, "x"): 1, ("c", "x"): 2}


def test_read_dataset(spark, tmp_path):
    folder = tmp_path / "dac1/1.10"
    folder.mkdir(parents=True)
    (tmp_path / "dac1/1.9").mkdir()
    (folder / "a.csv").write_text("DONOR,Donor,MEASURE,UNIT_MEASURE,Unit of measure,PRICE_BASE,Price base,TIME_PERIOD,OBS_VALUE\nFRA,France,2010,USD,Dollar,V,Current,2020,1.5\nFRA,France,2010,XDC,National,V,Current,2020,3\nUSA,States,2010,USD,Dollar,Q,Constant,2021,9\n")
    areas = spark.createDataFrame([(4, "FRA", 0), (302, "USA", 1)], "code int, value string, ord long")
    out = datasets.read_dac1(spark, str(tmp_path), 2020, 2020, {"donor": ["FRA"]}, areas=areas)
    assert out.columns == ["donor_code", "donor_name", "aidtype_code", "amounttype_code", "amount_type", "year", "value"]
    assert sorted(tuple(r) for r in out.collect()) == [(4, "France", 2010, "A", "Current", 2020, 1.5), (4, "France", 2010, "N", "National", 2020, 3.0)]
    with pytest.raises(ValueError):
        datasets.read_dac1(spark, str(tmp_path), pre_process=False, areas=areas)
    assert datasets.read_dac1(spark, str(tmp_path), pre_process=False, dotstat_codes=False).count() == 3


def test_read_aiddata(spark, tmp_path):
    flags = [f.raw for f in SPECS["aiddata"] if f.flag]
    header = ["AidData Record ID", "Commitment Year", "Commitment Date (MM/DD/YYYY)", *flags, "Title"]
    lines = [",".join(f'"{h}"' for h in header), ",".join(["7", "2001", "03/15/2001", *["Yes"] * len(flags), ""])]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    row = datasets.read_aiddata(spark, str(tmp_path / "p.csv"), 2001, 2001).first()
    assert row.aiddata_id == "7" and row.commitment_year == 2001 and str(row.commitment_date) == "2001-03-15" and row.covid == 1 and "project_title" not in row


def test_periods_that_are_text(spark):
    df = spark.createDataFrame([("2019",), ("_Z",), (None,), ("2021",)], "TIME_PERIOD string")
    assert [r[0] for r in df.filter(filters.year_range(2020, None)).collect()] == ["2021"]
    assert filters.filter_years(df, 2019, None, "TIME_PERIOD").count() == 2


def test_filter_kinds():
    kinds = datasets.available_filters("crs")
    assert kinds["microdata"] == "bool" and "md_dim" not in kinds and set(datasets.available_filters("dac2a")) == {"donor", "recipient", "measure", "unit_measure", "price_base"}
    with pytest.raises(ValueError):
        datasets.available_filters("nothing")


def cube(tmp_path, name="crs/1.6", values="1.5"):
    folder = tmp_path / name
    folder.mkdir(parents=True)
    head = "DONOR,Donor,RECIPIENT,CHANNEL,PRICE_BASE,MD_DIM,TIME_PERIOD,OBS_VALUE,DECIMALS,FLOW_TYPE"
    (folder / "a.csv").write_text(f"{head}\nFRA,France,KEN,_T,V,DD,2020,{values},2,_Z\nnobody,,UGA,11000,Q,DD,2021,{values},2,_Z\nFRA,France,KEN,1,V,_T,2020,9,2,_Z\n")
    (tmp_path / "codelists").mkdir(exist_ok=True)
    (tmp_path / "codelists/dac2_codes_area.json").write_text('{"4": "FRA", "248": "KEN", "(.*)": "x"}')


def test_landed_codelist_is_the_default(spark, tmp_path):
    cube(tmp_path)
    out = datasets.read_crs(spark, str(tmp_path), 2020, 2020)
    assert [tuple(r) for r in out.select("donor_code", "donor_name", "recipient_code", "year", "value", "data_type_code").collect()] == [(4, "France", 248, 2020, 1.5, "A")]
    assert dict(out.dtypes)["donor_code"] == "int"
    assert not [c for c in out.columns if "flow" in c]  # no value, so it goes
    assert "donor_code" not in datasets.read_crs(spark, str(tmp_path), 2021).columns  # no code for that donor
    fixed = datasets.read_crs(spark, str(tmp_path), 2021, fixed=True)
    assert "donor_code" in fixed.columns and fixed.first().donor_code is None
    raw = datasets.read_crs(spark, str(tmp_path), pre_process=False, dotstat_codes=False)
    assert dict(raw.dtypes)["DECIMALS"] == "int" and dict(raw.dtypes)["CHANNEL"] == "string" and raw.count() == 2
    with pytest.raises(FileNotFoundError):
        datasets.read_crs(spark, str(tmp_path), dataflow_version="9.9")


def test_one_pass_before_the_result(spark, tmp_path):
    cube(tmp_path)
    raw, names = datasets.read_observations(spark, str(tmp_path / "crs/1.6"))
    areas = spark.createDataFrame([(4, "FRA", 0)], "code int, value string, ord long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("probe", "")
    datasets.conform(raw, "crs", names=names, areas=areas, fixed=True)
    least = len(tracker.getJobIdsForGroup("probe"))
    spark.sparkContext.setJobGroup("both", "")
    datasets.conform(raw, "crs", names=names, areas=areas)
    ran = len(tracker.getJobIdsForGroup("both"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert ran - least <= 4  # stages of one aggregate and the join in it


def test_tables_landed_by_year(spark, tmp_path):
    cube(tmp_path)
    cube(tmp_path, "crs_greq/1.6", "7.5")
    before = sorted(map(tuple, datasets.read_crs(spark, str(tmp_path), 2021, 2021, as_grant_equivalent=True, fixed=True).collect()))
    datasets.land_dataset(spark, str(tmp_path), "crs_greq")
    out = datasets.read_crs(spark, str(tmp_path), 2021, 2021, as_grant_equivalent=True, fixed=True)
    assert sorted(map(tuple, out.collect())) == before and before[0][out.columns.index("value")] == 7.5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year_folder" in plan


def test_codes_are_ranked_without_one_task(spark):
    rows = [("12",), ("3",), ("abc",), ("2000001",), ("(.*)",), ("ab",), ("0003",), ("1000000",), ("z",)]
    got = {r.code: r.place for r in codes.ranked_codes(spark.createDataFrame(rows, "code string")).collect()}
    assert sorted(got, key=got.get) == ["0003", "3", "12", "1000000", "2000001", "ab", "abc", "z", "(.*)"] and sorted(got.values()) == list(range(1, 10))


def test_catalogue_with_labels(spark):
    df = spark.createDataFrame([("a", "Alpha", 1), ("a", "Alpha", 2), ("b", None, None)], "c string, l string, d int")
    got = {(r.dimension, r.code): (r.label, r.n) for r in codes.dimension_catalogue(df, ["c", "d"], {"c": "l"}).collect()}
    assert got == {("c", "a"): ("Alpha", 2), ("c", "b"): (None, 1), ("d", "1"): (None, 1), ("d", "2"): (None, 1)}


def test_project_table_is_saved(spark, tmp_path):
    flags = [f.raw for f in SPECS["aiddata"] if f.flag]
    header = ["AidData Record ID", "Commitment Year", *flags]
    (tmp_path / "p.csv").write_text(",".join(f'"{h}"' for h in header) + "\n7,2001," + ",".join(["No"] * len(flags)) + "\n")
    df = datasets.read_aiddata(spark, str(tmp_path / "p.csv"), save_to_path=str(tmp_path / "saved"))
    assert spark.read.parquet(str(tmp_path / "saved")).collect() == df.collect()


def test_totals_of_four_dimensions(spark):
    import itertools
    import random

    rnd = random.Random(2)
    rows = [(rnd.choice("xy"), rnd.choice(["1", "2", None]), rnd.choice("ab"), rnd.choice("cd"), rnd.choice("ef"), rnd.randrange(9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "d string, c string, m string, r string, s string, v int")
    out = codes.with_totals(df, ["d"], ["c", "m", "r", "s"], "v")
    want = {}
    for d, *keys, v in rows:
        for kept in itertools.product((0, 1), repeat=4):
            key = (d, *[(0, k) if on else "_T" for on, k in zip(kept, keys, strict=True)])
            want[key] = want.get(key, 0) + v
    got = {tuple(r)[:5]: r.value for r in out.collect()}
    assert got == {tuple(x[1] if isinstance(x, tuple) else x for x in k): v for k, v in want.items()} and out.count() == len(want)
    late = spark.createDataFrame([("x", "9", "a", "c", "e", 5)], df.schema)
    merged = codes.merged_totals([out, codes.with_totals(late, ["d"], ["c", "m", "r", "s"], "v")], ["d"], ["c", "m", "r", "s"])
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(map(tuple, codes.with_totals(df.union(late), ["d"], ["c", "m", "r", "s"], "v").collect()), key=repr)


def test_double_counts_in_one_pass(spark):
    rows = [("x", "_T", "_T", 1), ("x", "1", "_T", 2), ("x", "1", "a", 3), ("x", None, "a", 4), ("y", "_T", "a", 5), ("y", "_T", "a", 6), ("y", "2", "a", 7)]
    df = spark.createDataFrame(rows, "d string, c string, m string, v int")
    got = {tuple(r) for r in filters.double_count_report(df, ["d", "c", "m"], ["c", "m"]).collect()}
    assert got == {("c", 2, 3, 2), ("m", 1, 1, 1)}
    plan = filters.double_count_report(df, ["d", "c", "m"], ["c", "m"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2  # the rows are read once
    assert {tuple(r) for r in filters.double_count_report(df.limit(0), ["d", "c", "m"], ["c"]).collect()} == {("c", 0, 0, 0)}


def test_years_from_metadata(spark):
    df = spark.createDataFrame([(2000,), (2001,)], "y int")
    assert filters.filter_years(df, 2001, None, "y", years=[2000, 2001]).count() == 1
    with pytest.raises(ValueError, match="2000, 2001"):
        filters.filter_years(df, 2005, None, "y", years=[2000, 2001])
