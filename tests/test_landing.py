"""Landed tables: what their log takes in, what their statistics save, and rows that aren't whole."""

import json

import pytest
from pyspark.sql import functions as F

from tallyspark.plans import datasets
from tallyspark.sources import landing, readers

HEADER = "DONOR,Donor,RECIPIENT,SECTOR,MEASURE,CHANNEL,MODALITY,FLOW_TYPE,PRICE_BASE,MD_DIM,MD_ID,UNIT_MEASURE,TIME_PERIOD,OBS_VALUE,REGION,GENDER_EQUALITY"


def row(donor="FRA", recipient="AUT", sector=1, channel="3", year=2020, value=1.5, md="DD", region="", gender="1"):
    return f'{donor},"{donor}, the",{recipient},{sector},100,{channel},A,D,V,{md},1,USD,{year},{value},{region},{gender}'


@pytest.fixture
def root(tmp_path):
    write(tmp_path, "crs/1.6/a.csv", [row(), row("USA", year=2021)])
    (tmp_path / "codelists").mkdir()
    (tmp_path / "codelists/dac2_codes_area.json").write_text(json.dumps({"4": "FRA", "302": "USA", "1": "AUT", "5": "DEU"}))
    return tmp_path


def write(root, name, rows, header=HEADER):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    return path


def read(spark, root, *years, **options):
    return datasets.read_crs(spark, str(root), *years, **options)


def donors(df):
    return sorted((r.donor_code, r.year, r.value) for r in df.collect())


def landed(spark, root):
    return landing.Landed(spark, "crs", f"{root}/crs/1.6", f"{root}/landed/crs/1.6")


def jobs_of(spark, work):
    """How many jobs work() starts."""
    sc, group = spark.sparkContext, f"counted-{id(work)}"
    sc.setJobGroup(group, "counted")
    try:
        result = work()
        return result, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc._jsc.clearJobGroup()


def test_added_changed_and_removed_files_show(spark, root):
    datasets.land_dataset(spark, str(root), "crs")
    first = landed(spark, root).version()
    assert first.number == 1 and len(first.attempts) == 1
    assert donors(read(spark, root)) == [(4, 2020, 1.5), (302, 2021, 1.5)]
    write(root, "crs/1.6/b c+d.csv", [row("DEU", year=2022, value=7)])
    assert donors(read(spark, root)) == [(4, 2020, 1.5), (5, 2022, 7.0), (302, 2021, 1.5)]
    second = landed(spark, root).version()
    assert second.attempts[0] == first.attempts[0] and len(second.attempts) == 2  # what had landed wasn't read again
    write(root, "crs/1.6/b c+d.csv", [row("DEU", year=2022, value=8.25), row("DEU", year=2019, value=9)])
    assert donors(read(spark, root)) == [(4, 2020, 1.5), (5, 2019, 9.0), (5, 2022, 8.25), (302, 2021, 1.5)]
    assert landed(spark, root).version().attempts[0] == first.attempts[0]
    (root / "crs/1.6/a.csv").unlink()
    assert donors(read(spark, root)) == [(5, 2019, 9.0), (5, 2022, 8.25)]
    assert datasets.landed_years(spark, str(root), "crs") == [2019, 2022]
    table = landed(spark, root)
    gone = table.vacuum(1)
    assert gone == 3 and donors(read(spark, root)) == [(5, 2019, 9.0), (5, 2022, 8.25)]
    (root / "crs/1.6/b c+d.csv").unlink()
    assert table.land().attempts == [] and table.land().years() == []
    for rows in ([], None, [row()]):  # a file of a header alone comes, goes, and comes with a row
        (root / "crs/1.6/c.csv").unlink() if rows is None else write(root, "crs/1.6/c.csv", rows)
        table.vacuum(1)
        assert len(table.land().attempts) == bool(rows)


def test_a_landing_that_breaks_leaves_the_version_before(spark, root, monkeypatch):
    datasets.land_dataset(spark, str(root), "crs")
    write(root, "crs/1.6/b.csv", [row("DEU", year=2022, value=7)])
    with monkeypatch.context() as m:
        m.setattr(landing.Landed, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))  # after the write
        with pytest.raises(RuntimeError, match="lost"):
            landed(spark, root).land()
    table = landed(spark, root)
    df, names = table.read(table.version())
    assert table.version().number == 1 and df.count() == 2 and names["DONOR"] == "DONOR"
    assert donors(read(spark, root)) == [(4, 2020, 1.5), (5, 2022, 7.0), (302, 2021, 1.5)]
    assert landed(spark, root).vacuum(2) == 1  # what the broken one wrote


def test_of_two_landings_one_commits_and_the_other_begins_anew(spark, root, monkeypatch):
    datasets.land_dataset(spark, str(root), "crs")
    write(root, "crs/1.6/b.csv", [row("DEU", year=2022, value=7)])
    commit, tries = landing.Landed._commit, []

    def slow(self, version, files):
        tries.append(version.number)
        if len(tries) == 1:
            landed(spark, root).land()  # another one, meanwhile
        return commit(self, version, files)

    monkeypatch.setattr(landing.Landed, "_commit", slow)
    assert landed(spark, root).land().number == 2 and tries == [2, 2]
    assert donors(read(spark, root)) == [(4, 2020, 1.5), (5, 2022, 7.0), (302, 2021, 1.5)]


def test_no_job_before_the_result(spark, root):
    write(root, "crs/1.6/b.csv", [row("DEU", channel="_T", year=2022, md="_T", region="10"), row("USA", channel="x", year=2023)])
    shown = {}
    for years in ((), (2020, 2021), (2022, 2022), (2023, 2023)):
        for options in ({}, {"filters": {"microdata": False}}, {"filters": {"donor": "USA"}}, {"dotstat_codes": False}, {"pre_process": False, "dotstat_codes": False}):
            with pytest.warns(UserWarning) if "microdata" in str(options) else nothing():
                df = read(spark, root, *years, **options)
            shown[years, str(options)] = df.dtypes, sorted(map(tuple, df.collect()), key=repr)
    datasets.land_dataset(spark, str(root), "crs")
    for (years, said), want in shown.items():
        options = eval(said)  # noqa: S307
        with pytest.warns(UserWarning) if "microdata" in said else nothing():
            df, jobs = jobs_of(spark, lambda: read(spark, root, *years, **options))
        assert (df.dtypes, sorted(map(tuple, df.collect()), key=repr)) == want, (years, said)
        assert jobs == 0 or "donor" in said, (years, said)
    df, jobs = jobs_of(spark, lambda: read(spark, root, 2021, 2021, areas=spark.createDataFrame([(7, "FRA", 0), (8, "AUT", 1)], "code int, value string, ord long")))
    assert jobs > 0 and "donor_code" not in df.columns and "recipient_code" in df.columns  # USA has no code there


class nothing:
    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def test_years_are_folders(spark, root):
    datasets.land_dataset(spark, str(root), "crs")
    df = read(spark, root, 2021, 2021)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year_folder" in plan
    assert len(df.inputFiles()) >= 1 and donors(df) == [(302, 2021, 1.5)]


def test_numbers_that_are_none_raise(spark, root):
    write(root, "crs/1.6/b.csv", [row(sector="many", year=2022)])
    datasets.land_dataset(spark, str(root), "crs")
    assert len(donors(read(spark, root, 2020, 2021))) == 2
    with pytest.raises(ValueError, match="SECTOR"):
        read(spark, root, 2020, 2022)


def test_columns_that_come_later(spark, root):
    datasets.land_dataset(spark, str(root), "crs")
    write(root, "crs/1.6/b.csv", ["DEU,2022,4,5,DD"], "DONOR,TIME_PERIOD,OBS_VALUE,POLICY,MD_DIM")
    df = read(spark, root)
    assert {(r.donor_code, r.sector_code) for r in df.collect()} == {(4, 1), (302, 1), (5, None)}
    table = landed(spark, root)
    assert "POLICY" in dict(table.version().columns)


def test_many_landings_are_united(spark, root, monkeypatch):
    monkeypatch.setattr(landing, "MOST_ATTEMPTS", 3)
    for k in range(5):
        write(root, f"crs/1.6/n{k}.csv", [row("DEU", year=2022 + k, value=k)])
        datasets.land_dataset(spark, str(root), "crs")
    assert len(landed(spark, root).version().attempts) <= 3
    assert len(donors(read(spark, root))) == 7 and datasets.landed_years(spark, str(root), "crs") == [2020, 2021, *range(2022, 2027)]


def test_missing_tables_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no crs below"):
        read(spark, tmp_path)
    write(tmp_path, "crs/1.6/a.csv", [row()])
    with pytest.raises(FileNotFoundError, match="dac2_codes_area"):
        read(spark, tmp_path)
    assert read(spark, tmp_path, dotstat_codes=False).count() == 1


# rows that aren't whole


def broken(tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/lines.csv").write_text('a,b,c\n1,"two\nlines",3\n4,"a ""quoted"" word",6\n')
    (tmp_path / "s/odd.csv").write_text("a,b,c\n1,2\n1,2,3,4\n5,6,7\n\n8,,\n")
    return str(tmp_path / "s")


def test_values_with_line_ends_are_whole(spark, tmp_path):
    path = broken(tmp_path)
    df, _ = readers.read_observations(spark, path + "/lines.csv")
    assert sorted(map(tuple, df.collect())) == [("1", "two\nlines", "3"), ("4", 'a "quoted" word', "6")]


def test_rows_that_are_not_whole(spark, tmp_path):
    path = broken(tmp_path)
    df, _ = readers.read_observations(spark, path)
    with pytest.raises(Exception, match="isn't whole"):
        df.select("a").collect()
    df, _ = readers.read_observations(spark, path, aside=True)
    assert sorted(map(tuple, df.collect())) == [("1", "two\nlines", "3"), ("4", 'a "quoted" word', "6"), ("5", "6", "7"), ("8", None, None)]
    found = sorted((r.file.rpartition("/")[2], r.reason, r.record) for r in readers.broken_rows(spark, path).collect())
    assert found == [("odd.csv", "2 values of 3", "1,2"), ("odd.csv", "4 values for 3", "1,2,3,4")]
    # read line by line, the value with a line end isn't whole either, and isn't passed on
    df, _ = readers.read_observations(spark, path + "/lines.csv", multi_line=False, aside=True)
    assert [tuple(r) for r in df.collect()] == [("4", 'a "quoted" word', "6")]


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    for k in range(30):
        write(tmp_path, f"t/{k}.csv", [f"{k},1"], "a,b" if k % 3 else "a,c")
    (df, names), jobs = jobs_of(spark, lambda: readers.read_observations(spark, str(tmp_path / "t")))
    assert jobs <= 2 and df.count() == 30 and df.filter(F.col("c").isNotNull()).count() == 10


def test_landed_in_steps_joins_its_rows_once(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tallyspark.plans import queries

    written, csv = [], DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *args, **options: (written.append(self._df.inputFiles()), csv(self, *args, **options))[1])
    rows = queries.QUERIES["landed_in_steps"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) > 0 and len(written) == 6
    assert not [f for files in written for f in files if "lineitem.parquet" in f]
