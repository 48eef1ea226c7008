"""Full reads of the datasets: raw, conformed, or conformed and translated."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.codes import AREA_COLUMNS, PRICE_COLUMN, PRICES, area_inverse, map_area_codes, price_code, translate
from ..operators.filters import MICRODATA, TOTAL, dimension_predicate, filter_kinds, filter_years, guard_totals, year_range
from ..operators.projections import cast_columns, drop_empty_columns, failed_casts, fixed_types, kept_columns, nulls_from_tokens, preprocess, types_after
from ..sources.landing import YEAR_FOLDER, Landed, Version
from ..sources.metadata import area_codes, area_values
from ..sources.readers import read_observations, read_project_table
from ..sources.sinks import write_lake
from ..sources.specs import spec_of

#: Datasets whose empty columns go.
PROJECTS = ("crs", "cpa")
GRANT_EQUIVALENT = "crs_greq"


def latest_version(spark: SparkSession, root: str, dataset: str) -> str:
    """The greatest version among the folders of a dataset."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{dataset}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"no {dataset} below {root}")
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    versions = [n for n in names if all(p.isdigit() for p in n.split("."))]
    if not versions:
        raise ValueError(f"no version of {dataset} below {root}")
    return max(versions, key=lambda v: tuple(map(int, v.split("."))))


def conform(raw: DataFrame, dataset: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, names: Mapping[str, str] | None = None, areas: DataFrame | None = None, pre_process: bool = True, dotstat_codes: bool = True, overrides: dict | None = None, fixed: bool = False, known: Known | None = None) -> DataFrame:
    """Filters on raw codes, then null tokens, types, kept columns and, with dotstat_codes, legacy codes.

    areas is the codelist (code, value, ord) that legacy codes come from. One pass over the filtered rows finds columns
    that must be text and, for project tables, columns without a value, which go. What known says of the rows, which a
    landed table's statistics give, isn't looked for. With fixed there is no such pass: the columns that may be text are,
    and none goes, so the schema doesn't depend on the data.
    """
    spec_of(dataset)
    if dotstat_codes and not pre_process:
        raise ValueError("codes can only be translated in conformed tables")
    if dotstat_codes and areas is None:
        raise ValueError("translation needs the area codelist")
    wanted = raw.filter(dimension_predicate(dataset, filters)).filter(year_range(start_year, end_year))
    clean = nulls_from_tokens(wanted)
    inverse = area_inverse(areas, overrides) if dotstat_codes else None
    types, empty = (fixed_types(dataset), []) if fixed else _profile(clean, dataset, names, inverse, pre_process and dataset in PROJECTS, known)
    typed = cast_columns(clean, dataset, names, types)
    if not pre_process:
        return typed
    kept = preprocess(typed, dataset, names)
    return (translate(kept, dataset, inverse) if dotstat_codes else kept).drop(*empty)


@dataclass
class Known:
    """What statistics say of the rows of a read. failed: values of each raw column that aren't of its type; values: rows
    with a value; both exact if whole, else of more rows than are read. translated: conformed columns of codes of which
    one at least translates."""

    failed: dict[str, int]
    values: dict[str, int]
    whole: bool
    translated: set[str]


def _profile(clean: DataFrame, dataset: str, names: Mapping[str, str] | None, inverse: DataFrame | None, drops: bool, known: Known | None = None) -> tuple[dict[str, str], list[str]]:
    """(types, conformed columns without a value if they are to go) in one pass over the rows, or in none where all is
    known of them."""
    failed, probe = failed_casts(clean, dataset, names), clean
    kept = kept_columns(clean, dataset, names) if drops else {}
    found, full = {}, set()
    if known is not None:
        # no failure among more rows is none among these; with all rows known, so is their number
        found = {c: known.failed[c] for c in failed if not known.failed[c] or known.whole}
        raws = {n: [f.raw for f in spec_of(dataset) if f.keep and f.name == n] for n in kept}
        some = {n for n, rs in raws.items() if any(known.values.get(r) for r in rs)}
        coded = {*AREA_COLUMNS, PRICE_COLUMN} if inverse is not None else set()
        sure = {n for n in some if n not in coded or n in known.translated} if known.whole else set()
        full = {n for n in kept if n in sure}
        none = {n for n in kept if n not in some}
        failed = {c: x for c, x in failed.items() if c not in found}
        unsure = {n: c for n, c in kept.items() if n not in full and n not in none}
    else:
        none, unsure = set(), dict(kept)
    if inverse is not None and drops:
        for c in [c for c in AREA_COLUMNS if c in unsure]:
            probe = map_area_codes(probe.withColumn(f"__raw_{c}", unsure[c]), source=f"__raw_{c}", target=f"__{c}", inverse=inverse)
            unsure[c] = F.col(f"__{c}")
        if PRICE_COLUMN in unsure:
            unsure[PRICE_COLUMN] = price_code(unsure[PRICE_COLUMN])
    wanted = [*failed.values(), *[F.count(c) for c in unsure.values()]]
    row = list(probe.agg(*[x.alias(f"n{k}") for k, x in enumerate(wanted)]).first()) if wanted else []
    types = types_after(dataset, found | dict(zip(failed, row[: len(failed)], strict=True)))
    empty = none | {c for c, n in zip(unsure, row[len(failed) :], strict=True) if not n}
    return types, [c for c in kept if c in empty]


def _known(version: Version, dataset: str, start: int | None, end: int | None, filters: Mapping | None, mapped: set[str] | None, names: Mapping[str, str]) -> Known:
    """What a landed table's statistics say of a read. mapped: area codes that translate, None if that isn't known."""
    others = {k for k, v in (filters or {}).items() if v is not None and k != "microdata"}
    pinned = None
    if dataset in PROJECTS:
        pinned = MICRODATA if (filters or {}).get("microdata", True) else TOTAL
    elif dataset == "multisystem":
        pinned = TOTAL

    def wanted(year: str | None) -> bool:
        if not start and not end:
            return True
        return year is not None and bool(re.fullmatch(r"[+-]?[0-9]+", year.strip())) and (start or -10**9) <= int(year) <= (end or 10**9)

    counts = version.counts(wanted, pinned)
    sure = set()
    if version.codes.get("PRICE_BASE") and all(c in PRICES for c in version.codes["PRICE_BASE"]):
        sure.add(PRICE_COLUMN)
    for raw, column in zip(("DONOR", "RECIPIENT"), AREA_COLUMNS, strict=True):
        listed = version.codes.get(raw)
        if mapped is not None and listed and all(c in mapped for c in listed):
            sure.add(column)
    return Known({c: bad for c, (_, bad) in counts.items()}, {c: n for c, (n, _) in counts.items()}, not others, sure)


def read_dataset(spark: SparkSession, root: str, dataset: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, areas: DataFrame | None = None, pre_process: bool = True, dotstat_codes: bool = True, dataflow_version: str | None = None, as_grant_equivalent: bool = False, overrides: dict | None = None, fixed: bool = False, multi_line: bool | None = None) -> DataFrame:
    """A dataset below a root, root/dataset/version, latest by default: its landed table where land_dataset() made one,
    brought up to date if files came, changed or went since, else its files. Legacy codes come from areas, or from the
    codelist that landed in root/codelists.

    Of an up-to-date landed table no job runs before the result, unless dimension filters leave open which columns have a
    value or hold text, or areas are given whose codes don't all translate.
    """
    spec_of(dataset)
    guard_totals(dataset, filters)
    table = GRANT_EQUIVALENT if as_grant_equivalent and dataset == "crs" else dataset
    version = dataflow_version or latest_version(spark, root, table)
    landed, known, mapped = _landed(spark, root, table, version), None, None
    translates = dotstat_codes and pre_process
    if translates and areas is None:
        areas, mapped = area_codes(spark, root, dataset), area_values(spark, root, dataset)
    if landed.version() is not None:
        state = landed.land(multi_line)
        raw, names = landed.read(state, year_range(start_year, end_year, YEAR_FOLDER))
        known = _known(state, dataset, start_year, end_year, filters, mapped, names)
    else:
        raw, names = read_observations(spark, f"{root.rstrip('/')}/{table}/{version}", multi_line)
    return conform(raw, dataset, start_year, end_year, filters, names, areas, pre_process, dotstat_codes, overrides, fixed, known)


def _landed(spark: SparkSession, root: str, table: str, version: str) -> Landed:
    root = root.rstrip("/")
    return Landed(spark, "crs" if table == GRANT_EQUIVALENT else table, f"{root}/{table}/{version}", f"{root}/landed/{table}/{version}")


def land_dataset(spark: SparkSession, root: str, dataset: str, dataflow_version: str | None = None, multi_line: bool | None = None, aside: bool = False) -> str:
    """Takes a dataset's files into its landed table, parquet by year with a log, or what has changed of them since it last
    did; returns where. Reads then skip years and columns. aside leaves out rows that aren't whole, which else raise."""
    landed = _landed(spark, root, dataset, dataflow_version or latest_version(spark, root, dataset))
    landed.land(multi_line, aside)
    return landed.path


def landed_years(spark: SparkSession, root: str, dataset: str, dataflow_version: str | None = None) -> list[int]:
    """The years of a landed dataset, from its log; no rows are read."""
    landed = _landed(spark, root, dataset, dataflow_version or latest_version(spark, root, dataset))
    if landed.version() is None:
        raise FileNotFoundError(f"{dataset} has no landed table below {root}")
    return landed.land().years()


def read_dac1(spark: SparkSession, root: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, **options) -> DataFrame:
    return read_dataset(spark, root, "dac1", start_year, end_year, filters, **options)


def read_dac2a(spark: SparkSession, root: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, **options) -> DataFrame:
    return read_dataset(spark, root, "dac2a", start_year, end_year, filters, **options)


def read_crs(spark: SparkSession, root: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, **options) -> DataFrame:
    return read_dataset(spark, root, "crs", start_year, end_year, filters, **options)


def read_cpa(spark: SparkSession, root: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, **options) -> DataFrame:
    return read_dataset(spark, root, "cpa", start_year, end_year, filters, **options)


def read_multisystem(spark: SparkSession, root: str, start_year: int | None = None, end_year: int | None = None, filters: Mapping | None = None, **options) -> DataFrame:
    return read_dataset(spark, root, "multisystem", start_year, end_year, filters, **options)


def read_aiddata(spark: SparkSession, path: str, start_year: int | None = None, end_year: int | None = None, pre_process: bool = True, save_to_path: str | None = None) -> DataFrame:
    """The project table: years, strict types, kept columns, without empty columns; written where save_to_path says."""
    df = cast_columns(filter_years(read_project_table(spark, path), start_year, end_year), "aiddata", strict=True)
    if pre_process:
        df = preprocess(df, "aiddata")
    df = drop_empty_columns(df)  # dates and flags are read with their types, so this is the one pass before the result
    if save_to_path:
        write_lake(df, save_to_path, None)
    return df


def available_filters(dataset: str) -> dict[str, str]:
    """The filters of a dataset and what each takes."""
    return filter_kinds(dataset)
