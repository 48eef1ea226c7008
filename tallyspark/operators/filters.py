"""Dimension filters, key strings, year ranges and the guard against counting totals twice."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.specs import DIMENSIONS, INTERNAL, TOTALLED, raw_column

TOTAL, MICRODATA = "_T", "DD"
YEAR = "TIME_PERIOD"


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions, F.lit(True))


def _dimensions(dataset: str) -> list[str]:
    if dataset not in DIMENSIONS:
        raise ValueError(f"dataset {dataset!r} has no dimensions; known: {', '.join(DIMENSIONS)}")
    return DIMENSIONS[dataset]


def filter_names(dataset: str) -> list[str]:
    names = [d for d in _dimensions(dataset) if d not in INTERNAL]
    return [*names, "microdata"] if dataset in ("crs", "cpa") else names


def filter_kinds(dataset: str) -> dict[str, str]:
    """What each filter of a dataset takes."""
    return {n: "bool" if n == "microdata" else "code, list of codes or None" for n in filter_names(dataset)}


def prefixed(column: str, prefix: str) -> Column:
    """Codes that begin with a text; a scan skips what can't."""
    return F.col(column).startswith(prefix)


def _check_names(dataset: str, filters: Mapping) -> None:
    if unknown := set(filters) - set(filter_names(dataset)):
        raise TypeError(f"unknown filters for {dataset}: {', '.join(sorted(unknown))}; known: {', '.join(filter_names(dataset))}")


def one_of(column: str, values) -> Column:
    """A code, or any of a list of codes; None is all."""
    if values is None:
        return F.lit(True)
    listed = values if isinstance(values, (list, tuple, set, frozenset)) else [values]
    return F.col(column).isin([str(v) for v in listed]) if listed else F.lit(True)


def dimension_predicate(dataset: str, filters: Mapping | None = None) -> Column:
    """Any of the codes within a dimension, all dimensions together; drilldown rows are pinned where the dataset has them."""
    filters = dict(filters or {})
    _check_names(dataset, filters)
    parts = [one_of(raw_column(d), filters[d]) for d in _dimensions(dataset) if filters.get(d) is not None]
    if dataset in ("crs", "cpa"):
        parts.append(F.col("MD_DIM") == (MICRODATA if filters.get("microdata", True) else TOTAL))
    elif dataset == "multisystem":
        parts.append(F.col("MD_DIM") == TOTAL)
    return _all(parts)


def key_predicate(dataset: str, key: str, multi_value: str = "any") -> Column:
    """The predicate of a dotted key: + joins codes, an empty or * position is all. multi_value="all" leaves a position with several codes unfiltered."""
    if key in ("all", "*"):
        return F.lit(True)
    dims, parts = _dimensions(dataset), key.split(".")
    if len(parts) != len(dims):
        raise ValueError(f"a key of {dataset} has {len(dims)} positions, not {len(parts)}")
    wanted = [(d, p.split("+")) for d, p in zip(dims, parts, strict=True) if p not in ("", "*")]
    return _all([one_of(raw_column(d), codes) for d, codes in wanted if len(codes) == 1 or multi_value != "all"])


def build_key(dataset: str, filters: Mapping | None = None) -> str:
    """The dotted key of filters."""
    filters = dict(filters or {})
    _check_names(dataset, filters)
    if dataset in ("crs", "cpa"):
        filters["md_dim"] = MICRODATA if filters.pop("microdata", True) else TOTAL
    elif dataset == "multisystem":
        filters["md_dim"] = TOTAL
    listed = lambda v: "" if v is None else "+".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    return ".".join(listed(filters.get(d)) for d in _dimensions(dataset))


def series_key(dataset: str) -> Column:
    return F.concat_ws(".", *[F.coalesce(F.col(raw_column(d)).cast("string"), F.lit("")) if d != "tying_status" else F.lit("") for d in _dimensions(dataset)])


def year_range(start: int | None = None, end: int | None = None, column: str = YEAR, floor: int | None = None) -> Column:
    """Inclusive; a falsy bound is none. floor applies where only an end is given."""
    start = start or (floor if end else None)
    year = F.col(column).try_cast("int")  # raw periods may be text such as _Z
    return _all(([year >= start] if start else []) + ([year <= end] if end else []))


def filter_years(df: DataFrame, start: int | None, end: int | None, column: str = "Commitment Year", years: Sequence[int] | None = None) -> DataFrame:
    """As year_range, but a bound must be a year of the data: of years, as a landed table's log has them, or else of the
    column's values, which are read for it."""
    if not start and not end:
        return df
    years = sorted(years) if years is not None else sorted(r[0] for r in df.select(F.col(column).try_cast("int")).dropna().distinct().collect())  # a row a year
    if missing := [y for y in (start, end) if y and y not in years]:
        raise ValueError(f"no data for {missing}; available years: {years}")
    return df.filter(year_range(start, end, column))


def drop_totals(column: str) -> Column:
    return F.col(column) != TOTAL


def only_totals(column: str) -> Column:
    return F.col(column) == TOTAL


def guard_totals(dataset: str, filters: Mapping | None) -> str | None:
    """Warns, and returns the warning, if aggregates are asked for without pinning the dimensions that hold totals."""
    filters = filters or {}
    asked = dataset == "multisystem" or filters.get("microdata", True) is False
    open_ = [d for d in TOTALLED.get(dataset, ()) if filters.get(d) is None]
    if not asked or not open_:
        return None
    message = f"{dataset}: {', '.join(open_)} not pinned, so totals ({TOTAL}) and details are both returned; summing counts twice"
    warnings.warn(message, stacklevel=2)
    return message


def double_count_report(df: DataFrame, dims: Sequence[str], unpinned: Sequence[str]) -> DataFrame:
    """(dimension, groups, total_rows, detail_rows): where groups of the other dimensions hold both totals and details.

    Rows are counted once by all dimensions, by whether each unpinned one is a total in its code; those counts are then
    regrouped by all dimensions but one, each time another, in one shuffle that a number tells apart.
    """
    counted = df.groupBy(*[F.col(d).alias(f"d{k}") for k, d in enumerate(dims)]).agg(F.count("*").alias("n"))
    views = F.array(*[F.struct(F.lit(u).alias("dimension"), F.struct(*[(F.lit(None).cast(df.schema[d].dataType) if d == u else F.col(f"d{k}")).alias(f"d{k}") for k, d in enumerate(dims)]).alias("others"), (F.col(f"d{list(dims).index(u)}") == TOTAL).alias("total")) for u in unpinned])
    seen = counted.select("n", F.explode(views).alias("x")).select("n", "x.*")
    mixed = seen.groupBy("dimension", "others").agg(F.sum(F.when(F.col("total"), F.col("n"))).alias("t"), F.sum(F.when(~F.col("total"), F.col("n"))).alias("o")).filter("t > 0 and o > 0")
    found = mixed.groupBy("dimension").agg(F.count("*").alias("groups"), F.sum("t").alias("total_rows"), F.sum("o").alias("detail_rows"))
    asked = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(u) for u in unpinned])).alias("dimension"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return asked.join(found, "dimension", "left").select("dimension", zero("groups"), zero("total_rows"), zero("detail_rows"))
