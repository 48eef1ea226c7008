"""Null tokens, casts, flags, kept and renamed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.specs import FALLBACK, Field, spec_of

# What a reader of tables takes for a missing value.
DEFAULT_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
NULLS = (*DEFAULT_NULLS, "_Z")
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def nulls_from_tokens(df: DataFrame, tokens=NULLS) -> DataFrame:
    """Text columns with null for exact matches of a token."""
    return df.select(*[F.when(~quoted(c).isin(*tokens), quoted(c)).alias(c) if t == "string" else quoted(c) for c, t in df.dtypes])


def yes_no(c: Column) -> Column:
    return F.when(c == "Yes", 1).when(c == "No", 0).cast("tinyint")


def _present(fields: tuple[Field, ...], df: DataFrame, names: Mapping[str, str]) -> list[Field]:
    return [f for f in fields if names.get(f.raw, f.raw) in df.columns]


_EDGE = "[^0-9A-Za-z.+-]*"
_INTEGER = rf"^{_EDGE}[+-]?0*[0-9]{{1,19}}{_EDGE}$"
#: What every text that casts to a type looks like, and few others.
LOOKS = {
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), _INTEGER),
    "double": rf"(?i)^{_EDGE}[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[df]?|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[df]?|inf|infinity|nan){_EDGE}$",
    "boolean": rf"(?i)^{_EDGE}(?:t|true|y|yes|1|f|false|n|no|0){_EDGE}$",
}


def isnt(text: Column, kind: str) -> Column:
    """Whether a text doesn't cast to a type. A try_cast that fails throws and catches an exception, many times the work of
    a cast, so it sees only texts that look like the type."""
    return F.when(text.rlike(LOOKS[kind]), text.try_cast(kind).isNull()).otherwise(text.isNotNull())


def failed_casts(df: DataFrame, dataset: str, names: Mapping[str, str] | None = None) -> dict[str, Column]:
    """For each numeric column of the spec in df the aggregate that counts values that aren't of its type."""
    names = names or {}
    numeric = [f for f in _present(spec_of(dataset), df, names) if f.type in (*_INTEGERS, "double") and not f.flag]
    at = lambda f: quoted(names.get(f.raw, f.raw))
    return {f.raw: F.count_if(isnt(at(f), f.type)) for f in numeric}


def types_after(dataset: str, failed: Mapping[str, int]) -> dict[str, str]:
    """Types of the spec, given how many values of each numeric column failed: columns of FALLBACK with one become text,
    any other is an error."""
    if wrong := [c for c, n in failed.items() if n and c not in FALLBACK]:
        raise ValueError(f"values that aren't numbers in {', '.join(wrong)}")
    return {f.raw: f.type for f in spec_of(dataset)} | {c: "string" for c, n in failed.items() if n}


def fallback_types(df: DataFrame, dataset: str, names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Types of the spec for df, in one pass."""
    failed = failed_casts(df, dataset, names)
    row = df.agg(*[x.alias(f"n{k}") for k, x in enumerate(failed.values())]).first() if failed else ()
    return types_after(dataset, dict(zip(failed, row, strict=True)))


def fixed_types(dataset: str) -> dict[str, str]:
    """Types without a look at the data: columns of FALLBACK are text."""
    return {f.raw: "string" if f.raw in FALLBACK else f.type for f in spec_of(dataset)}


def cast_columns(df: DataFrame, dataset: str, names: Mapping[str, str] | None = None, types: Mapping[str, str] | None = None, strict: bool = False) -> DataFrame:
    """Columns cast to the types of the spec; bad values raise. strict: a column outside the spec is an error."""
    names = names or {}
    by = {names.get(f.raw, f.raw): f for f in spec_of(dataset)}
    if strict and (unknown := [c for c in df.columns if c not in by]):
        raise KeyError(f"columns outside the spec: {', '.join(unknown)}")

    def cast(c: str, kind: str) -> Column:
        f = by.get(c)
        if f is None or f.flag:
            return quoted(c)
        target = (types or {}).get(f.raw, f.type)
        if target == "date" and kind == "string":
            return F.to_date(quoted(c), "MM/dd/yyyy").alias(c)
        return quoted(c).cast(target).alias(c)

    return df.select(*[cast(c, t) for c, t in df.dtypes])


def kept_columns(df: DataFrame, dataset: str, names: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Kept columns in the order of the spec by their new names, flags as numbers; of two raw columns with one target the
    first value that isn't null. names: raw names to those in df, where a reader had to change them."""
    names, chosen = names or {}, {}
    for f in spec_of(dataset):
        at = names.get(f.raw, f.raw)
        if f.flag and f.keep and at not in df.columns:
            raise KeyError(f"flag column {f.raw} is missing")
        if f.keep and at in df.columns:
            chosen.setdefault(f.name, []).append(yes_no(quoted(at)) if f.flag else quoted(at))
    return {n: F.coalesce(*cs) if len(cs) > 1 else cs[0] for n, cs in chosen.items()}


def preprocess(df: DataFrame, dataset: str, names: Mapping[str, str] | None = None) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in kept_columns(df, dataset, names).items()])


def non_null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count(quoted(c)).alias(c) for c in df.columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """df without the columns that are null in all rows; one pass. Without rows no column is left."""
    counts = non_null_counts(df).first()
    return df.select(*[quoted(c) for c, n in zip(df.columns, counts, strict=True) if n])
