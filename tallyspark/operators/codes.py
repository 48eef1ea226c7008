"""Codelists: mappings as small tables, overlay, inversion, translation, merge and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Price bases and their legacy codes.
PRICES = {"V": "A", "Q": "D", "XDC": "N", "PT_B5G": "PT_B5G"}
#: A codelist of at most this many rows, or bytes by Spark's own bound, is sent to all tasks; a larger one is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 100_000_000


def size_bound(df: DataFrame) -> int:
    """What Spark takes for df's size in bytes: known of files and literal rows, and multiplied where it joins them."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small(codes: DataFrame) -> DataFrame:
    """codes with a broadcast hint if it proves small, by Spark's bound or else a count; otherwise Spark shuffles it."""
    if size_bound(codes) <= BROADCAST_BYTES:
        return F.broadcast(codes)
    return F.broadcast(codes) if codes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else codes


def numeric_codes(mapping: DataFrame) -> DataFrame:
    """(code int, value, ord): rows whose key is all digits."""
    return mapping.filter(F.col("code").cast("string").rlike("^[0-9]+$")).withColumn("code", F.col("code").cast("int"))


def overlay(base: DataFrame, top: DataFrame) -> DataFrame:
    """(code, value, ord): top wins; a code of base keeps its place, others follow in top's order."""
    last = base.agg(F.coalesce(F.max("ord"), F.lit(0)).alias("last"))
    t = top.select("code", F.col("value").alias("new"), F.col("ord").alias("new_ord"))
    joined = base.join(t, "code", "full").crossJoin(F.broadcast(last))  # one row
    return joined.select("code", F.coalesce("new", "value").alias("value"), F.coalesce("ord", F.col("last") + F.col("new_ord")).cast("long").alias("ord"))


def invert(mapping: DataFrame, overrides: dict | None = None) -> DataFrame:
    """(value, code): of equal values the last by ord wins, or what overrides says."""
    code = F.max_by("code", "ord")
    for value, chosen in (overrides or {}).items():
        code = F.when(F.col("value") == value, F.lit(chosen)).otherwise(code)
    return mapping.groupBy("value").agg(code.alias("code"))


def area_inverse(mapping: DataFrame, overrides: dict | None = None) -> DataFrame:
    """(__value, __code): numeric codes by value, to be joined; its rows are counted once, here."""
    return small(invert(mapping, overrides).select(F.col("value").alias("__value"), F.col("code").cast("int").alias("__code")))


def map_area_codes(df: DataFrame, mapping: DataFrame | None = None, source: str = "donor_code", target: str = "donor_code", overrides: dict | None = None, inverse: DataFrame | None = None) -> DataFrame:
    """target holds the numeric code of source's value; null where there is none. inverse: area_inverse(), where several
    columns are mapped."""
    inverse = area_inverse(mapping, overrides) if inverse is None else inverse
    joined = df.join(inverse, F.col(f"`{source}`") == F.col("__value"), "left")
    columns = [c for c in df.columns if c != target]
    place = df.columns.index(target) if target in df.columns else len(columns)
    chosen = [F.col(f"`{c}`") for c in columns]
    return joined.select(*chosen[:place], F.col("__code").alias(target), *chosen[place:])


def price_code(c: Column, prices: dict | None = None) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in (prices or PRICES).items() for x in pair]), c)


def map_prices(df: DataFrame, source: str = "amounttype_code", target: str = "amounttype_code", prices: dict | None = None) -> DataFrame:
    return df.withColumn(target, price_code(F.col(source), prices))


def folded_units(df: DataFrame) -> DataFrame:
    """Rows in other units take the unit as amount type; the unit goes. Rows without unit go, repeated ones stay."""
    other = F.col("unit_measure_code") != "USD"
    folded = df.filter("unit_measure_code is not null").withColumns(
        {"amounttype_code": F.when(other, F.col("unit_measure_code")).otherwise(F.col("amounttype_code")), "amount_type": F.when(other, F.col("unit_measure_name")).otherwise(F.col("amount_type"))}
    )
    return folded.drop("unit_measure_code", "unit_measure_name")


def unit_to_amount_type(df: DataFrame) -> DataFrame:
    """folded_units() without repeated rows."""
    return folded_units(df).dropDuplicates()


def union_members(members: Sequence[DataFrame]) -> DataFrame:
    first, *rest = members
    for m in rest:
        first = first.unionByName(m, allowMissingColumns=True)
    return first


#: Conformed columns that hold area codes and, but for the table of aggregates, price codes.
AREA_COLUMNS, PRICE_COLUMN = ("donor_code", "recipient_code"), "data_type_code"


def translate(df: DataFrame, dataset: str, inverse: DataFrame) -> DataFrame:
    """Legacy codes for a conformed table, from area_inverse()."""
    out = df
    for c in AREA_COLUMNS:
        if c in out.columns:
            out = map_area_codes(out, source=c, target=c, inverse=inverse)
    if dataset == "dac1":
        return map_prices(unit_to_amount_type(out))
    return map_prices(out, PRICE_COLUMN, PRICE_COLUMN)


def first_list_wins(lists: Sequence[DataFrame]) -> DataFrame:
    """(code, value) of codelists in order of priority."""
    ranked = [x.select("code", "value", F.lit(k).alias("prio")) for k, x in enumerate(lists)]
    return union_members(ranked).groupBy("code").agg(F.min_by("value", "prio").alias("value"))


def merge_lists(committed: DataFrame, live: DataFrame) -> DataFrame:
    """(code, value): live wins, codes that only committed has stay."""
    return committed.select("code", F.col("value").alias("old")).join(live.select("code", F.col("value").alias("new")), "code", "full").select("code", F.coalesce("new", "old").alias("value"))


def drift(committed: DataFrame, live: DataFrame) -> DataFrame:
    """(code, old, new, status): added, changed, historical or same."""
    both = committed.select("code", F.col("value").alias("old"), F.lit(True).alias("c")).join(live.select("code", F.col("value").alias("new"), F.lit(True).alias("l")), "code", "full")
    status = F.when(F.col("c").isNull(), "added").when(F.col("l").isNull(), "historical").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return both.select("code", "old", "new", status.alias("status"))


def has_drift(committed: DataFrame, live: DataFrame) -> bool:
    return not drift(committed, live).filter(F.col("status").isin("added", "changed")).isEmpty()


def canonical_order(code: Column) -> list[Column]:
    """Digits by number, other codes by text, the pattern entry last."""
    text = code.cast("string")
    group = F.when(text == "(.*)", 2).when(text.rlike("^[0-9]+$"), 0).otherwise(1)
    return [group, text.try_cast("long"), text]


def column_drift(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    return {"missing": [c for c in expected if c not in df.columns], "unexpected": [c for c in df.columns if c not in expected]}


def column_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(column, status, n): columns of df and expected ones, as expected, missing or unexpected, with their values that
    aren't null; one pass."""
    drifted = column_drift(df, expected)
    status = {c: "unexpected" if c in drifted["unexpected"] else "expected" for c in df.columns} | {c: "missing" for c in drifted["missing"]}
    counted = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"), (F.count(F.col(f"`{c}`")) if c in df.columns else F.lit(0).cast("long")).alias("n")) for c, s in status.items()]
    return df.agg(F.array(*counted).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def dimensions_changed(found: Column, dataset: str) -> Column:
    """Whether a number of key dimensions isn't that of a dataset."""
    from ..sources.specs import DIMENSIONS

    return ~found.eqNullSafe(F.lit(len(DIMENSIONS[dataset])))


def check_dimensions(found: int, dataset: str) -> None:
    from ..sources.specs import DIMENSIONS

    if found != len(DIMENSIONS[dataset]):
        raise ValueError(f"breaking schema change: {dataset} has {found} key dimensions, not {len(DIMENSIONS[dataset])}")


def last_observations(df: DataFrame, series: Sequence[str], n: int, period: str = "TIME_PERIOD", ties: Sequence[str] = ()) -> DataFrame:
    """The newest n rows of each series."""
    w = Window.partitionBy(*series).orderBy(F.col(period).desc(), *ties)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


#: Marks an aggregate's rows in which a dimension is summed over.
TOTAL = "_T"


def _lattice(totalled: Sequence[str]) -> dict[tuple[str, ...], tuple[str, ...]]:
    """Each subset of the dimensions to the one it is built from, with one dimension more: that of which most others are
    built, so that a level is summed once from the level above."""
    sets = [tuple(t for k, t in enumerate(totalled) if mask >> k & 1) for mask in range(2 ** len(totalled) - 1, -1, -1)]
    parent = {}
    for s in sets:
        if len(s) < len(totalled):
            missing = next(t for t in reversed(totalled) if t not in s)
            parent[s] = tuple(t for t in totalled if t in s or t == missing)
    return parent


def with_totals(df: DataFrame, dims: Sequence[str], totalled: Sequence[str], value: str, alias: str = "value") -> DataFrame:
    """Sums over dims with total rows (`TOTAL`) for each combination of the other dimensions.

    The finest sums are the only ones that are made of df's rows; each other level is summed from a finer one that has
    one dimension more, so what is shuffled is at most the finest level for each level, not df's rows for each.
    """
    levels = {tuple(totalled): df.groupBy(*dims, *totalled).agg(F.sum(value).alias(alias))}
    kind = levels[tuple(totalled)].schema[alias].dataType  # a sum of sums is wider than a sum
    for kept, finer in sorted(_lattice(totalled).items(), key=lambda x: -len(x[0])):
        levels[kept] = levels[finer].groupBy(*dims, *kept).agg(F.sum(alias).cast(kind).alias(alias))
    shown = lambda kept: levels[kept].select(*dims, *[F.col(f"`{t}`") if t in kept else F.lit(TOTAL).alias(t) for t in totalled], alias)
    return union_members([shown(kept) for kept in levels])


def merged_totals(parts: Sequence[DataFrame], dims: Sequence[str], totalled: Sequence[str], value: str = "value") -> DataFrame:
    """with_totals() of several tables as that of all of them: a new year's sums are added to what there is."""
    every = union_members(parts)
    return every.groupBy(*dims, *totalled).agg(F.sum(value).cast(every.schema[value].dataType).alias(value))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct()


def dimension_catalogue(df: DataFrame, columns: Sequence[str], labels: dict[str, str] | None = None) -> DataFrame:
    """(dimension, code, label, n): observed codes, with a label from the column that labels names for theirs (of several
    the least). Rows are first counted by all columns together, each once a task, and only those counts become a row a
    dimension; where most rows differ, that count passes them on as they are."""
    labels = labels or {}
    used = list(dict.fromkeys([*columns, *[labels[c] for c in columns if c in labels]]))
    counted = df.groupBy(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(used)]).agg(F.count("*").alias("n"))
    at = lambda c: F.col(f"c{used.index(c)}")
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), at(c).alias("code"), (at(labels[c]) if c in labels else F.lit(None).cast("string")).alias("label")) for c in columns])
    long = counted.select("n", F.explode(pairs).alias("x")).select("n", "x.*")
    return long.filter("code is not null").groupBy("dimension", "code").agg(F.min("label").alias("label"), F.sum("n").alias("n"))


def count_and_total(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, value): rows and the sum of a column."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(value).alias("value"))


def join_measures(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Two tables that hold different measures of the same keys, side by side."""
    return left.join(right, list(on), how)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def ranked_codes(codes: DataFrame, column: str = "code") -> DataFrame:
    """(code, place): places in canonical order, from 1. Codes are ranked within ranges, numbers by millions and texts by
    their first letters, and the sizes of the ranges before are added; only those sizes meet in one task."""
    group, number, text = canonical_order(F.col(column))
    ranges = [group.alias("__g"), F.floor(number / 1_000_000).alias("__m"), F.when(number.isNull(), F.substring(text, 1, 4)).alias("__t")]
    keys = ["__g", "__m", "__t"]
    dealt = codes.select(F.col(column).alias("code"), *ranges, number.alias("__number"))
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("__size"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__size")
    placed = dealt.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__number", F.col("code").cast("string")))).alias("d")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return placed.join(before.alias("b"), same).select("code", (F.col("__n") + F.col("__before")).cast("long").alias("place"))
