"""Queries over the given tables, one or more for each operator, and their SQL.

The observation view shapes line items as a raw cube: suppliers' nations are donors, customers' nations recipients.
"""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import codes, filters, projections
from ..sources import metadata, readers, sinks
from ..sources.specs import spec_of
from ..streaming.increments import append_increments, drop_repeated, keep_last, read_increments, read_last
from . import datasets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIMS = ["DONOR", "RECIPIENT", "SECTOR", "MEASURE", "CHANNEL", "MODALITY", "FLOW_TYPE", "PRICE_BASE", "MD_DIM", "UNIT_MEASURE"]
OBS = """obs AS (
SELECT dn.n_name AS DONOR, rn.n_name AS RECIPIENT, CAST(c_nationkey % 7 AS VARCHAR) AS SECTOR, CAST(l_linenumber AS VARCHAR) AS MEASURE,
       substr(o_orderpriority, 1, 1) AS CHANNEL, l_returnflag AS MODALITY, o_orderstatus AS FLOW_TYPE, CASE l_linestatus WHEN 'O' THEN 'V' ELSE 'Q' END AS PRICE_BASE,
       CASE WHEN l_partkey % 3 > 0 THEN 'USD' ELSE 'XDC' END AS UNIT_MEASURE, CAST(year(o_orderdate) AS INT) AS TIME_PERIOD, CAST(l_orderkey AS BIGINT) AS MD_ID,
       CASE WHEN l_orderkey % 5 > 0 THEN 'DD' ELSE '_T' END AS MD_DIM, CAST(l_extendedprice AS DECIMAL(18,2)) AS OBS_VALUE
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation rn ON c_nationkey = rn.n_nationkey
     JOIN supplier ON l_suppkey = s_suppkey JOIN nation dn ON s_nationkey = dn.n_nationkey)"""
#: The area codelist: nations numbered, two numbers colliding on each of five names, five nations without.
AREAS = """areas AS (
SELECT CAST(n_nationkey AS INT) AS code, n_name AS value, CAST(n_nationkey AS BIGINT) AS ord FROM nation WHERE n_nationkey < 20
UNION ALL SELECT CAST(n_nationkey + 900 AS INT), n_name, CAST(n_nationkey + 100 AS BIGINT) FROM nation WHERE n_nationkey < 5)"""
INVERSE = "inverse AS (SELECT value, arg_max(code, ord) AS code FROM areas GROUP BY value)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below the checkpoint folder that the session names. A local session
    without one, as in tests, gets a temporary folder; on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="scratch-"))
    return f"{sc.getCheckpointDir()}/slice-{uuid.uuid4().hex}"


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    nation = t("nation").select("n_nationkey", "n_name")
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    named = lines.join(nation.toDF("rk", "RECIPIENT"), F.col("c_nationkey") == F.col("rk")).join(nation.toDF("dk", "DONOR"), F.col("s_nationkey") == F.col("dk"))
    return named.select(
        "DONOR", "RECIPIENT", (F.col("c_nationkey") % 7).cast("string").alias("SECTOR"), F.col("l_linenumber").cast("string").alias("MEASURE"), F.substring("o_orderpriority", 1, 1).alias("CHANNEL"),
        F.col("l_returnflag").alias("MODALITY"), F.col("o_orderstatus").alias("FLOW_TYPE"), F.when(F.col("l_linestatus") == "O", "V").otherwise("Q").alias("PRICE_BASE"),
        F.when(F.col("l_partkey") % 3 > 0, "USD").otherwise("XDC").alias("UNIT_MEASURE"), F.year("o_orderdate").alias("TIME_PERIOD"), F.col("l_orderkey").cast("long").alias("MD_ID"),
        F.when(F.col("l_orderkey") % 5 > 0, "DD").otherwise("_T").alias("MD_DIM"), F.col("l_extendedprice").cast("decimal(18,2)").alias("OBS_VALUE"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    base = n.filter("n_nationkey < 20").select(F.col("n_nationkey").cast("int").alias("code"), F.col("n_name").alias("value"), F.col("n_nationkey").cast("long").alias("ord"))
    return base.union(n.filter("n_nationkey < 5").select((F.col("n_nationkey") + 900).cast("int"), "n_name", (F.col("n_nationkey") + 100).cast("long")))


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def with_obs(body: str, *more: str) -> str:
    return "WITH " + ",\n".join((OBS, *more)) + "\n" + body


def summed(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum("OBS_VALUE").cast("decimal(28,2)").alias("value"))


TOTALS = "count(*) AS n, CAST(sum(OBS_VALUE) AS DECIMAL(28,2)) AS value"


# filters


@query(with_obs(f"SELECT DONOR, SECTOR, {TOTALS} FROM obs WHERE DONOR IN ('NATION_6', 'NATION_7') AND SECTOR = '3' AND PRICE_BASE = 'V' AND TIME_PERIOD BETWEEN 1996 AND 1997 GROUP BY ALL"))
def filter_dac1(spark, d):
    return summed(obs(spark, d).filter(filters.dimension_predicate("dac1", {"donor": ["NATION_6", "NATION_7"], "sector": 3, "price_base": "V"})).filter(filters.year_range(1996, 1997)), "DONOR", "SECTOR")


@query(with_obs(f"SELECT RECIPIENT, MEASURE, {TOTALS} FROM obs WHERE RECIPIENT IN ('NATION_14', 'NATION_17') AND MEASURE IN ('1', '2') AND UNIT_MEASURE = 'USD' GROUP BY ALL"))
def filter_dac2a(spark, d):
    return summed(obs(spark, d).filter(filters.dimension_predicate("dac2a", {"recipient": ["NATION_14", "NATION_17"], "measure": [1, 2], "unit_measure": "USD"})), "RECIPIENT", "MEASURE")


@query(with_obs(f"SELECT CHANNEL, MODALITY, {TOTALS} FROM obs WHERE MD_DIM = 'DD' AND CHANNEL IN ('1', '3') AND FLOW_TYPE = 'F' GROUP BY ALL"))
def filter_crs(spark, d):
    return summed(obs(spark, d).filter(filters.dimension_predicate("crs", {"channel": ["1", "3"], "flow_type": "F"})), "CHANNEL", "MODALITY")


@query(with_obs(f"SELECT CHANNEL, MODALITY, {TOTALS} FROM obs WHERE MD_DIM = '_T' AND MODALITY = 'R' GROUP BY ALL"))
def filter_cpa_aggregates(spark, d):
    return summed(obs(spark, d).filter(filters.dimension_predicate("cpa", {"modality": "R", "microdata": False})), "CHANNEL", "MODALITY")


@query(with_obs(f"SELECT RECIPIENT, SECTOR, {TOTALS} FROM obs WHERE MD_DIM = '_T' AND DONOR = 'NATION_18' GROUP BY ALL"))
def filter_multisystem(spark, d):
    return summed(obs(spark, d).filter(filters.dimension_predicate("multisystem", {"donor": "NATION_18"})), "RECIPIENT", "SECTOR")


@query(with_obs(f"SELECT DONOR, {TOTALS} FROM obs WHERE DONOR IN ('NATION_6', 'NATION_12') AND MEASURE = '2' AND PRICE_BASE = 'Q' GROUP BY ALL"))
def filter_key(spark, d):
    return summed(obs(spark, d).filter(filters.key_predicate("dac2a", "NATION_6+NATION_12..2..Q")), "DONOR")


@query(with_obs(f"SELECT MEASURE, {TOTALS} FROM obs WHERE MEASURE = '2' GROUP BY ALL"))
def filter_key_multi_all(spark, d):
    return summed(obs(spark, d).filter(filters.key_predicate("dac2a", "NATION_6+NATION_12.*.2..", multi_value="all")), "MEASURE")


@query(with_obs("SELECT DONOR || '.' || RECIPIENT || '.' || MEASURE || '.' || UNIT_MEASURE || '.' || PRICE_BASE AS series, count(*) AS n FROM obs GROUP BY ALL"))
def series_keys(spark, d):
    return obs(spark, d).groupBy(filters.series_key("dac2a").alias("series")).agg(F.count("*").alias("n"))


@query(with_obs(f"SELECT TIME_PERIOD, {TOTALS} FROM obs WHERE TIME_PERIOD BETWEEN 1950 AND 1996 GROUP BY ALL"))
def filter_year_floor(spark, d):
    return summed(obs(spark, d).filter(filters.year_range(end=1996, floor=1950)), "TIME_PERIOD")


@query("SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY ALL")
def filter_years_checked(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"))
    return filters.filter_years(o, 1996, 1998, "y").groupBy("y").agg(F.count("*").alias("n"))


@query(with_obs("SELECT 'MD_DIM' AS dimension, count(*) AS groups, CAST(sum(t) AS BIGINT) AS total_rows, CAST(sum(o) AS BIGINT) AS detail_rows FROM (SELECT count(*) FILTER (MD_DIM = '_T') AS t, count(*) FILTER (MD_DIM <> '_T') AS o FROM obs GROUP BY DONOR, CHANNEL) WHERE t > 0 AND o > 0"))
def double_counting(spark, d):
    return filters.double_count_report(obs(spark, d), ["DONOR", "CHANNEL", "MD_DIM"], ["MD_DIM"])


@query(with_obs(f"SELECT 'totals' AS part, {TOTALS} FROM obs WHERE MD_DIM = '_T' UNION ALL SELECT 'details', {TOTALS} FROM obs WHERE MD_DIM <> '_T'"))
def totals_and_details(spark, d):
    o = obs(spark, d)
    part = lambda name, p: o.filter(p).agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.sum("OBS_VALUE").cast("decimal(28,2)").alias("value"))
    return part("totals", filters.only_totals("MD_DIM")).union(part("details", filters.drop_totals("MD_DIM")))


@query("SELECT p_brand, count(*) AS n FROM part WHERE p_brand LIKE 'Brand#1%' GROUP BY ALL")
def prefix_count(spark, d):
    return table(spark, d, "part").filter(filters.prefixed("p_brand", "Brand#1")).groupBy("p_brand").agg(F.count("*").alias("n"))


# projections


@query(with_obs("SELECT donor_code, aidtype_code, sector_code, year, sum(value) AS value FROM (SELECT DONOR AS donor_code, CAST(MEASURE AS INT) AS aidtype_code, SECTOR AS sector_code, TIME_PERIOD AS year, OBS_VALUE AS value FROM obs) GROUP BY ALL"))
def preprocess_dac1(spark, d):
    kept = projections.preprocess(obs(spark, d).withColumn("MEASURE", F.col("MEASURE").cast("int")), "dac1")
    return kept.groupBy("donor_code", "aidtype_code", "sector_code", "year").agg(F.sum("value").alias("value"))


@query("SELECT CAST(CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS TINYINT) AS flag, count(*) AS n FROM lineitem GROUP BY ALL")
def yes_no_flags(spark, d):
    said = F.when(F.col("l_linestatus") == "O", "Yes").when(F.col("l_linestatus") == "F", "No").otherwise("?")
    return table(spark, d, "lineitem").select(projections.yes_no(said).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query("SELECT coalesce(CASE WHEN l_orderkey % 2 = 0 THEN l_partkey END, l_suppkey) % 10 AS channel_delivery_code, count(*) AS n FROM lineitem GROUP BY ALL")
def merged_columns(spark, d):
    x = table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 2 == 0, F.col("l_partkey")).alias("CHANNEL_DELIVERY_CODE"), F.col("l_suppkey").alias("CHANNELDELIVERY_CODE"))
    return projections.preprocess(x, "crs").select((F.col("channel_delivery_code") % 10).alias("channel_delivery_code")).groupBy("channel_delivery_code").agg(F.count("*").alias("n"))


@query(with_obs("SELECT column_name, n FROM (SELECT count(DONOR) AS DONOR, count(OBS_VALUE) AS OBS_VALUE, count(CASE WHEN TIME_PERIOD > 1997 THEN 1 END) AS late FROM obs) UNPIVOT (n FOR column_name IN (DONOR, OBS_VALUE, late))"))
def drop_empty(spark, d):
    o = obs(spark, d).select("DONOR", "OBS_VALUE", F.when(F.col("TIME_PERIOD") > 1997, 1).alias("late"), F.lit(None).cast("string").alias("void"))
    full = projections.drop_empty_columns(o)
    counts = projections.non_null_counts(full)
    return counts.unpivot([], full.columns, "column_name", "n")


@query("SELECT CASE WHEN e IN ('NA', '_Z') THEN NULL ELSE e END AS kind, count(*) AS n FROM (SELECT CASE event_id % 5 WHEN 0 THEN '_Z' WHEN 1 THEN 'NA' ELSE event_type END AS e FROM events) GROUP BY ALL")
def null_tokens(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 5 == 0, "_Z").when(F.col("event_id") % 5 == 1, "NA").otherwise(F.col("event_type")).alias("kind"))
    return projections.nulls_from_tokens(e).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN l_linenumber = 7 THEN '_T' ELSE CAST(l_linenumber AS VARCHAR) END AS CHANNEL, CAST(l_partkey % 5 AS INT) AS SECTOR, count(*) AS n FROM lineitem GROUP BY ALL")
def dtype_fallback(spark, d):
    x = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 7, "_T").otherwise(F.col("l_linenumber").cast("string")).alias("CHANNEL"), (F.col("l_partkey") % 5).cast("string").alias("SECTOR"))
    return projections.cast_columns(x, "crs", types=projections.fallback_types(x, "crs")).groupBy("CHANNEL", "SECTOR").agg(F.count("*").alias("n"))


# codes


@query(with_obs("SELECT code AS donor_code, count(*) AS n FROM obs LEFT JOIN inverse ON DONOR = value GROUP BY ALL", AREAS, INVERSE))
def map_areas(spark, d):
    return codes.map_area_codes(obs(spark, d).select(F.col("DONOR").alias("donor_code")), areas(spark, d)).groupBy("donor_code").agg(F.count("*").alias("n"))


@query(with_obs("SELECT CASE p WHEN 'V' THEN 'A' WHEN 'Q' THEN 'D' WHEN 'XDC' THEN 'N' END AS amounttype_code, count(*) AS n FROM (SELECT CASE WHEN UNIT_MEASURE = 'XDC' THEN CASE WHEN MEASURE = '1' THEN 'Z' ELSE 'XDC' END ELSE PRICE_BASE END AS p FROM obs) GROUP BY ALL"))
def map_price_codes(spark, d):
    p = obs(spark, d).select(F.when(F.col("UNIT_MEASURE") == "XDC", F.when(F.col("MEASURE") == "1", "Z").otherwise("XDC")).otherwise(F.col("PRICE_BASE")).alias("amounttype_code"))
    return codes.map_prices(p).groupBy("amounttype_code").agg(F.count("*").alias("n"))


#: Two codelists over the customers: the committed one, and a live one that adds, drops and changes codes.
LISTS = """old AS (SELECT CAST(c_custkey AS INT) AS code, c_name AS value FROM customer WHERE c_custkey % 5 < 4),
live AS (SELECT CAST(c_custkey AS INT) AS code, CASE WHEN c_custkey % 4 = 0 THEN lower(c_name) ELSE c_name END AS value FROM customer WHERE c_custkey % 5 >= 2)"""


def old_and_live(spark, d) -> tuple[DataFrame, DataFrame]:
    n = table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("code"), F.col("c_name").alias("value"))
    return n.filter("code % 5 < 4"), n.filter("code % 5 >= 2").withColumn("value", F.when(F.col("code") % 4 == 0, F.lower("value")).otherwise(F.col("value")))


@query(f"WITH {LISTS} SELECT coalesce(l.code, o.code) AS code, coalesce(l.value, o.value) AS value, CAST(coalesce(o.code, (SELECT max(code) FROM old) + l.code) AS BIGINT) AS ord FROM old o FULL JOIN live l ON o.code = l.code")
def overlay_codes(spark, d):
    old, live = (x.withColumn("ord", F.col("code").cast("long")) for x in old_and_live(spark, d))
    return codes.overlay(old, live)


@query("SELECT c_nationkey || '-' || c_custkey % 1000 AS value, CAST(arg_max(c_custkey, c_acctbal * 100000 + c_custkey) AS INT) AS code FROM customer GROUP BY ALL")
def invert_codes(spark, d):
    order = (F.col("c_acctbal") * 100000 + F.col("c_custkey")).alias("ord")
    listed = table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("code"), F.concat_ws("-", "c_nationkey", F.col("c_custkey") % 1000).alias("value"), order)
    return codes.invert(listed)


@query(f"WITH {LISTS} SELECT coalesce(l.code, o.code) AS code, coalesce(l.value, o.value) AS value FROM old o FULL JOIN live l ON o.code = l.code")
def merge_codes(spark, d):
    return codes.merge_lists(*old_and_live(spark, d))


@query(f"WITH {LISTS} SELECT CASE WHEN o.code IS NULL THEN 'added' WHEN l.code IS NULL THEN 'historical' WHEN o.value = l.value THEN 'same' ELSE 'changed' END AS status, count(*) AS n FROM old o FULL JOIN live l ON o.code = l.code GROUP BY ALL")
def drift_codes(spark, d):
    return codes.drift(*old_and_live(spark, d)).groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH {LISTS} SELECT coalesce(o.code, l.code) AS code, coalesce(o.value, l.value) AS value FROM old o FULL JOIN live l ON o.code = l.code")
def priority_union(spark, d):
    return codes.first_list_wins(list(old_and_live(spark, d)))


@query("SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'absent']) AS \"column\", unnest(['expected', 'expected', 'unexpected', 'missing']) AS status, unnest([count(o_orderkey), count(o_custkey), count(CASE WHEN o_orderkey % 3 > 0 THEN 1 END), 0]) AS n FROM orders")
def column_report(spark, d):
    status = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("o_orderstatus")
    return codes.column_report(table(spark, d, "orders").select("o_orderkey", "o_custkey", status), ["o_orderkey", "o_custkey", "absent"])


@query("SELECT code, CAST(row_number() OVER (ORDER BY CASE WHEN regexp_full_match(code, '[0-9]+') THEN 0 ELSE 1 END, try_cast(code AS BIGINT), code) AS BIGINT) AS place FROM (SELECT CAST(o_orderkey AS VARCHAR) AS code FROM orders UNION ALL SELECT c_name FROM customer)")
def canonical_codes(spark, d):
    listed = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("code")).union(table(spark, d, "customer").select("c_name"))
    return codes.ranked_codes(listed)


FOLD = """folded AS (
SELECT DISTINCT * FROM (SELECT DONOR, MEASURE, PRICE_BASE AS amounttype_code, 'p' || PRICE_BASE AS amount_type, TIME_PERIOD FROM obs WHERE UNIT_MEASURE = 'USD'
UNION ALL SELECT DONOR, MEASURE, UNIT_MEASURE, 'u' || UNIT_MEASURE, TIME_PERIOD FROM obs WHERE UNIT_MEASURE <> 'USD'))"""


def unfolded(spark, d) -> DataFrame:
    return obs(spark, d).select("DONOR", "MEASURE", F.col("PRICE_BASE").alias("amounttype_code"), F.concat(F.lit("p"), "PRICE_BASE").alias("amount_type"), F.col("UNIT_MEASURE").alias("unit_measure_code"), F.concat(F.lit("u"), "UNIT_MEASURE").alias("unit_measure_name"), "TIME_PERIOD")


@query(with_obs("SELECT * FROM folded", FOLD))
def fold_units(spark, d):
    return codes.unit_to_amount_type(unfolded(spark, d))


@query(with_obs("SELECT DISTINCT DONOR, RECIPIENT, CASE WHEN SECTOR > '3' THEN SECTOR END AS SECTOR FROM obs"))
def distinct_rows(spark, d):
    return obs(spark, d).select("DONOR", "RECIPIENT", F.when(F.col("SECTOR") > "3", F.col("SECTOR")).alias("SECTOR")).transform(codes.distinct_rows)


@query("SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, NULL::BIGINT AS key FROM customer UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier")
def union_tables(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("long").alias("nation"))
    return codes.union_members([customers, table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("long").alias("key"))])


@query(with_obs("SELECT a.donor_code, a.year, a.total, b.recipients FROM (SELECT DONOR AS donor_code, TIME_PERIOD AS year, sum(OBS_VALUE) AS total FROM obs GROUP BY ALL) a JOIN (SELECT DONOR AS donor_code, TIME_PERIOD AS year, count(DISTINCT RECIPIENT) AS recipients FROM obs WHERE PRICE_BASE = 'V' GROUP BY ALL) b ON a.donor_code = b.donor_code AND a.year = b.year"))
def join_cubes(spark, d):
    o = obs(spark, d).withColumnsRenamed({"DONOR": "donor_code", "TIME_PERIOD": "year"})
    totals = o.groupBy("donor_code", "year").agg(F.sum("OBS_VALUE").alias("total"))
    return codes.join_measures(totals, o.filter("PRICE_BASE = 'V'").groupBy("donor_code", "year").agg(F.count_distinct("RECIPIENT").alias("recipients")), ["donor_code", "year"])


TRANSLATED = {
    "dac1": "SELECT i.code AS donor_code, aidtype_code, year, CASE amounttype_code WHEN 'V' THEN 'A' WHEN 'Q' THEN 'D' WHEN 'XDC' THEN 'N' END AS amounttype_code, value FROM (SELECT DISTINCT code, aidtype_code, year, amounttype_code, value FROM (SELECT inverse.code, CAST(MEASURE AS INT) AS aidtype_code, TIME_PERIOD AS year, CASE WHEN UNIT_MEASURE <> 'USD' THEN UNIT_MEASURE ELSE PRICE_BASE END AS amounttype_code, CASE WHEN UNIT_MEASURE <> 'USD' THEN 'u' ELSE 'p' END AS amount_type, CAST(OBS_VALUE AS DOUBLE) AS value FROM obs LEFT JOIN inverse ON DONOR = inverse.value WHERE DONOR IN ('NATION_6', 'NATION_14', 'NATION_21') AND TIME_PERIOD BETWEEN 1996 AND 1998)) i",
    "dac2a": "SELECT a.code AS donor_code, b.code AS recipient_code, CAST(MEASURE AS INT) AS aidtype_code, CASE PRICE_BASE WHEN 'V' THEN 'A' ELSE 'D' END AS data_type_code, TIME_PERIOD AS year, CAST(OBS_VALUE AS DOUBLE) AS value FROM obs LEFT JOIN inverse a ON DONOR = a.value LEFT JOIN inverse b ON RECIPIENT = b.value WHERE DONOR = 'NATION_6' AND UNIT_MEASURE = 'USD'",
    "crs": "SELECT a.code AS donor_code, b.code AS recipient_code, CAST(SECTOR AS INT) AS sector_code, CASE PRICE_BASE WHEN 'V' THEN 'A' ELSE 'D' END AS data_type_code, TIME_PERIOD AS year, CAST(OBS_VALUE AS DOUBLE) AS value FROM obs LEFT JOIN inverse a ON DONOR = a.value LEFT JOIN inverse b ON RECIPIENT = b.value WHERE CHANNEL = '2' AND MODALITY = 'N' AND MD_DIM = 'DD'",
    "multisystem": "SELECT a.code AS donor_code, b.code AS recipient_code, CAST(SECTOR AS INT) AS sector_code, CASE PRICE_BASE WHEN 'V' THEN 'A' ELSE 'D' END AS data_type_code, TIME_PERIOD AS year, CAST(OBS_VALUE AS DOUBLE) AS value FROM obs LEFT JOIN inverse a ON DONOR = a.value LEFT JOIN inverse b ON RECIPIENT = b.value WHERE RECIPIENT = 'NATION_17' AND SECTOR = '3' AND MD_DIM = '_T'",
}
TRANSLATED["cpa"] = TRANSLATED["crs"].replace("CHANNEL = '2' AND MODALITY = 'N'", "CHANNEL = '3' AND MODALITY = 'R'")


def labelled(spark, d) -> DataFrame:
    """The view as it would land: text, with labels."""
    o = obs(spark, d).drop("MD_ID")
    text = o.select(*[F.col(c).cast("string").alias(c) for c in o.columns])
    return text.withColumns({"Unit of measure": F.when(F.col("UNIT_MEASURE") != "USD", "u").otherwise("p"), "Price base": F.lit("p")})


def landed(spark, d, dataset: str, raw: DataFrame) -> str:
    """A root where a dataset has landed as labelled text, with the codelist beside it."""
    root = scratch(spark)
    raw.write.csv(f"{root}/{dataset}/1.0", header=True)
    pairs = F.array_sort(F.collect_list(F.struct("ord", F.col("code").cast("string").alias("code"), "value")))
    listed = areas(spark, d).agg(pairs.alias("p"))  # a codelist, one object in one file
    text = F.to_json(F.map_from_entries(F.transform("p", lambda x: F.struct(x["code"], x["value"]))))
    listed.select(text.alias("value")).write.text(f"{root}/codelists/{metadata.AREA_LISTS[dataset]}")
    return root


#: Full reads: what lands a dataset as text and tells where, and the read of what landed.
READS: dict[str, tuple[Callable[[SparkSession, str], str], Query]] = {}


def _reader(dataset: str, years: tuple[int | None, int | None], wanted: dict, columns: list[str], sql: str, into_table: bool = True) -> None:
    """A query that lands a dataset, in its table by year too, and reads it."""

    def prepare(spark, d):
        return landed(spark, d, dataset, labelled(spark, d).drop(*(["FLOW_TYPE"] if dataset == "dac1" else [])))

    def read(spark, root):
        return getattr(datasets, f"read_{dataset}")(spark, root, *years, wanted).select(*columns)

    def f(spark, d):
        root = prepare(spark, d)
        if into_table:
            datasets.land_dataset(spark, root, dataset)
        return read(spark, root)

    f.__name__ = f"read_{dataset}"
    READS[f.__name__] = prepare, read
    query(sql)(f)


_reader("dac1", (1996, 1998), {"donor": ["NATION_6", "NATION_14", "NATION_21"]}, ["donor_code", "aidtype_code", "year", "amounttype_code", "value"],
        with_obs(TRANSLATED["dac1"].replace("SELECT DISTINCT code, aidtype_code, year, amounttype_code, value FROM (SELECT inverse.code,", "SELECT DISTINCT code, sector_code, flow, aidtype_code, year, amounttype_code, value FROM (SELECT inverse.code, SECTOR AS sector_code, 1 AS flow,"), AREAS, INVERSE))
_reader("dac2a", (None, None), {"donor": "NATION_6", "unit_measure": "USD"}, ["donor_code", "recipient_code", "aidtype_code", "data_type_code", "year", "value"], with_obs(TRANSLATED["dac2a"], AREAS, INVERSE))
_reader("crs", (None, None), {"channel": 2, "modality": "N"}, ["donor_code", "recipient_code", "sector_code", "data_type_code", "year", "value"], with_obs(TRANSLATED["crs"], AREAS, INVERSE))
_reader("cpa", (None, None), {"channel": 3, "modality": "R"}, ["donor_code", "recipient_code", "sector_code", "data_type_code", "year", "value"], with_obs(TRANSLATED["cpa"], AREAS, INVERSE), into_table=False)
_reader("multisystem", (None, None), {"recipient": "NATION_17", "sector": 3}, ["donor_code", "recipient_code", "sector_code", "data_type_code", "year", "value"], with_obs(TRANSLATED["multisystem"], AREAS, INVERSE))


@query(with_obs("SELECT i.code AS donor_code, TIME_PERIOD AS year, count(*) AS n, sum(CASE WHEN TIME_PERIOD = 1995 THEN 3 ELSE 1 END * CAST(OBS_VALUE AS DOUBLE)) AS value FROM obs LEFT JOIN inverse i ON DONOR = i.value WHERE MD_DIM = 'DD' AND TIME_PERIOD BETWEEN 1993 AND 1996 AND SECTOR <> '6' GROUP BY ALL", AREAS, INVERSE))
def landed_in_steps(spark, d):
    """A table that files come to, change in and go from between three landings; the last reads what the first two wrote."""
    root, joined = scratch(spark), scratch(spark)
    labelled(spark, d).write.parquet(joined)  # five files are written from it
    rows = spark.read.parquet(joined)
    text = lambda part, df: df.write.mode("overwrite").csv(f"{root}/crs/1.0/{part}", header=True)
    times = lambda n: F.when(F.col("TIME_PERIOD") == "1995", (F.col("OBS_VALUE").cast("double") * n).cast("string")).otherwise(F.col("OBS_VALUE"))
    text("early", rows.filter("TIME_PERIOD <= 1994 and SECTOR <> '6'"))
    text("middle", rows.filter("TIME_PERIOD = 1995 and SECTOR <> '6'").withColumn("OBS_VALUE", times(2)))
    text("wrong", rows.filter("SECTOR = '6'"))
    datasets.land_dataset(spark, root, "crs")
    text("late", rows.filter("TIME_PERIOD > 1995 and SECTOR <> '6'"))
    datasets.land_dataset(spark, root, "crs")
    text("middle", rows.filter("TIME_PERIOD = 1995 and SECTOR <> '6'").withColumn("OBS_VALUE", times(3)))
    text("wrong", rows.limit(0))
    return datasets.read_crs(spark, root, 1993, 1996, areas=areas(spark, d)).groupBy("donor_code", "year").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


@query(with_obs("SELECT i.code AS donor_code, TIME_PERIOD AS year, count(*) AS n, sum(2 * CAST(OBS_VALUE AS DOUBLE)) AS value FROM obs LEFT JOIN inverse i ON DONOR = i.value WHERE MD_DIM = 'DD' AND TIME_PERIOD <= 1995 GROUP BY ALL", AREAS, INVERSE))
def grant_equivalents(spark, d):
    """The twin of the project table with other values, landed by year first."""
    root = landed(spark, d, "crs", labelled(spark, d).filter("DONOR = 'NATION_6'"))
    labelled(spark, d).withColumn("OBS_VALUE", (F.col("OBS_VALUE").cast("double") * 2).cast("string")).write.csv(f"{root}/crs_greq/1.0", header=True)
    datasets.land_dataset(spark, root, "crs_greq")
    return datasets.read_crs(spark, root, None, 1995, as_grant_equivalent=True).groupBy("donor_code", "year").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


# aggregates and windows


@query(with_obs("SELECT DISTINCT TIME_PERIOD FROM obs WHERE TIME_PERIOD IS NOT NULL"))
def distinct_years(spark, d):
    return codes.distinct_values(obs(spark, d), "TIME_PERIOD")


@query(with_obs(f"SELECT {TOTALS} FROM obs WHERE DONOR LIKE 'NATION_1%'"))
def count_and_sum(spark, d):
    return codes.count_and_total(obs(spark, d).filter(filters.prefixed("DONOR", "NATION_1")), "OBS_VALUE")


@query(with_obs("SELECT DONOR, CASE WHEN grouping(CHANNEL) = 1 THEN '_T' ELSE CHANNEL END AS CHANNEL, CASE WHEN grouping(MODALITY) = 1 THEN '_T' ELSE MODALITY END AS MODALITY, sum(OBS_VALUE) AS value FROM obs GROUP BY GROUPING SETS ((DONOR), (DONOR, CHANNEL), (DONOR, MODALITY), (DONOR, CHANNEL, MODALITY))"))
def totals_cube(spark, d):
    return codes.with_totals(obs(spark, d), ["DONOR"], ["CHANNEL", "MODALITY"], "OBS_VALUE")


@query(with_obs("SELECT 'DONOR' AS dimension, DONOR AS code, lower(DONOR) AS label, count(*) AS n FROM obs GROUP BY ALL UNION ALL SELECT 'SECTOR', SECTOR, NULL, count(*) FROM obs GROUP BY ALL UNION ALL SELECT 'CHANNEL', CHANNEL, min(RECIPIENT), count(*) FROM obs GROUP BY CHANNEL"))
def catalogue(spark, d):
    return codes.dimension_catalogue(obs(spark, d).withColumn("Donor label", F.lower("DONOR")), ["DONOR", "SECTOR", "CHANNEL"], {"DONOR": "Donor label", "CHANNEL": "RECIPIENT"})


@query(with_obs("SELECT DONOR, SECTOR, TIME_PERIOD, value FROM (SELECT *, row_number() OVER (PARTITION BY DONOR, SECTOR ORDER BY TIME_PERIOD DESC) AS k FROM (SELECT DONOR, SECTOR, TIME_PERIOD, sum(OBS_VALUE) AS value FROM obs GROUP BY ALL)) WHERE k <= 2"))
def last_two_years(spark, d):
    yearly = obs(spark, d).groupBy("DONOR", "SECTOR", "TIME_PERIOD").agg(F.sum("OBS_VALUE").alias("value"))
    return codes.last_observations(yearly, ["DONOR", "SECTOR"], 2)


@query(with_obs("SELECT DONOR, " + ", ".join(f"CASE WHEN grouping({c}) = 1 THEN '_T' ELSE {c} END AS {c}" for c in ("CHANNEL", "MODALITY", "RECIPIENT", "SECTOR")) + ", sum(OBS_VALUE) AS value FROM obs WHERE TIME_PERIOD = 1996 GROUP BY GROUPING SETS (" + ", ".join("(" + ", ".join(["DONOR", *[c for k, c in enumerate(("CHANNEL", "MODALITY", "RECIPIENT", "SECTOR")) if m >> k & 1]]) + ")" for m in range(16)) + ")"))
def totals_lattice(spark, d):
    """Totals over all dimensions that tables hold totals of, of one year."""
    return codes.with_totals(obs(spark, d).filter("TIME_PERIOD = 1996"), ["DONOR"], ["CHANNEL", "MODALITY", "RECIPIENT", "SECTOR"], "OBS_VALUE")


#: The view with two more dimensions that have totals.
MARKED = "marked AS (SELECT DONOR, TIME_PERIOD, MD_DIM, CASE CHANNEL WHEN '5' THEN '_T' ELSE CHANNEL END AS CHANNEL, CASE MODALITY WHEN 'N' THEN '_T' ELSE MODALITY END AS MODALITY, CASE SECTOR WHEN '0' THEN '_T' ELSE SECTOR END AS SECTOR FROM obs)"
_MARKED_DIMS = ("DONOR", "TIME_PERIOD", "MD_DIM", "CHANNEL", "MODALITY", "SECTOR")


@query(with_obs(" UNION ALL ".join(f"SELECT '{u}' AS dimension, count(*) AS groups, CAST(coalesce(sum(t), 0) AS BIGINT) AS total_rows, CAST(coalesce(sum(o), 0) AS BIGINT) AS detail_rows FROM (SELECT count(*) FILTER ({u} = '_T') AS t, count(*) FILTER ({u} <> '_T') AS o FROM marked GROUP BY {', '.join(x for x in _MARKED_DIMS if x != u)}) WHERE t > 0 AND o > 0" for u in _MARKED_DIMS[2:]), MARKED))
def double_counting_dimensions(spark, d):
    marked = obs(spark, d).withColumns({"CHANNEL": F.when(F.col("CHANNEL") == "5", "_T").otherwise(F.col("CHANNEL")), "MODALITY": F.when(F.col("MODALITY") == "N", "_T").otherwise(F.col("MODALITY")), "SECTOR": F.when(F.col("SECTOR") == "0", "_T").otherwise(F.col("SECTOR"))})
    return filters.double_count_report(marked, _MARKED_DIMS, _MARKED_DIMS[2:])


@query(with_obs("SELECT filter, kind, n FROM (" + " UNION ALL ".join(f"SELECT '{c.lower()}' AS filter, 'code, list of codes or None' AS kind, count(DISTINCT {c}) AS n FROM obs" for c in ("DONOR", "RECIPIENT", "SECTOR", "MEASURE", "CHANNEL", "MODALITY", "FLOW_TYPE", "PRICE_BASE", "UNIT_MEASURE")) + " UNION ALL SELECT 'microdata', 'bool', count(DISTINCT MD_DIM) FROM obs)"))
def filter_menu(spark, d):
    """The filters of the project table, with how many codes each has to choose from."""
    kinds, o = datasets.available_filters("crs"), obs(spark, d)
    at = {n: n.upper() if n != "microdata" else "MD_DIM" for n in kinds}
    found = codes.dimension_catalogue(o, list(at.values())).groupBy("dimension").agg(F.count("*").alias("n"))
    listed = F.array(*[F.struct(F.lit(n).alias("filter"), F.lit(k).alias("kind"), F.lit(at[n]).alias("dimension")) for n, k in kinds.items()])
    return found.join(spark.range(1).select(F.inline(listed)), "dimension").select("filter", "kind", "n")


@query("SELECT c_nationkey AS nation, count(*) FILTER (c_custkey % 5 >= 2 AND (c_custkey % 5 >= 4 OR c_custkey % 4 = 0)) > 0 AS drifted FROM customer WHERE c_nationkey < 3 GROUP BY ALL")
def drift_alarms(spark, d):
    """Whether the codes of a nation's customers have drifted, for three nations, which are asked for one by one."""
    nation = table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("code"), F.col("c_nationkey").alias("nation"))
    said = []
    for k in range(3):
        old, live = (x.join(nation.filter(F.col("nation") == k), "code", "left_semi") for x in old_and_live(spark, d))
        said.append((k, codes.has_drift(old, live)))
    return nation.filter("nation < 3").select("nation").distinct().join(spark.createDataFrame(said, "nation long, drifted boolean"), "nation")


# functions

#: Addresses of both forms, of other agencies, with versions of three numbers, with a version that nothing follows, and
#: without any; then what is to be found: identifier, version, and the address with version 9.1.
ADDRESSES = {
    "'https://example.org/rest/data/OECD.DCD.FSD,DSD_' || o_custkey || '@DF_' || o_orderkey || ',1.' || o_orderkey % 9 || '/all?x=1'": ("'DSD_' || o_custkey || '@DF_' || o_orderkey", "'1.' || o_orderkey % 9", "'https://example.org/rest/data/OECD.DCD.FSD,DSD_' || o_custkey || '@DF_' || o_orderkey || ',9.1/all?x=1'"),
    "'https://example.org/v2/OECD.DCD.FSD/DSD_' || o_custkey || '@DF_' || o_orderkey || '/2.' || o_orderkey % 9 || '/*?x=1'": ("'DSD_' || o_custkey || '@DF_' || o_orderkey", "'2.' || o_orderkey % 9", "'https://example.org/v2/OECD.DCD.FSD/DSD_' || o_custkey || '@DF_' || o_orderkey || '/9.1/*?x=1'"),
    "'https://example.org/' || o_orderkey": ("NULL", "NULL", "'https://example.org/' || o_orderkey"),
    "'https://example.org/rest/data/OTHER.AG,DF_' || o_custkey || ',1.' || o_orderkey % 9 || '/all'": ("NULL", "'1.' || o_orderkey % 9", "'https://example.org/rest/data/OTHER.AG,DF_' || o_custkey || ',9.1/all'"),
    "'https://example.org/v2/OTHER.AG/DF_' || o_custkey || '/3.' || o_orderkey % 9 || '/*'": ("NULL", "'3.' || o_orderkey % 9", "'https://example.org/v2/OTHER.AG/DF_' || o_custkey || '/9.1/*'"),
    "'https://example.org/v2/OECD.DCD.FSD/DF_' || o_custkey || '/1.3.' || o_orderkey % 9 || '/all'": ("'DF_' || o_custkey", "NULL", "'https://example.org/v2/OECD.DCD.FSD/DF_' || o_custkey || '/1.3.' || o_orderkey % 9 || '/all'"),
    "'https://example.org/rest/data/OECD.DCD.FSD,DF_' || o_custkey || ',1.' || o_orderkey % 9": ("'DF_' || o_custkey", "NULL", "'https://example.org/rest/data/OECD.DCD.FSD,DF_' || o_custkey || ',1.' || o_orderkey % 9"),
}


def by_address(*expressions: str) -> str:
    """The expression of each kind of address, dealt by the order's number."""
    return "CASE o_orderkey % 7 " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(expressions)) + " END"


@query(f"SELECT o_orderkey AS k, {by_address(*[x[0] for x in ADDRESSES.values()])} AS id, {by_address(*[x[1] for x in ADDRESSES.values()])} AS version, {by_address(*[x[2] for x in ADDRESSES.values()])} AS renewed FROM orders")
def address_parts(spark, d):
    n = table(spark, d, "orders").withColumn("u", F.expr(by_address(*ADDRESSES)))
    return n.select(F.col("o_orderkey").alias("k"), urls.dataflow_id(F.col("u")).alias("id"), urls.dataflow_version(F.col("u")).alias("version"), urls.with_version(F.col("u"), "9.1").alias("renewed"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'DSD_' || o_custkey END AS id FROM orders")
def flow_ids(spark, d):
    end = F.when(F.col("o_orderkey") % 2 == 0, "/").otherwise("/1.0/all")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), urls.flow_id(F.concat(F.lit("https://example.org/OECD.DCD.FSD/DSD_"), "o_custkey", end)).alias("id"))


@query("""SELECT o_orderkey AS k, 'https://sdmx.oecd.org/' || CASE WHEN o_orderkey % 4 = 0 THEN 'dcd-public/rest/data/OECD.DCD.FSD,DF_CRS' ELSE 'public/rest/data/OECD.DCD.FSD,DF' || o_custkey END || ',1.0/' || coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus || '..' END, 'all')
       || '?format=csvfilewithlabels' || coalesce('&startPeriod=' || CASE WHEN o_orderkey % 5 > 0 THEN 1990 + o_orderkey % 5 END, '') || coalesce('&endPeriod=' || CASE WHEN o_orderkey % 7 > 0 THEN 2000 + o_orderkey % 7 END, '') AS url,
       'https://sdmx.oecd.org/' || CASE WHEN o_orderkey % 4 = 0 THEN 'dcd-public/rest/data/OECD.DCD.FSD/DF_CRS' ELSE 'public/rest/v2/data/dataflow/OECD.DCD.FSD/DF' || o_custkey END || '/+/*?format=csv'
       || CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 THEN '&c[TIME_PERIOD]=ge:' || 1990 + o_orderkey % 5 || '+le:' || 2000 + o_orderkey % 7 WHEN o_orderkey % 5 > 0 THEN '&c[TIME_PERIOD]=ge:' || 1990 + o_orderkey % 5 WHEN o_orderkey % 7 > 0 THEN '&c[TIME_PERIOD]=ge:1950+le:' || 2000 + o_orderkey % 7 ELSE '' END
       || '&lastNObservations=3' AS newer FROM orders""")
def request_urls(spark, d):
    k = F.col("o_orderkey")
    flow = F.when(k % 4 == 0, "DF_CRS").otherwise(F.concat(F.lit("DF"), "o_custkey"))
    start, end = F.when(k % 5 > 0, 1990 + k % 5), F.when(k % 7 > 0, 2000 + k % 7)
    key = F.when(k % 3 > 0, F.concat("o_orderstatus", F.lit("..")))
    return table(spark, d, "orders").select(k.alias("k"), urls.request_url(flow, F.lit("1.0"), key, start, end).alias("url"), urls.request_url(flow, start=start, end=end, last=3, file_format="csv", api_version=2).alias("newer"))


@query("""SELECT c_custkey AS k, substr(sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}'), 1, 16) AS key FROM customer""")
def result_keys(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k"), sinks.key_column(["c_name", "c_custkey"]).alias("key"))


@query("SELECT lower(replace(replace(replace(c_name || ' A' || CASE WHEN c_custkey % 2 = 0 THEN '.txt' ELSE '.csv' END, '.txt', '.parquet'), '.csv', '.parquet'), ' ', '_')) AS name FROM customer")
def member_names(spark, d):
    return table(spark, d, "customer").select(sinks.clean_member(F.concat("c_name", F.lit(" A"), F.when(F.col("c_custkey") % 2 == 0, ".txt").otherwise(".csv"))).alias("name"))


@query("SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_casts(spark, d):
    raw = "Commitment Date (MM/DD/YYYY)"
    text = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "MM/dd/yyyy").alias(raw))
    return projections.cast_columns(text, "aiddata").withColumnRenamed(raw, "day")


#: The white space that a payload's ends lose, for SQL.
STRIPPED = " || ".join(f"chr({ord(c)})" for c in metadata.WHITE)


@query(f"SELECT doc_id, kind, contains(t, 'NoRecordsFound') OR contains(t, 'Could not find') OR (length(trim(t, {STRIPPED})) < 50 AND NOT starts_with(trim(t, {STRIPPED}), '\"') AND NOT contains(t, ',') AND NOT contains(t, chr(10))) AS bad FROM (SELECT doc_id, 'whole' AS kind, text AS t FROM documents UNION ALL SELECT doc_id, 'part', chr(9) || chr(12) || substr(text, 3, 46) || chr(160) || chr(8195) FROM documents UNION ALL SELECT doc_id, 'answer', 'Could not find Dataflow, or ' || text FROM documents)")
def error_payloads(spark, d):
    docs = table(spark, d, "documents")
    kind = lambda name, t: docs.select("doc_id", F.lit(name).alias("kind"), t.alias("t"))
    every = kind("whole", F.col("text")).union(kind("part", F.concat(F.lit("\t\f"), F.substring("text", 3, 46), F.lit("\xa0\u2003")))).union(kind("answer", F.concat(F.lit("Could not find Dataflow, or "), "text")))
    return every.select("doc_id", "kind", metadata.is_error_payload(F.col("t")).alias("bad"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS code, upper(substr(c_name, 10)) AS value FROM customer WHERE c_custkey % 3 > 0")
def codelist_source(spark, d):
    """Envelopes of a hundred codes each."""
    k, name = F.col("c_custkey"), F.upper(F.substring("c_name", 10, 99))
    item = F.struct(F.when(k % 3 > 0, "Active").otherwise("withdrawn").alias("status"), k.cast("string").alias("code"), F.when(k % 2 == 0, name).otherwise("").alias("dotstatcode"), name.alias("iso-alpha-3-code"))
    items = table(spark, d, "customer").groupBy(F.floor(k / 100)).agg(F.collect_list(item).alias("codelist-item"))
    raw = items.select(F.to_json(F.struct(F.struct(F.array(F.struct(F.struct("codelist-item").alias("codelist-items"))).alias("codelist")).alias("codelists"))).alias("value"))
    return metadata.codelist_items(raw)


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 > 0 THEN '1.' || o_custkey END AS version, CAST(4 + o_orderkey % 3 AS INT) AS dimensions, o_orderkey % 3 <> 1 AS changed FROM orders")
def structure_versions(spark, d):
    k = F.col("o_orderkey")
    flow = F.when(k % 4 > 0, F.concat(F.lit('<s:Dataflow id="a" version="1.'), "o_custkey", F.lit('"/>'))).otherwise("")
    xml = F.concat(F.lit('<s:Structure xmlns:s="urn:x">'), flow, F.expr("repeat('<s:Dimension/>', 4 + cast(o_orderkey % 3 as int))"), F.lit("<s:TimeDimension/></s:Structure>"))
    read = table(spark, d, "orders").withColumn("x", xml).select(k.alias("k"), metadata.dataflow_version(F.col("x")).alias("version"), metadata.dimension_count(F.col("x")).alias("dimensions"))
    return read.withColumn("changed", codes.dimensions_changed(F.col("dimensions"), "dac2a"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN 'id' || o_custkey END AS id FROM orders")
def bulk_file_ids(spark, d):
    label = F.when(F.col("o_orderkey") % 3 > 0, "Full set (x)|").otherwise("Other set|")
    text = F.concat(F.lit("<t>"), label, F.lit(" http://e.org/f?a=b&amp;id=id"), "o_custkey", F.lit(" </t>"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), metadata.bulk_file_id(text, "Full set (x)|").alias("id"))


# sources, sinks and streams, through a slice written and read again


@query(with_obs("SELECT DONOR, year, sum(OBS_VALUE) AS value FROM (SELECT DONOR, TIME_PERIOD AS year, OBS_VALUE FROM obs) WHERE year BETWEEN 1995 AND 1997 GROUP BY ALL"))
def lake_period(spark, d):
    path = scratch(spark)
    sinks.write_lake(obs(spark, d).withColumnRenamed("TIME_PERIOD", "year"), path)
    return readers.of_period(spark.read.parquet(path), "1995-97").groupBy("DONOR", "year").agg(F.sum("OBS_VALUE").alias("value"))


@query(with_obs("SELECT DONOR, MEASURE, count(*) AS n FROM obs GROUP BY ALL"))
def reduced_bulk(spark, d):
    path = scratch(spark)
    obs(spark, d).write.parquet(path)
    return readers.reduced(readers.read_bulk(spark, path), ["DONOR", "MEASURE", "absent"]).groupBy("DONOR", "MEASURE").agg(F.count("*").alias("n"))


@query("SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 5 > 0 THEN c_nationkey END AS nation, CAST(c_acctbal AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier")
def delimited_bulk(spark, d):
    """Members of two headers and delimiters, several files each."""
    path, nation = scratch(spark), F.col("c_nationkey").cast("string")
    members = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 5 > 0, nation).otherwise("NA").alias("nation"), F.col("c_acctbal").cast("double").alias("balance"))
    members.repartition(3).write.option("sep", "|").csv(f"{path}/a", header=True)
    table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")).repartition(2).write.csv(f"{path}/b", header=True)
    return readers.read_bulk(spark, path).select("k", "name", F.col("nation").cast("long").alias("nation"), "balance")


@query("SELECT event_type AS first, CASE WHEN event_id % 5 > 0 THEN upper(event_type) END AS second, count(*) AS n FROM events GROUP BY ALL")
def mangled_header(spark, d):
    """Files whose header repeats a name."""
    path, kind = scratch(spark), F.col("event_type")
    lines = table(spark, d, "events").select(F.concat_ws(",", "event_id", kind, F.when(F.col("event_id") % 5 > 0, F.upper(kind)).otherwise("_Z")).alias("value"))

    def headed(batches):
        for n, batch in enumerate(batches):
            if not n:
                yield pa.RecordBatch.from_arrays([pa.array(["ID,RMNCH,RMNCH"])], names=["value"])
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    lines.mapInArrow(headed, "value string").write.text(path)
    df, _ = readers.read_conformed(spark, path)
    return df.groupBy(F.col("RMNCH").alias("first"), F.col("`RMNCH.1`").alias("second")).agg(F.count("*").alias("n"))


@query(with_obs("SELECT part, DONOR, count(*) AS n FROM (SELECT 'full' AS part, DONOR FROM obs UNION ALL SELECT 'reduced', DONOR FROM obs UNION ALL SELECT 'period', DONOR FROM obs WHERE TIME_PERIOD BETWEEN 1993 AND 1995 UNION ALL SELECT 'dac2a', DONOR FROM obs WHERE UNIT_MEASURE = 'USD' UNION ALL SELECT 'multisystem', DONOR FROM obs WHERE MD_DIM = '_T') GROUP BY ALL"))
def bulk_entries(spark, d):
    root, o = scratch(spark), obs(spark, d)
    sinks.write_lake(o.withColumnRenamed("TIME_PERIOD", "year"), f"{root}/{readers.BULK['crs']}")
    o.select("DONOR", "RECIPIENT").write.parquet(f"{root}/{readers.BULK['crs_reduced']}")
    o.filter("UNIT_MEASURE = 'USD'").write.csv(f"{root}/{readers.BULK['dac2a']}", header=True)
    o.filter("MD_DIM = '_T'").write.parquet(f"{root}/{readers.BULK['multisystem']}")
    parts = {"full": readers.bulk_crs(spark, root), "reduced": readers.bulk_crs(spark, root, reduced_version=True), "period": readers.crs_file(spark, root, "1993-95"), "dac2a": readers.bulk_dac2a(spark, root), "multisystem": readers.bulk_multisystem(spark, root)}
    return codes.union_members([df.select(F.lit(name).alias("part"), "DONOR") for name, df in parts.items()]).groupBy("part", "DONOR").agg(F.count("*").alias("n"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS aiddata_id, CAST(year(o_orderdate) AS INT) AS commitment_year, CAST(o_orderdate AS DATE) AS commitment_date, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS TINYINT) AS covid FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997")
def project_table(spark, d):
    """The project table, read strictly, saved and read again."""
    root, flags = scratch(spark), [f.raw for f in spec_of("aiddata") if f.flag]
    said = F.when(F.col("o_orderkey") % 2 == 0, "Yes").otherwise("No")
    sheet = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("AidData Record ID"), F.year("o_orderdate").cast("string").alias("Commitment Year"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("Commitment Date (MM/DD/YYYY)"), *[said.alias(f) for f in flags])
    sheet.write.csv(f"{root}/sheet", header=True)
    datasets.read_aiddata(spark, f"{root}/sheet", 1995, 1997, save_to_path=f"{root}/saved")
    return spark.read.parquet(f"{root}/saved").select("aiddata_id", "commitment_year", "commitment_date", "covid")


@query("SELECT CAST(p_size AS INT) AS code, max(p_brand) AS value FROM part GROUP BY ALL")
def mapping_source(spark, d):
    """A mapping file of one object, with an entry that isn't a number."""
    path = scratch(spark)
    entries = F.sort_array(F.collect_list(F.struct(F.col("p_size").cast("string").alias("k"), "v")))  # a row a size
    sizes = table(spark, d, "part").groupBy("p_size").agg(F.max("p_brand").alias("v")).agg(entries.alias("e"))
    sizes.select(F.to_json(F.map_from_entries(F.concat("e", F.array(F.struct(F.lit("(.*)").alias("k"), F.lit("x").alias("v")))))).alias("value")).write.text(path)
    return metadata.read_mapping(spark, path).select("code", "value")


def zipped(spark, d) -> str:
    """Archives of the suppliers, one a nation, each with a delimited member; one in five is cut short."""
    root, suppliers = scratch(spark), table(spark, d, "supplier").select(F.col("s_nationkey").cast("int").alias("nation"), "s_suppkey", "s_name")

    def pack(key, rows):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("Full Data.txt", "k|name\n" + "".join(f"{a}|{b}\n" for a, b in zip(rows["s_suppkey"], rows["s_name"], strict=True)))
        data = held.getvalue()
        return pd.DataFrame({"nation": [key[0]], "content": [data[:-9] if key[0] % 5 == 4 else data]})

    made = suppliers.groupBy("nation").applyInPandas(pack, "nation int, content binary")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in made.toLocalIterator():  # an archive at a time
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{'cut' if r.nation % 5 == 4 else 'whole'}/n{r.nation}.zip")
        out = path.getFileSystem(conf).create(path)
        out.write(bytearray(r.content))
        out.close()
    return root


@query("SELECT 'n' || s_nationkey || '.zip' AS name, s_nationkey % 5 <> 4 AS ok FROM supplier GROUP BY ALL")
def audited_archives(spark, d):
    found = metadata.audit_archives(spark, f"{zipped(spark, d)}/*")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "ok")


@query("SELECT s_suppkey AS k, s_name AS name, 'n' || s_nationkey || '-full_data' AS member FROM supplier WHERE s_nationkey % 5 <> 4")
def landed_archives(spark, d):
    root = zipped(spark, d)
    path = metadata.land_archives(spark, f"{root}/whole", f"{root}/landed")
    df = readers.read_bulk(spark, path)
    return df.select("k", "name", F.regexp_extract(F.input_file_name(), "member=([^/]+)/", 1).alias("member"))


@query(with_obs("SELECT DONOR, TIME_PERIOD, count(*) AS n FROM obs WHERE PRICE_BASE = 'V' GROUP BY ALL"))
def labelled_csv(spark, d):
    path = scratch(spark)
    obs(spark, d).select("DONOR", "PRICE_BASE", "TIME_PERIOD", "OBS_VALUE").write.csv(path, header=True)
    df, _ = readers.read_conformed(spark, path)
    return df.filter(filters.one_of("PRICE_BASE", "V")).select("DONOR", F.col("TIME_PERIOD").cast("int").alias("TIME_PERIOD")).groupBy("DONOR", "TIME_PERIOD").agg(F.count("*").alias("n"))


@query(with_obs("SELECT DONOR, sum(OBS_VALUE) AS value FROM obs GROUP BY ALL"))
def kept_result(spark, d):
    root = scratch(spark)
    build = lambda: obs(spark, d).groupBy("DONOR").agg(F.sum("OBS_VALUE").alias("value"))
    sinks.materialize(spark, build, root, dataset="obs", by=["DONOR"])
    return sinks.materialize(spark, build, root, dataset="obs", by=["DONOR"])


@query(with_obs("SELECT DONOR, RECIPIENT, sum(OBS_VALUE) AS value FROM obs WHERE SECTOR LIKE '1%' GROUP BY ALL"))
def streamed_increments(spark, d):
    landing, target, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    obs(spark, d).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    append_increments(read_increments(spark, landing, schema), lambda df: df.filter(F.col("SECTOR").startswith("1")), target, checkpoint)
    return spark.read.schema(schema).parquet(target).groupBy("DONOR", "RECIPIENT").agg(F.sum("OBS_VALUE").alias("value"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE c_custkey % 5 WHEN 1 THEN '2 values of 3' WHEN 2 THEN '4 values for 3' END AS reason FROM customer) WHERE reason IS NOT NULL GROUP BY ALL")
def broken_records(spark, d):
    """Rows with too few and too many values beside whole ones with line ends and quotes in them."""
    path, k = scratch(spark), F.col("c_custkey").cast("string")
    quote = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    row = F.when(k % 5 == 0, F.concat_ws(",", k, quote(F.concat("c_name", F.lit("\nnext, line"))), k)).when(k % 5 == 1, F.concat_ws(",", k, "c_name")).when(k % 5 == 2, F.concat_ws(",", k, "c_name", k, k)).when(k % 5 == 3, F.concat_ws(",", k, quote(F.concat(F.lit('a ""b"" '), "c_name")), k)).otherwise(F.concat_ws(",", k, "c_name", F.lit("")))
    lines = table(spark, d, "customer").select(row.alias("value"))
    lines.repartitionByRange(3, "value").write.option("lineSep", "\n").text(f"{path}/bare")
    headed = spark.read.text(f"{path}/bare", wholetext=True).select(F.concat(F.lit("k,name,again\n"), "value").alias("value"))  # a file a row
    headed.write.option("lineSep", "\n").text(f"{path}/headed")
    return readers.broken_rows(spark, f"{path}/headed").groupBy("reason").agg(F.count("*").alias("n"))


@query(with_obs("SELECT * FROM folded", FOLD))
def streamed_fold(spark, d):
    """The fold of units over files that hold rows again, in two runs of a stream."""
    landing, target, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    rows = unfolded(spark, d)
    fold = lambda df: drop_repeated(codes.folded_units(df))
    for part in (rows.filter("TIME_PERIOD < 1996"), rows.filter("TIME_PERIOD > 1994")):
        part.write.mode("append").parquet(landing)
        append_increments(read_increments(spark, landing, rows.schema), fold, target, checkpoint)
    return spark.read.schema(fold(rows).schema).parquet(target)


@query(with_obs("SELECT DONOR, SECTOR, TIME_PERIOD, value FROM (SELECT *, row_number() OVER (PARTITION BY DONOR, SECTOR ORDER BY TIME_PERIOD DESC) AS k FROM (SELECT DONOR, SECTOR, TIME_PERIOD, sum(OBS_VALUE) AS value FROM obs GROUP BY ALL)) WHERE k <= 3"))
def streamed_last_years(spark, d):
    """The newest three years of each series as a stream's state, late years last."""
    landing, target, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    yearly = obs(spark, d).groupBy("DONOR", "SECTOR", "TIME_PERIOD").agg(F.sum("OBS_VALUE").alias("value"))
    for part in (yearly.filter("TIME_PERIOD % 2 = 0"), yearly.filter("TIME_PERIOD % 2 = 1")):
        part.write.mode("append").parquet(landing)
        keep_last(read_increments(spark, landing, yearly.schema), ["DONOR", "SECTOR"], 3, target, checkpoint)
    return read_last(spark, target, ["DONOR", "SECTOR"], yearly.schema)


@query(ORACLES["join_cubes"])
def join_bucketed_cubes(spark, d):
    """Two cubes landed in buckets of their keys, joined without a shuffle."""
    o, name = obs(spark, d).withColumnsRenamed({"DONOR": "donor_code", "TIME_PERIOD": "year"}), f"cube_{uuid.uuid4().hex}"
    totals = o.groupBy("donor_code", "year").agg(F.sum("OBS_VALUE").alias("total"))
    others = o.filter("PRICE_BASE = 'V'").groupBy("donor_code", "year").agg(F.count_distinct("RECIPIENT").alias("recipients"))
    for part, cube in (("a", totals), ("b", others)):
        sinks.write_bucketed(cube, f"{name}_{part}", scratch(spark), ["donor_code", "year"], 8)
    return codes.join_measures(spark.table(f"{name}_a"), spark.table(f"{name}_b"), ["donor_code", "year"])
