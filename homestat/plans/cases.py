"""Queries whose data holds the unusual cases: sales without an account, times of day,
padded and text accounts, white space, groups without values, landed files of every
kind. The cases are derived from the driver's tables, by the same rule on both sides;
the SQL states what the survey asks for, not what the code does.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.plans import metrics as M
from homestat.plans import proxies as P
from homestat.plans.queries import NOW_365, ORACLE_SQL, QUERIES, RECENT_180, register, sql_money, sql_zip5

# ------------------------------------------------------------------ M5: flips

# Every tenth account is unknown, sales have a time of day, a third of the accounts is
# zero-padded in the parcels, and one of seven parcels is missing.
_CASE_SALES = """SELECT CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS account, o_orderkey AS sale_id,
  o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440) AS sale_date, o_totalprice AS sale_price FROM orders"""


def _case_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = P.table(spark, sf_dir, "orders")
    key = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string"))
    when = F.timestamp_add("MINUTE", (F.col("o_orderkey") % 1440).cast("int"), F.col("o_orderdate"))
    return o.select(key.alias("account"), key.alias("account_key"), when.alias("sale_date"),
                    F.col("o_totalprice").alias("sale_price"), F.col("o_orderkey").alias("sale_id"))


def _case_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homestat.functions.scalars import normalize_account
    c = P.table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0")
    key = F.col("c_custkey").cast("string")
    padded = F.when(F.col("c_custkey") % 3 == 0, F.lpad(key, 12, "0")).otherwise(key)
    return c.select(padded.alias("account"), normalize_account(padded).alias("account_key"), F.lit("12").alias("locn"),
                    F.lit("Main St").alias("locs"), F.lit("34231").alias("zip"), F.col("c_acctbal").alias("living"),
                    F.lit(3.0).alias("beds"))


FLIP_CASES_SQL = f"""
WITH s AS (SELECT * FROM ({_CASE_SALES}) WHERE account IS NOT NULL),
pr AS (SELECT account, sale_date AS first_sale_date, sale_price AS first_sale_price,
              lead(sale_date) OVER w AS second_sale_date, lead(sale_price) OVER w AS second_sale_price, lead(sale_id) OVER w AS next_id
       FROM s WINDOW w AS (PARTITION BY account ORDER BY sale_date, sale_id)),
f AS (SELECT *, date_sub('day', first_sale_date, second_sale_date) AS days_held FROM pr WHERE next_id IS NOT NULL)
SELECT CAST(f.account AS VARCHAR) AS account, first_sale_date, first_sale_price, second_sale_date, second_sale_price, days_held,
       second_sale_price - first_sale_price AS markup,
       (second_sale_price - first_sale_price) / first_sale_price AS markup_pct,
       CASE WHEN second_sale_price > first_sale_price THEN 'PROFITABLE' ELSE 'LOSS' END AS outcome,
       CASE WHEN c.c_custkey IS NULL THEN 'Address unavailable' ELSE '12 Main St, 34231' END AS address,
       CASE WHEN c.c_custkey IS NOT NULL THEN 3.0 END AS beds, c.c_acctbal AS sqft
FROM f LEFT JOIN customer c ON c.c_custkey = f.account AND c.c_custkey % 7 <> 0
WHERE days_held BETWEEN 120 AND 365 AND first_sale_price > 0
  AND (second_sale_price - first_sale_price) / first_sale_price >= -0.5 AND second_sale_date >= {RECENT_180}
"""


@register("flip_cases", FLIP_CASES_SQL)
def flip_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without account and with times of day, padded parcel keys, parcels missing."""
    return M.resale_flips(_case_sales(spark, sf_dir), _case_parcels(spark, sf_dir), as_of=P.AS_OF)


@register("report_flip_cases", f"""
WITH f AS ({FLIP_CASES_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY CAST(account AS BIGINT), first_sale_date, second_sale_date) AS position FROM f)
SELECT account, outcome, position, first_sale_price, {sql_money('first_sale_price')} AS first_price_text,
       {sql_money('second_sale_price')} AS second_price_text FROM r WHERE position <= 10
""")
def report_flip_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten flips of each outcome when accounts are text: in number order."""
    from homestat.plans.report import flip_section
    return flip_section(flip_cases(spark, sf_dir)).select("account", "outcome", "position", "first_sale_price",
                                                          "first_price_text", "second_price_text")


# ------------------------------------------------------------------ A2/A3, SC16, M7

@register("median_cases", """
SELECT o_orderpriority, median(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN o_totalprice END) AS m,
       count(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN o_totalprice END) AS n
FROM orders GROUP BY o_orderpriority
""")
def median_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/A3: groups that hold only NULLs keep their row, with count 0."""
    from homestat.operators.aggregates import group_median
    o = P.table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.when(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), F.col("o_totalprice")).alias("v"))
    return group_median(o, "o_orderpriority", "v", out="m", count_out="n")


@register("median_whole_table", "SELECT median(o_totalprice) AS m, count(o_totalprice) AS n FROM orders")
def median_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the whole table as one group, read off a bracket of approximate quantiles."""
    from homestat.operators.aggregates import group_median
    return group_median(P.table(spark, sf_dir, "orders"), None, "o_totalprice", out="m", count_out="n")


@register("investor_cases", f"""
WITH p AS (SELECT c_custkey AS account_key, {sql_zip5('c_nationkey')} AS zip, c_mktsegment = 'HOUSEHOLD' AS homestead FROM customer),
s AS (SELECT o_custkey AS account_key FROM orders WHERE o_orderdate >= {NOW_365})
SELECT zip, count(*) AS total_sales, avg(CASE WHEN homestead THEN 0.0 ELSE 1.0 END) AS investor_share
FROM s JOIN p USING (account_key) GROUP BY zip
""")
def investor_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC16/M10: homestead marks with white space of every kind around them."""
    parcels = P.customer_parcels(spark, sf_dir)
    pad = F.when(F.col("account") % 2 == 0, F.concat(F.lit("\t"), F.col("homestead"), F.lit(" \n"))).otherwise(F.col("homestead"))
    return M.investor_activity(P.orders_sales(spark, sf_dir), parcels.withColumn("homestead", pad), as_of=P.AS_OF,
                               zip_pattern=P.NUMERIC_ZIP)


# Prices from -10 to far above zero, sizes and assessed values of zero, text zips, few sales:
# each filter of the metric removes rows.
_MIXED_PARCELS = """SELECT c_custkey AS account_key, CASE WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE CAST(34200 + c_nationkey AS VARCHAR) || '-0001' END AS zip,
  CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE c_custkey % 4000 END AS living,
  CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 1000 + c_custkey % 97 * 1000 END AS just FROM customer"""


def _mixed_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return P.table(spark, sf_dir, "customer").select(
        k.alias("account"), k.alias("account_key"),
        F.when(k % 5 == 0, "n/a").otherwise(F.concat((F.lit(34200) + F.col("c_nationkey")).cast("string"), F.lit("-0001"))).alias("zip"),
        F.when(k % 11 == 0, 0).otherwise(k % 4000).cast("double").alias("living"),
        F.when(k % 13 == 0, 0).otherwise(1000 + k % 97 * 1000).cast("double").alias("just"))


@register("buyer_value_cases", f"""
WITH p AS (SELECT account_key, substr(zip, 1, 5) AS zip, just FROM ({_MIXED_PARCELS}) WHERE living > 0 AND just > 0 AND zip <> 'n/a'),
av AS (SELECT zip, sum(just) / count(just) AS avg_assessed FROM p GROUP BY zip),
g AS (SELECT zip, round(median(o_totalprice), 4) AS median_sale_price, count(*) AS sales_volume
      FROM orders JOIN p ON o_custkey = account_key WHERE o_orderdate >= {NOW_365} GROUP BY zip HAVING count(*) >= 20)
SELECT zip, median_sale_price, sales_volume, avg_assessed FROM g JOIN av USING (zip)
""")
def buyer_value_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels without size, value or a real zip, zips with few sales."""
    out = M.buyer_value_index(P.orders_sales(spark, sf_dir), _mixed_parcels(spark, sf_dir), as_of=P.AS_OF, scale=2, median_decimals=4)
    return out.select("zip", "median_sale_price", "sales_volume", "avg_assessed")


# ------------------------------------------------------------------ S2, S3, S5, F3, K1, K4, P3, SC7, SC18, SC19

@register("weekly_mixed_scan", """
SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period_end, CAST(sum(CAST(o_totalprice * 100 AS BIGINT)) AS DOUBLE) / 100 AS median_price
FROM orders GROUP BY 1
""")
def weekly_mixed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crosstabs with quoted numbers, one half in UTF-8 and one in UTF-16, read together."""
    from homestat.sources import exports as X
    from homestat.sources.readers import read_weekly_detect
    o = P.table(spark, sf_dir, "orders").groupBy(F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 6).alias("d")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    text = o.select(X.us_date_text("d").alias("Period End"), F.format_number(F.col("cents") / 100, 2).alias("Median Sale Price"))
    even = F.dayofyear(F.to_date("Period End", "M/d/yyyy")) % 2 == 0
    path = X.scratch_path(spark, "mixed")
    X.write_weekly_csv(text.where(even), f"{path}/a")
    X.write_weekly_csv(text.where(~even), f"{path}/b", encoding="UTF-16")
    return read_weekly_detect(spark, [f"{path}/a/*.csv", f"{path}/b/*.csv"]).select("period_end", "median_price")


@register("sales_export_scan", """
SELECT CASE WHEN o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS account_key, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS sale_date,
       o_totalprice AS sale_price FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def sales_export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3/SC7/M13: deeds as a county file, dates in three spellings and some unreadable; warranty deeds only."""
    from homestat.sources import exports as X
    from homestat.sources.readers import clean_sales, read_county
    o, key = P.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    day = (F.when(key % 9 == 0, "unknown").when(key % 3 == 1, F.date_format("o_orderdate", "M/d/yyyy"))
           .when(key % 3 == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "M/d/yyyy 0:00")))
    raw = o.select(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("Account"), day.alias("SaleDate"),
                   F.col("o_totalprice").cast("string").alias("SalePrice"),
                   F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "WD").otherwise("QC").alias("DeedType"), key.alias("Id"))
    path = X.scratch_path(spark, "sales")
    X.write_county_csv(raw, path)
    sales = clean_sales(read_county(spark, path))
    return sales.select("account_key", F.col("sale_date").cast("timestamp_ntz").alias("sale_date"), "sale_price")


_FILES = ["Median_Sale_Price.csv", "homes sold (2).csv", "NEW_LISTINGS.csv", "days to close.csv", "months of supply.csv",
          "avg sale to list.csv", "notes.csv"]


@register("file_discovery", f"""
WITH files AS (SELECT {_FILES!r}[o_orderkey % 7 + 1] AS name, o_orderkey, o_orderdate FROM orders),
keyed AS (SELECT *, CASE name WHEN 'Median_Sale_Price.csv' THEN 'median_sale_price' WHEN 'homes sold (2).csv' THEN 'homes_sold'
            WHEN 'NEW_LISTINGS.csv' THEN 'new_listings' WHEN 'days to close.csv' THEN 'days_to_close'
            WHEN 'months of supply.csv' THEN 'weeks_of_supply' WHEN 'avg sale to list.csv' THEN 'avg_sale_to_list' END AS key FROM files)
SELECT key, CAST(o_orderkey AS VARCHAR) || '/' || name AS path, (SELECT count(DISTINCT key) FROM keyed WHERE key IS NOT NULL
       AND o_orderdate >= {NOW_365}) = 6 AS complete
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) || '/' || name) AS rn
      FROM keyed WHERE key IS NOT NULL AND o_orderdate >= {NOW_365}) WHERE rn = 1
""")
def file_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5/F18/SC19: the newest file of every kind that is not too old, from a long listing."""
    from homestat.sources.readers import discover
    o, key = P.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    name = F.element_at(F.array(*map(F.lit, _FILES)), (key % 7 + 1).cast("int"))
    files = o.select(F.concat(key.cast("string"), F.lit("/"), name).alias("path"), name.alias("name"),
                     F.col("o_orderdate").cast("timestamp").alias("modificationTime"), F.lit(1).alias("length"))
    return discover(files, P.AS_OF, max_age_days=365).select("key", "path", "complete")


@register("table_sink", "SELECT c_mktsegment AS region, c_custkey, c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_acctbal FROM customer")
def table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a table written by region, one region of it replaced, read back."""
    from homestat.sources.exports import scratch_path
    from homestat.sources.readers import write_table
    c = P.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("region"), "c_custkey", "c_acctbal")
    path = scratch_path(spark, "table")
    write_table(c, path)
    write_table(c.where("region = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 1), path)
    return spark.read.parquet(path).select("region", "c_custkey", "c_acctbal")


@register("section_archive", """SELECT CAST(run_date AS DATE) AS run_date, o_orderpriority, n FROM
  (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1), (VALUES ('2001-01-01'), ('2001-01-08')) AS r(run_date)""")
def section_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: a section archived by two runs, the second one twice."""
    from homestat.sources.exports import scratch_path
    from homestat.sources.readers import archive_sections
    section = P.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    root = scratch_path(spark, "sections")
    for day in (1, 8, 8):
        archive_sections({"priority": section}, root, dt.date(2001, 1, day))
    return spark.read.parquet(f"{root}/priority").select("run_date", "o_orderpriority", "n")


@register("stem_dates", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS run_date FROM orders""")
def stem_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC18: the date in a file stem; other stems have none."""
    from homestat.functions.scalars import stem_date
    day, key = F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderkey")
    stem = F.when(key % 3 == 0, F.concat(F.lit("history_"), day)).when(key % 3 == 1, day).otherwise(F.concat(F.lit("latest"), day, F.lit("x")))
    return P.table(spark, sf_dir, "orders").select("o_orderkey", stem_date(stem).alias("run_date"))


@register("default_column", "SELECT o_orderkey, 0.0::DOUBLE AS price_yoy, o_totalprice FROM orders")
def default_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is missing gets its default, one that is there stays."""
    from homestat.operators.relational import with_default
    o = P.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return with_default(with_default(o, "price_yoy", 0.0, "double"), "o_totalprice", 1.0, "double")


# ------------------------------------------------------------------ M12, K2, L16

_COUNT = lambda name, sql: f"SELECT '{name}' AS metric, count(*) AS n FROM ({sql})"
_NOW_ZIPS = f"""SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= {NOW_365}"""


@register("run_all_counts", "SELECT * FROM (" + " UNION ALL ".join([
    _COUNT("price_pressure", ORACLE_SQL["price_pressure"]), _COUNT("inventory_absorption", ORACLE_SQL["inventory_absorption"]),
    _COUNT("trend_lines", ORACLE_SQL["trend_lines"]), _COUNT("zip_price_trends", ORACLE_SQL["zip_price_trends"]),
    _COUNT("assessment_ratio", f"SELECT DISTINCT c_nationkey FROM ({_NOW_ZIPS} AND c_acctbal > 0)"),
    _COUNT("buyer_value_index", f"SELECT c_nationkey FROM ({_NOW_ZIPS} AND c_acctbal > 0) GROUP BY 1 HAVING count(*) >= 20"),
    _COUNT("investor_activity", f"SELECT DISTINCT c_nationkey FROM ({_NOW_ZIPS})"),
    _COUNT("flip_detector", ORACLE_SQL["resale_flips"].replace(" WHERE o_totalprice > 10000.0", "")),
    "SELECT 'flip_summary', 0", "SELECT 'market_snapshot', 0"]) + ")")
def run_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics of one run from one set of sources, counted as the run record does."""
    from homestat.sources.history import run_counts
    price, ratio = P.weekly_price_series(spark, sf_dir)
    supply, listings, sold = P.daily_event_series(spark, sf_dir)
    value = P.value_index_wide(spark, sf_dir, latest=6)
    sources = {"sales": P.orders_sales(spark, sf_dir), "parcels": P.customer_parcels(spark, sf_dir), "price": price, "ratio": ratio,
               "supply": supply, "listings": listings, "sold": sold, "value_wide": value,
               "rent_wide": P.rent_index_wide(spark, sf_dir, M.date_columns(value))}
    results = M.run_metrics(sources, as_of=P.AS_OF, region=P.REGION, zip_pattern=P.NUMERIC_ZIP, min_sale_price=-1e9)
    return run_counts(spark, results, P.AS_OF.date()).select("metric", "n")


# ------------------------------------------------------------------ regions

@register("price_pressure_regions", """
WITH s AS (SELECT r_name AS region, CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS week, o_totalprice, o_orderstatus
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
w AS (SELECT region, week, round(median(o_totalprice), 4) AS median_price, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS sale_to_list
      FROM s GROUP BY 1, 2),
l AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY week DESC) AS rn FROM w)
SELECT region, week, median_price, sale_to_list,
       median_price / lag(median_price) OVER (PARTITION BY region ORDER BY week) - 1 AS price_delta FROM l WHERE rn <= 4
""")
def price_pressure_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1/O1/W1 over five regions at once."""
    from homestat.operators.aggregates import group_median
    j = reduce(lambda a, b: a.join(b[0], b[1]), [
        (P.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")),
        (P.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")),
        (P.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))], P.table(spark, sf_dir, "orders"))
    s = j.select(F.col("r_name").alias("region"), F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 6).alias("period_end"),
                 "o_totalprice", "o_orderstatus")
    keys = ["region", "period_end"]
    price = group_median(s, keys, "o_totalprice", out="median_price").withColumn("median_price", F.round("median_price", 4))
    ratio = s.groupBy(*keys).agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("sale_to_list"))
    return M.price_pressure(price, ratio).select("region", "week", "median_price", "sale_to_list", "price_delta")


CASES = [n for n, f in QUERIES.items() if f.__module__ == __name__]
