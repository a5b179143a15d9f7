"""Queries over several regions at once: region is a key of every metric, not a constant.

Regions are those of the region table; an account number is shared by two customers, often
of different regions, so it identifies a parcel only within its region. Each region has a
zip pattern of its own, and one keeps the parcels of one city only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.plans import metrics as M
from homestat.plans import proxies as P
from homestat.plans.queries import NOW_365, PRIOR_730, RECENT_180, register, sql_fixed_mean

BY = ("region",)
_PATTERN = {"AFRICA": "^[0-9]$", "ASIA": "^1[0-9]$"}


def region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region: its zip pattern and, for one, the only city."""
    pattern = F.when(F.col("r_name") == "AFRICA", _PATTERN["AFRICA"]).when(F.col("r_name") == "ASIA", _PATTERN["ASIA"]).otherwise(P.NUMERIC_ZIP)
    return P.table(spark, sf_dir, "region").select(F.col("r_name").alias("region"), pattern.alias("zip_pattern"),
                                                   F.when(F.col("r_name") == "EUROPE", " Building").alias("city"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = P.table(spark, sf_dir, "customer").join(P.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.join(P.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))


def regional_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir).select("c_custkey", F.col("r_name").alias("region"))
    o = P.table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    key = F.expr("o_custkey div 2")
    return o.select("region", key.alias("account"), key.alias("account_key"), F.col("o_orderdate").alias("sale_date"),
                    F.col("o_totalprice").alias("sale_price"), F.col("o_orderkey").alias("sale_id"))


def regional_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.expr("c_custkey div 2")
    p = _customers(spark, sf_dir).select(
        F.col("r_name").alias("region"), key.alias("account"), key.alias("account_key"), F.col("c_nationkey").cast("string").alias("zip"),
        F.col("c_acctbal").alias("living"), (F.col("c_custkey") % 97 * 1000).cast("double").alias("just"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", " X").alias("homestead"), F.col("c_mktsegment").alias("loccity"),
        F.col("c_custkey").cast("string").alias("locn"))
    return M.in_regions(p, region_table(spark, sf_dir), "loccity")


def _bundle(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return M.zip_metrics(regional_sales(spark, sf_dir), regional_parcels(spark, sf_dir), as_of=P.AS_OF, by=BY, scale=2, median_decimals=4)


_SQL = f"""
WITH cu AS (SELECT *, c_custkey // 2 AS account FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT r_name AS region, account, o_orderdate AS sale_date, o_totalprice AS price, o_orderkey AS sale_id FROM orders JOIN cu ON o_custkey = c_custkey),
p AS (SELECT r_name AS region, account, CAST(c_nationkey AS VARCHAR) AS zip, c_acctbal AS living, CAST(c_custkey % 97 * 1000 AS DOUBLE) AS just,
        c_mktsegment <> 'HOUSEHOLD' AS investor, c_custkey FROM cu WHERE r_name <> 'EUROPE' OR c_mktsegment = 'BUILDING'),
z AS (SELECT * FROM p WHERE regexp_matches(zip, CASE region WHEN 'AFRICA' THEN '{_PATTERN['AFRICA']}' WHEN 'ASIA' THEN '{_PATTERN['ASIA']}' ELSE '^[0-9]+$' END)),
j AS (SELECT z.*, price, sale_date >= {NOW_365} AS now FROM s JOIN z USING (region, account) WHERE sale_date >= {PRIOR_730})
"""

_TREND = _SQL + """, g AS (SELECT region, zip, round(median(price) FILTER (now), 4) AS price_now, count(*) FILTER (now) AS sales_volume,
                         round(median(price) FILTER (NOT now), 4) AS price_prior FROM j WHERE living > 0 GROUP BY ALL)
SELECT *, (price_now - price_prior) / price_prior AS yoy_change, sales_volume < 20 AS low_volume,
       zip || CASE WHEN sales_volume < 20 THEN '*' ELSE '' END AS zip_display,
       CASE WHEN abs((price_now - price_prior) / price_prior) > 0.40 THEN 'low_data' ELSE '' END AS yoy_flag
FROM g WHERE price_now IS NOT NULL AND price_prior IS NOT NULL"""
_RATIO = _SQL + "SELECT region, zip, round(median(price / just), 4) AS median_ratio FROM j WHERE now AND just > 0 GROUP BY ALL"
_VALUE = _SQL + f""", a AS (SELECT region, zip, {sql_fixed_mean('just')} AS avg_assessed FROM z WHERE living > 0 AND just > 0 GROUP BY ALL),
g AS (SELECT region, zip, round(median(price), 4) AS median_sale_price, count(*) AS sales_volume FROM j
      WHERE now AND living > 0 AND just > 0 GROUP BY ALL HAVING count(*) >= 20)
SELECT region, zip, median_sale_price, sales_volume, avg_assessed, median_sale_price / avg_assessed AS value_ratio FROM g JOIN a USING (region, zip)"""
_INVESTORS = _SQL + """SELECT region, zip, count(*) AS total_sales, CAST(sum(investor::INT) AS DOUBLE) / count(*) AS investor_share
FROM j WHERE now GROUP BY ALL"""
_FLIPS = _SQL + f""", bulk AS (SELECT region, sale_date, price FROM s GROUP BY ALL HAVING count(*) > 3),
k AS (SELECT s.* FROM s ANTI JOIN bulk USING (region, sale_date, price)),
f AS (SELECT region, account, sale_date AS first_sale_date, price AS first_sale_price, lead(sale_date) OVER w AS second_sale_date,
        lead(price) OVER w AS second_sale_price FROM k WINDOW w AS (PARTITION BY region, account ORDER BY sale_date, sale_id))
SELECT f.region, f.account, first_sale_date, first_sale_price, second_sale_date, second_sale_price,
       date_diff('day', first_sale_date, second_sale_date) AS days_held,
       CASE WHEN second_sale_price > first_sale_price THEN 'PROFITABLE' ELSE 'LOSS' END AS outcome, p.living AS sqft
FROM f LEFT JOIN p ON p.region = f.region AND p.account = f.account
WHERE date_diff('day', first_sale_date, second_sale_date) BETWEEN 120 AND 365 AND first_sale_price > 0
  AND (second_sale_price - first_sale_price) / first_sale_price >= -0.5 AND second_sale_date >= {RECENT_180}"""


@register("zip_price_trends_regions", _TREND)
def zip_price_trends_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6/J3 of all regions, from the joined base."""
    return _bundle(spark, sf_dir)["zip_price_trends"]


@register("assessment_ratio_regions", _RATIO)
def assessment_ratio_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7/J3 of all regions, from the joined base."""
    return _bundle(spark, sf_dir)["assessment_ratio"].drop("meaning")


@register("buyer_value_regions", _VALUE)
def buyer_value_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8/J3/J6 of all regions, from the joined base."""
    return _bundle(spark, sf_dir)["buyer_value_index"].drop("buyer_signal")


@register("investor_regions", _INVESTORS)
def investor_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10/J3 of all regions, from the joined base."""
    return _bundle(spark, sf_dir)["investor_activity"]


def _flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.resale_flips(regional_sales(spark, sf_dir), regional_parcels(spark, sf_dir), as_of=P.AS_OF, by=BY)


@register("flips_regions", _FLIPS)
def flips_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5/J4/J8/J11 of all regions: accounts and bulk transfers are those of a region."""
    return _flips(spark, sf_dir).select("region", "account", "first_sale_date", "first_sale_price", "second_sale_date",
                                        "second_sale_price", "days_held", "outcome", "sqft")


_COUNTED = {"zip_price_trends": _TREND, "assessment_ratio": _RATIO, "buyer_value_index": _VALUE, "investor_activity": _INVESTORS, "flip_detector": _FLIPS}


@register("run_history_regions", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS metric, region, count(*) AS n FROM ({q}) GROUP BY ALL" for k, q in _COUNTED.items()) + f"""),
m(metric) AS (VALUES {', '.join(f"('{k}')" for k in _COUNTED)}, ('flip_summary'))
SELECT d.run_date, r_name AS region, m.metric, coalesce(n, 0) AS n,
       CASE WHEN d.run_date = DATE '2001-01-08' AND r_name <> 'ASIA' THEN 0 END AS delta
FROM region JOIN (VALUES (DATE '2001-01-01'), (DATE '2001-01-08')) AS d(run_date) ON d.run_date = DATE '2001-01-01' OR r_name <> 'ASIA'
JOIN m ON true LEFT JOIN c ON c.metric = m.metric AND c.region = r_name""")
def run_history_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/W5/A8 by region: two runs, the second without one region and recorded region by region; counts and changes."""
    import datetime as dt

    from homestat.sources import history as H
    from homestat.sources.exports import scratch_path
    results = _bundle(spark, sf_dir) | {"flip_detector": _flips(spark, sf_dir), "flip_summary": "text"}
    regions, path = region_table(spark, sf_dir), scratch_path(spark, "history")
    counts = H.metric_counts(spark, results, P.AS_OF.date(), regions)
    H.record_run(counts, path)
    second = H.read_history(spark, path).withColumn("run_date", F.lit(dt.date(2001, 1, 8)))
    for region in ("AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"):  # runs of one region each leave the others' alone
        H.record_run(second.where(F.col("region") == region).checkpoint(), path)
    return H.metric_trend(H.read_history(spark, path)).drop("prev_n")
