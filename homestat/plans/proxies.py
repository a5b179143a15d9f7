"""Projections of the driver's star-schema tables onto the metric vocabulary.

The metrics read sales, parcels and weekly/monthly series. The test tables hold
orders, line items, customers, parts and events, so each metric runs on a
column mapping (a select; Catalyst prunes everything else at the scan):

* orders as sales:     account = o_custkey, date = o_orderdate, price = o_totalprice,
                       tie-breaker = o_orderkey
* customer as parcels: account = c_custkey, zip = c_nationkey, living = c_acctbal,
                       homestead 'X' = HOUSEHOLD segment, address = key / name / segment
* lineitem as sales:   account = l_partkey, date = l_shipdate,
                       price = l_extendedprice / (l_quantity * PRICE_SCALE)
* part as parcels:     account = p_partkey, zip = brand number, living = p_size,
                       just = p_retailprice
* weekly series:       orders per week (median price, fulfilled share);
                       events per day (views = supply, signups = listings, purchases = sold)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping.
AS_OF = dt.datetime(2001, 1, 1)
EVENTS_AS_OF = dt.datetime(2024, 1, 30)
PRICE_SCALE = 2.2
NUMERIC_ZIP = r"^[0-9]+$"
REGION = "ALL"
CITY = "Springfield"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("account"), F.col("o_custkey").alias("account_key"),
                    F.col("o_orderdate").alias("sale_date"), F.col("o_totalprice").alias("sale_price"),
                    F.col("o_orderkey").alias("sale_id"))


def customer_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("account"), F.col("c_custkey").alias("account_key"),
                    F.col("c_nationkey").cast("string").alias("zip"),
                    F.col("c_acctbal").alias("living"), F.col("c_acctbal").alias("just"),
                    F.col("c_nationkey").cast("double").alias("beds"),
                    F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("X")).alias("homestead"),
                    F.col("c_custkey").cast("string").alias("locn"), F.col("c_name").alias("locs"),
                    F.col("c_mktsegment").alias("locd"), F.lit(None).cast("string").alias("unit"))


def lineitem_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("account"), F.col("l_partkey").alias("account_key"),
                     F.col("l_shipdate").alias("sale_date"),
                     (F.col("l_extendedprice") / (F.col("l_quantity") * F.lit(PRICE_SCALE))).alias("sale_price"))


def part_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("account"), F.col("p_partkey").alias("account_key"),
                    F.substring_index(F.col("p_brand"), "#", -1).alias("zip"),
                    F.col("p_size").cast("double").alias("living"), F.col("p_retailprice").alias("just"))


# ------------------------------------------------------------------ series

def weekly_price_series(spark: SparkSession, sf_dir: str, *, median_decimals: int = 4):
    """(price_df, ratio_df) per week ending Sunday: median order price with its
    change vs 52 weeks earlier, and the share of fulfilled orders."""
    from homestat.operators.aggregates import group_median

    o = table(spark, sf_dir, "orders").select(
        F.lit(REGION).alias("region"),
        F.date_add(F.to_date(F.date_trunc("week", F.col("o_orderdate"))), 6).alias("period_end"),
        F.col("o_totalprice"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0)).alias("_fulfilled"))
    med = group_median(o, ["region", "period_end"], "o_totalprice", out="median_price")
    med = med.withColumn("median_price", F.round("median_price", median_decimals))
    prev = med.select("region", F.date_add("period_end", 364).alias("period_end"),
                      F.col("median_price").alias("_prev"))
    price = med.join(prev, ["region", "period_end"], "left").select(
        "region", "period_end", "median_price",
        (F.try_divide(F.col("median_price"), F.col("_prev")) - F.lit(1.0)).alias("price_yoy"))
    ratio = o.groupBy("region", "period_end").agg(F.avg("_fulfilled").alias("sale_to_list"))
    return price, ratio


def daily_event_series(spark: SparkSession, sf_dir: str, *, yoy_lag_days: int = 7):
    """(supply, listings, sold) per day from one aggregation of `events`:
    views = supply (with its change vs `yoy_lag_days` earlier), signups = new
    listings, purchases = homes sold."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "signup", "purchase"))
    daily = ev.groupBy(F.lit(REGION).alias("region"), F.to_date("ts").alias("period_end"), "event_type") \
        .agg(F.count(F.lit(1)).alias("n"))
    pick = lambda t, name: daily.where(F.col("event_type") == t).select(
        "region", "period_end", F.col("n").alias(name))
    supply = pick("view", "supply")
    prev = supply.select("region", F.date_add("period_end", yoy_lag_days).alias("period_end"),
                         F.col("supply").alias("_prev"))
    supply = supply.join(prev, ["region", "period_end"], "left").select(
        "region", "period_end", "supply", (F.col("supply") - F.col("_prev")).alias("supply_yoy_abs"))
    return supply, pick("signup", "new_listings"), pick("purchase", "homes_sold")


def _month_end_text(c):
    return F.date_format(F.last_day(c), "yyyy-MM-dd")


def month_values(df, column: str = "_month") -> list[str]:
    """Distinct month-end names of a raw scan (a small aggregate: one row per month).

    Handing them to `pivot` saves Spark from running the whole upstream plan just
    to discover the column names."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def monthly_wide(long_df, value: str, months: list[str], ids=("region",)):
    """Long (ids, _month, value) -> one row per id with a column per month end."""
    return long_df.groupBy(*list(ids)).pivot("_month", months).agg(F.first(value))


def _orders_by_month(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "orders").select(F.lit(REGION).alias("region"),
                                                 _month_end_text(F.col("o_orderdate")).alias("_month"),
                                                 "o_orderdate", "o_totalprice")


def _lines_by_month(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "lineitem").select(F.lit(REGION).alias("region"),
                                                   _month_end_text(F.col("l_shipdate")).alias("_month"),
                                                   "l_shipdate", "l_extendedprice")


def _month_start(ts) -> dt.datetime:
    return dt.datetime(ts.year, ts.month, 1)


def newest_month_start(df: DataFrame, column: str) -> dt.datetime | None:
    """First day of the month of the newest value (one scalar to the driver).

    Used as a literal lower bound, it reaches the Parquet scan as a pushed filter,
    so later passes read only the newest month's row groups."""
    top = df.agg(F.max(column)).first()[0]
    return None if top is None else _month_start(top)


def value_index_wide(spark: SparkSession, sf_dir: str, *, median_decimals: int = 4, latest: int | None = None):
    """Monthly median order price as a wide index table (one column per month end).

    `latest` builds only the newest N month columns (all a trend needs): the month
    list comes from a cheap distinct over the scan and the date range becomes a
    pushed filter, so medians run only over those months."""
    from homestat.operators.aggregates import group_median

    o = _orders_by_month(spark, sf_dir)
    months = month_values(o)
    if latest is not None:
        months = months[-latest:]
        o = o.where(F.col("o_orderdate") >= F.lit(months[0][:8] + "01").cast("timestamp_ntz")) if months else o
    med = group_median(o, ["region", "_month"], "o_totalprice", out="v")
    return monthly_wide(med.withColumn("v", F.round("v", median_decimals)), "v", months)


def rent_series_long(spark: SparkSession, sf_dir: str, *, median_decimals: int = 4, months: list[str] | None = None):
    """Monthly 'rent': median line price / 12, long (region, _month, v)."""
    from homestat.operators.aggregates import group_median

    li = _lines_by_month(spark, sf_dir)
    if months:
        lo = F.lit(min(months)[:8] + "01").cast("timestamp_ntz")
        hi = F.lit(max(months) + " 23:59:59.999999").cast("timestamp_ntz")
        li = li.where((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") <= hi))
    med = group_median(li, ["region", "_month"], "l_extendedprice", out="v")
    return med.select("region", "_month", (F.round("v", median_decimals) / F.lit(12.0)).alias("v"))


def rent_index_wide(spark: SparkSession, sf_dir: str, months: list[str] | None = None):
    """Wide monthly rent table; `months` limits it to those month columns."""
    cols = months if months is not None else month_values(_lines_by_month(spark, sf_dir))
    return monthly_wide(rent_series_long(spark, sf_dir, months=months), "v", cols)


def latest_rent(spark: SparkSession, sf_dir: str, *, median_decimals: int = 4):
    """Rent of the newest month (one row): the newest ship date is fetched as a
    scalar first, so the median pass reads only that month (pushed filter)."""
    from homestat.operators.aggregates import group_median

    li = _lines_by_month(spark, sf_dir)
    start = newest_month_start(li, "l_shipdate")
    if start is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    med = group_median(li, [], "l_extendedprice", out="v")
    return med.select((F.round("v", median_decimals) / F.lit(12.0)).alias("rent"))


def unit_value_by_zip(spark: SparkSession, sf_dir: str, *, median_decimals: int = 9, newest_only: bool = False):
    """Monthly median unit price per brand number, long (zip, month, value).

    `newest_only` keeps just the newest month (what an appraisal gap reads); the
    bound is a pushed scan filter."""
    from homestat.operators.aggregates import group_median

    li = lineitem_sales(spark, sf_dir)
    parts = part_parcels(spark, sf_dir).select("account_key", "zip")
    if newest_only:  # the newest month that the joined table has
        start = newest_month_start(li.join(parts, "account_key"), "sale_date")
        if start is not None:
            li = li.where(F.col("sale_date") >= F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    li = li.select("account_key", F.last_day("sale_date").alias("month"), "sale_price")
    j = li.join(parts, "account_key")
    med = group_median(j, ["zip", "month"], "sale_price", out="value")
    return med.withColumn("value", F.round("value", median_decimals))
