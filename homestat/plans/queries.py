"""Registered queries (one per operator / metric) and their oracle SQL.

Each query is `(spark, sf_dir) -> DataFrame` over the whole driver tables; the
matching SQL runs in DuckDB over the same parquet files (tables registered as
views) and must return the same rows, columns and values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.plans import metrics as M
from homestat.plans import proxies as P

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# cut-offs relative to P.AS_OF (2001-01-01)
NOW_365 = "TIMESTAMP '2000-01-02 00:00:00'"
PRIOR_730 = "TIMESTAMP '1999-01-02 00:00:00'"
RECENT_180 = "TIMESTAMP '2000-07-05 00:00:00'"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ M6

@register("zip_price_trends", f"""
WITH p AS (SELECT c_custkey AS account_key, substr(trim(CAST(c_nationkey AS VARCHAR)), 1, 5) AS zip
           FROM customer WHERE c_acctbal > 0),
s AS (SELECT o_custkey AS account_key, o_totalprice AS sale_price,
             CASE WHEN o_orderdate >= {NOW_365} THEN 'now'
                  WHEN o_orderdate >= {PRIOR_730} AND o_orderdate < {NOW_365} THEN 'prior' END AS period
      FROM orders),
m AS (SELECT zip, period, sale_price FROM s JOIN p USING (account_key)
      WHERE period IS NOT NULL AND regexp_matches(zip, '^[0-9]+$')),
g AS (SELECT zip, period, round(median(sale_price), 4) AS med, count(sale_price) AS n FROM m GROUP BY zip, period),
z AS (SELECT zip, max(CASE WHEN period = 'now' THEN med END) AS price_now,
             max(CASE WHEN period = 'now' THEN n END) AS sales_volume,
             max(CASE WHEN period = 'prior' THEN med END) AS price_prior
      FROM g GROUP BY zip
      HAVING count(*) FILTER (WHERE period = 'now') > 0 AND count(*) FILTER (WHERE period = 'prior') > 0)
SELECT zip, price_now, sales_volume, price_prior, (price_now - price_prior) / price_prior AS yoy_change,
       sales_volume < 20 AS low_volume,
       CASE WHEN sales_volume < 20 THEN zip || '*' ELSE zip END AS zip_display,
       CASE WHEN abs((price_now - price_prior) / price_prior) > 0.40 THEN 'low_data' ELSE '' END AS yoy_flag
FROM z
""")
def zip_price_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.trailing_year_trend(P.orders_sales(spark, sf_dir), P.customer_parcels(spark, sf_dir),
                                 as_of=P.AS_OF, zip_pattern=P.NUMERIC_ZIP, median_decimals=4)


# ------------------------------------------------------------------ SQL helpers
# Oracle spellings of the library's formatting / coercion rules.

def sql_money(x: str) -> str:
    return f"'$' || format('{{:,.0f}}', {x})"


def sql_fixed(x: str, decimals: int, signed: bool = False) -> str:
    n = f"CAST(floor(abs({x}) * {float(10 ** decimals)} + 0.5) AS BIGINT)"
    if decimals:
        scale = 10 ** decimals
        body = f"(CAST({n} // {scale} AS VARCHAR) || '.' || lpad(CAST({n} % {scale} AS VARCHAR), {decimals}, '0'))"
    else:
        body = f"CAST({n} AS VARCHAR)"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '{'+' if signed else ''}' END"
    return f"CASE WHEN {x} IS NOT NULL THEN {sign} || {body} END"


def sql_pct(x: str, decimals: int = 1, signed: bool = False) -> str:
    return f"({sql_fixed(f'(({x}) * 100.0)', decimals, signed)} || '%')"


def sql_fixed_mean(x: str, scale: int = 2) -> str:
    units = f"CAST(round(({x}) * {float(10 ** scale)}) AS BIGINT)"
    return (f"CASE WHEN count({units}) > 0 THEN CAST(sum({units}) AS DOUBLE) / "
            f"(CAST(count({units}) AS DOUBLE) * {float(10 ** scale)}) END")


def sql_number(x: str) -> str:
    t = f"regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"
    return (f"CASE WHEN regexp_matches({t}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
            f"THEN TRY_CAST({t} AS DOUBLE) END")


def sql_zip5(x: str) -> str:
    return f"substr(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g'), 1, 5)"


BRAND_NO = "regexp_extract(p_brand, '([^#]*)$', 1)"
UNIT_PRICE = "l_extendedprice / (l_quantity * 2.2::DOUBLE)"


# ------------------------------------------------------------------ M5 + bulk filter

def _flip_sales(spark, sf_dir):
    return P.orders_sales(spark, sf_dir).where(F.col("sale_price") > F.lit(10000.0))


SQL_ADDRESS = f"""
SELECT c_custkey AS account_key, CAST(c_nationkey AS DOUBLE) AS beds, c_acctbal AS sqft,
  regexp_replace(
    concat_ws(' ', nullif(regexp_replace(replace(CAST(c_custkey AS VARCHAR), '.0', ''), '^\\s+|\\s+$', '', 'g'), ''),
                   nullif(regexp_replace(c_name, '^\\s+|\\s+$', '', 'g'), ''),
                   nullif(regexp_replace(c_mktsegment, '^\\s+|\\s+$', '', 'g'), ''))
    || ', ' || concat_ws(' ', '{P.CITY}', nullif({sql_zip5('c_nationkey')}, '')),
    '^[, ]+|[, ]+$', '', 'g') AS address
FROM customer"""


@register("resale_flips", f"""
WITH s AS (SELECT o_custkey AS account, o_orderkey AS sale_id, o_orderdate AS sale_date, o_totalprice AS sale_price
           FROM orders WHERE o_totalprice > 10000.0),
bulk AS (SELECT sale_date, sale_price FROM s WHERE sale_date IS NOT NULL AND sale_price IS NOT NULL
         GROUP BY sale_date, sale_price HAVING count(*) > 3),
k AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM bulk b WHERE b.sale_date = s.sale_date AND b.sale_price = s.sale_price)),
pr AS (SELECT account, sale_date AS first_sale_date, sale_price AS first_sale_price,
              lead(sale_date) OVER w AS second_sale_date, lead(sale_price) OVER w AS second_sale_price,
              lead(sale_id) OVER w AS next_id
       FROM k WINDOW w AS (PARTITION BY account ORDER BY sale_date ASC NULLS LAST, sale_id)),
f AS (SELECT *, date_diff('day', first_sale_date, second_sale_date) AS days_held FROM pr WHERE next_id IS NOT NULL),
a AS ({SQL_ADDRESS})
SELECT f.account, first_sale_date, first_sale_price, second_sale_date, second_sale_price, days_held,
       second_sale_price - first_sale_price AS markup,
       (second_sale_price - first_sale_price) / first_sale_price AS markup_pct,
       CASE WHEN second_sale_price > first_sale_price THEN 'PROFITABLE' ELSE 'LOSS' END AS outcome,
       coalesce(a.address, 'Address unavailable') AS address, a.beds, a.sqft
FROM f LEFT JOIN a ON a.account_key = f.account
WHERE days_held BETWEEN 120 AND 365 AND first_sale_price > 0
  AND (second_sale_price - first_sale_price) / first_sale_price >= -0.5
  AND second_sale_date >= {RECENT_180}
""")
def resale_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.resale_flips(_flip_sales(spark, sf_dir), P.customer_parcels(spark, sf_dir),
                          as_of=P.AS_OF, city=P.CITY)


BULK_KEYS_SQL = """SELECT o_orderdate, o_orderpriority, count(*) AS n FROM orders
  WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL
  GROUP BY o_orderdate, o_orderpriority HAVING count(*) > 3"""


@register("bulk_transfer_filter", f"""
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM ({BULK_KEYS_SQL}) b
                  WHERE b.o_orderdate = o.o_orderdate AND b.o_orderpriority = o.o_orderpriority)
""")
def bulk_transfer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homestat.operators.relational import drop_bulk
    o = P.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                                "o_totalprice")
    return drop_bulk(o, ["o_orderdate", "o_orderpriority"], threshold=3)


@register("bulk_transfer_keys", BULK_KEYS_SQL)
def bulk_transfer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homestat.operators.relational import bulk_keys
    o = P.table(spark, sf_dir, "orders")
    return bulk_keys(o, ["o_orderdate", "o_orderpriority"], threshold=3)


# ------------------------------------------------------------------ M7, M8, M10

def _meaning_sql(x: str) -> str:
    return (f"CASE WHEN {x} < 0.95 THEN 'Selling below assessed — buyers getting value' "
            f"WHEN {x} < 1.05 THEN 'Near assessed value — fair market' "
            f"WHEN {x} < 1.20 THEN 'Selling above assessed — competitive zip' "
            f"ELSE 'Well above assessed — high demand area' END")


def _buyer_sql(x: str) -> str:
    return (f"CASE WHEN {x} > 1.3 THEN 'Well above assessed' WHEN {x} > 1.1 THEN 'Above assessed' "
            f"WHEN {x} >= 0.95 THEN 'Near assessed value' ELSE 'Below assessed' END")


@register("assessment_ratio", f"""
WITH p AS (SELECT p_partkey AS account_key, {sql_zip5(BRAND_NO)} AS zip, p_retailprice AS just FROM part),
s AS (SELECT l_partkey AS account_key, {UNIT_PRICE} AS sale_price FROM lineitem WHERE l_shipdate >= {NOW_365}),
m AS (SELECT zip, sale_price / just AS r FROM s JOIN p USING (account_key)
      WHERE regexp_matches(zip, '^[0-9]+$') AND just > 0),
g AS (SELECT zip, round(median(r), 9) AS median_ratio FROM m GROUP BY zip)
SELECT zip, median_ratio, {_meaning_sql('median_ratio')} AS meaning FROM g
""")
def assessment_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.assessment_ratio(P.lineitem_sales(spark, sf_dir), P.part_parcels(spark, sf_dir), as_of=P.AS_OF,
                              zip_pattern=P.NUMERIC_ZIP, median_decimals=9)


@register("buyer_value_index", f"""
WITH p AS (SELECT p_partkey AS account_key, {sql_zip5(BRAND_NO)} AS zip, p_retailprice AS just FROM part
           WHERE p_size > 0 AND p_retailprice > 0),
pz AS (SELECT * FROM p WHERE regexp_matches(zip, '^[0-9]+$')),
av AS (SELECT zip, {sql_fixed_mean('just')} AS avg_assessed FROM pz GROUP BY zip),
s AS (SELECT l_partkey AS account_key, {UNIT_PRICE} AS sale_price FROM lineitem WHERE l_shipdate >= {NOW_365}),
g AS (SELECT zip, round(median(sale_price), 9) AS median_sale_price, count(sale_price) AS sales_volume
      FROM s JOIN pz USING (account_key) GROUP BY zip HAVING count(sale_price) >= 20)
SELECT zip, median_sale_price, sales_volume, avg_assessed, median_sale_price / avg_assessed AS value_ratio,
       {_buyer_sql('median_sale_price / avg_assessed')} AS buyer_signal
FROM g JOIN av USING (zip)
""")
def buyer_value_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.buyer_value_index(P.lineitem_sales(spark, sf_dir), P.part_parcels(spark, sf_dir), as_of=P.AS_OF,
                               zip_pattern=P.NUMERIC_ZIP, scale=2, median_decimals=9)


@register("investor_activity", f"""
WITH p AS (SELECT c_custkey AS account_key, {sql_zip5('c_nationkey')} AS zip,
                  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'X' END AS homestead FROM customer),
s AS (SELECT o_custkey AS account_key FROM orders WHERE o_orderdate >= {NOW_365})
SELECT zip, count(account_key) AS total_sales,
       avg(CASE WHEN coalesce(trim(homestead) <> 'X', true) THEN 1.0 ELSE 0.0 END) AS investor_share
FROM s JOIN p USING (account_key) WHERE regexp_matches(zip, '^[0-9]+$') GROUP BY zip
""")
def investor_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.investor_activity(P.orders_sales(spark, sf_dir), P.customer_parcels(spark, sf_dir), as_of=P.AS_OF,
                               zip_pattern=P.NUMERIC_ZIP)


# ------------------------------------------------------------------ M1, M2, M3, M4, M9

def _signal_sql(ratio: str, delta: str) -> str:
    label = (f"CASE WHEN {ratio} > 1.0 THEN 'SELLERS CONTROL' WHEN {ratio} < 0.97 THEN 'BUYERS LEVERAGE' "
             f"ELSE 'NEUTRAL' END")
    price = f"CASE WHEN {delta} IS NOT NULL THEN ', Price ' || CASE WHEN {delta} < 0 THEN 'DOWN' ELSE 'UP' END ELSE '' END"
    return f"{label} || ' (Ratio: ' || coalesce({sql_pct(ratio, 1)}, 'nan%') || {price} || ')'"


WEEKLY_SQL = """
o AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period_end, o_totalprice,
             CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS f FROM orders),
w AS (SELECT period_end, round(median(o_totalprice), 4) AS median_price, avg(f) AS sale_to_list
      FROM o GROUP BY period_end),
y AS (SELECT a.period_end, a.median_price, a.sale_to_list, a.median_price / b.median_price - 1.0 AS price_yoy
      FROM w a LEFT JOIN w b ON b.period_end = a.period_end - 364)"""


@register("price_pressure", f"""
WITH {WEEKLY_SQL},
l AS (SELECT * FROM y ORDER BY period_end DESC LIMIT 4),
d AS (SELECT *, median_price / lag(median_price) OVER (ORDER BY period_end) - 1.0 AS price_delta FROM l)
SELECT 'ALL' AS region, period_end AS week, median_price, sale_to_list, price_yoy, price_delta,
       {_signal_sql('sale_to_list', 'price_delta')} AS signal
FROM d
""")
def price_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, ratio = P.weekly_price_series(spark, sf_dir)
    return M.price_pressure(price, ratio)


DAILY_SQL = """
d AS (SELECT CAST(ts AS DATE) AS period_end, event_type, count(*) AS n FROM events
      WHERE event_type IN ('view', 'signup', 'purchase') GROUP BY 1, 2),
sup AS (SELECT period_end, n AS supply FROM d WHERE event_type = 'view'),
sy AS (SELECT a.period_end, a.supply, a.supply - b.supply AS supply_yoy_abs
       FROM sup a LEFT JOIN sup b ON b.period_end = a.period_end - 7),
lis AS (SELECT period_end, n AS new_listings FROM d WHERE event_type = 'signup'),
sol AS (SELECT period_end, n AS homes_sold FROM d WHERE event_type = 'purchase')"""


@register("inventory_absorption", f"""
WITH {DAILY_SQL},
j AS (SELECT * FROM sy JOIN lis USING (period_end) JOIN sol USING (period_end) ORDER BY period_end DESC LIMIT 4)
SELECT 'ALL' AS region, period_end AS week, CAST(supply AS DOUBLE) AS weeks_of_supply,
       CAST(new_listings AS DOUBLE) AS new_listings, CAST(homes_sold AS DOUBLE) AS homes_sold,
       CASE WHEN supply > 18 THEN 'Buyer''s Market — Lots of inventory to choose from'
            WHEN supply < 8 THEN 'Seller''s Market — Limited homes available'
            ELSE 'Balanced Market — Normal amount of inventory' END AS market_state,
       CASE WHEN supply - supply_yoy_abs > 0 THEN supply_yoy_abs / (supply - supply_yoy_abs) END AS supply_yoy,
       CAST(homes_sold AS DOUBLE) / CAST(new_listings AS DOUBLE) AS absorption_ratio
FROM j
""")
def inventory_absorption(spark: SparkSession, sf_dir: str) -> DataFrame:
    supply, listings, sold = P.daily_event_series(spark, sf_dir)
    return M.inventory_absorption(supply, listings, sold)


RENT_SQL = """r AS (SELECT last_day(l_shipdate) AS month, round(median(l_extendedprice), 4) / 12.0 AS rent
      FROM lineitem GROUP BY 1)"""


@register("trend_lines", f"""
WITH v AS (SELECT last_day(o_orderdate) AS month, round(median(o_totalprice), 4) AS zhvi FROM orders GROUP BY 1),
v6 AS (SELECT * FROM v ORDER BY month DESC LIMIT 6),
{RENT_SQL},
j AS (SELECT v6.month, zhvi, coalesce(r.rent, 0.0) AS zori FROM v6 LEFT JOIN r USING (month)),
pj AS (SELECT {sql_fixed_mean('p_retailprice')} AS avg_just FROM part WHERE p_retailprice > 0 AND p_size > 0),
f AS (SELECT month, zhvi, zori,
             CASE WHEN zhvi > 0 THEN zori * 12 / zhvi ELSE 0.0 END AS flow_ratio,
             CASE WHEN avg_just > 0 THEN (zhvi - avg_just) / avg_just ELSE 0.0 END AS appraisal_gap
      FROM j, pj)
SELECT 'ALL' AS region, month, zhvi, zori, flow_ratio, appraisal_gap,
       CASE WHEN flow_ratio > lag(flow_ratio) OVER (ORDER BY month) * 1.001 THEN '↑ Expanding'
            WHEN flow_ratio < lag(flow_ratio) OVER (ORDER BY month) * 0.999 THEN '↓ Compressing'
            ELSE '→ Flat' END AS direction
FROM f
""")
def trend_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = P.value_index_wide(spark, sf_dir, latest=6)
    months = [c for c in value.columns if c != "region"]
    return M.trend_lines(value, P.rent_index_wide(spark, sf_dir, months), P.part_parcels(spark, sf_dir), scale=2)


@register("cash_flow_zones", f"""
WITH {RENT_SQL},
lr AS (SELECT rent FROM r WHERE month = (SELECT max(month) FROM r WHERE rent IS NOT NULL)),
p AS (SELECT {sql_number(BRAND_NO)} AS z, p_retailprice AS just FROM part WHERE p_retailprice > 0 AND p_size > 0),
z AS (SELECT CAST(CAST(z AS INTEGER) AS VARCHAR) AS zip, {sql_fixed_mean('just')} AS avg_assessed
      FROM p WHERE z IS NOT NULL AND starts_with(CAST(z AS VARCHAR), '') GROUP BY z)
SELECT zip, avg_assessed, rent * 12 AS est_annual_rent, rent * 12 / avg_assessed AS cash_flow_ratio,
       row_number() OVER (ORDER BY rent * 12 / avg_assessed DESC NULLS LAST, zip) AS rank
FROM z, lr
""")
def cash_flow_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cash_flow_zones(P.latest_rent(spark, sf_dir), P.part_parcels(spark, sf_dir), zip_prefix="", scale=2)


@register("appraisal_gap", f"""
WITH v AS (SELECT {sql_zip5(BRAND_NO)} AS zip, last_day(l_shipdate) AS month,
                  round(median({UNIT_PRICE}), 9) AS value
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
lv AS (SELECT {sql_number('zip')} AS zip_code, value AS zhvi FROM v WHERE month = (SELECT max(month) FROM v)),
a AS (SELECT {sql_number(sql_zip5(BRAND_NO))} AS zip_code, {sql_fixed_mean('p_retailprice')} AS avg_just
      FROM part WHERE {sql_number(sql_zip5(BRAND_NO))} IS NOT NULL GROUP BY 1),
g AS (SELECT zip_code, zhvi, avg_just, (zhvi - avg_just) / avg_just AS gap_pct FROM lv JOIN a USING (zip_code))
SELECT zip_code, zhvi, avg_just, gap_pct,
       CASE WHEN gap_pct > 0.15 THEN 'HOT_MARKET' WHEN gap_pct <= 0 THEN 'COOLING' ELSE '' END AS flag
FROM g WHERE CASE WHEN gap_pct > 0.15 THEN 'HOT_MARKET' WHEN gap_pct <= 0 THEN 'COOLING' ELSE '' END <> ''
""")
def appraisal_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.appraisal_gap(P.unit_value_by_zip(spark, sf_dir, newest_only=True), P.part_parcels(spark, sf_dir),
                           scale=2)


# ------------------------------------------------------------------ single operators

@register("latest_n", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM orders) WHERE rn <= 3
""")
def q_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: newest three orders of every customer."""
    from homestat.operators.windows import latest_n
    o = P.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_n(o, "o_custkey", ["o_orderdate", "o_orderkey"], 3)


@register("pct_change", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
       o_totalprice / lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1.0 AS price_change
FROM orders
""")
def q_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of each order's price vs the customer's previous order."""
    from homestat.operators.windows import pct_change
    o = P.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return pct_change(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", "price_change")


@register("trend_direction", """
WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS qty
           FROM lineitem GROUP BY 1)
SELECT month, qty, CASE WHEN qty > lag(qty) OVER (ORDER BY month) * 1.001 THEN '↑ Expanding'
                        WHEN qty < lag(qty) OVER (ORDER BY month) * 0.999 THEN '↓ Compressing'
                        ELSE '→ Flat' END AS direction
FROM m
""")
def q_trend_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-over-month direction of shipped quantity (±0.1 % dead band)."""
    from homestat.operators.windows import direction
    li = P.table(spark, sf_dir, "lineitem")
    m = li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(F.sum("l_quantity").alias("qty"))
    return direction(m, None, "month", "qty")


@register("consecutive_pairs", """
SELECT * FROM (
  SELECT o_custkey, o_orderdate AS first_o_orderdate, o_totalprice AS first_o_totalprice,
         o_orderkey AS first_o_orderkey,
         lead(o_orderdate) OVER w AS second_o_orderdate, lead(o_totalprice) OVER w AS second_o_totalprice,
         lead(o_orderkey) OVER w AS second_o_orderkey
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey))
WHERE second_o_orderkey IS NOT NULL
""")
def q_consecutive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order paired with the customer's next order."""
    from homestat.operators.windows import consecutive_pairs
    o = P.table(spark, sf_dir, "orders")
    return consecutive_pairs(o, "o_custkey", "o_orderdate", ["o_orderkey"], ["o_totalprice", "o_orderkey"])


@register("rank_by_ratio", """
SELECT c_custkey, c_acctbal, CAST(row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS BIGINT) AS rank
FROM customer
""")
def q_rank_by_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global 1..n rank of customers by balance (skew-proof sorted layout)."""
    from homestat.operators.windows import rank_by
    c = P.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rank_by(c, None, "c_acctbal", tie=["c_custkey"])


@register("rank_within_group", """
SELECT c_nationkey, c_custkey, c_acctbal,
       CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS BIGINT) AS rank
FROM customer
""")
def q_rank_within_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 per group: rank of customers by balance inside each nation."""
    from homestat.operators.windows import rank_by
    c = P.table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return rank_by(c, "c_nationkey", "c_acctbal", tie=["c_custkey"])


@register("median_by_group", """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median_price, count(l_extendedprice) AS n
FROM lineitem GROUP BY 1, 2
""")
def q_median_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/A3: exact median and count of line prices per (return flag, status) —
    three hot groups over the whole line-item table."""
    from homestat.operators.aggregates import group_median
    li = P.table(spark, sf_dir, "lineitem")
    m = group_median(li, ["l_returnflag", "l_linestatus"], "l_extendedprice", out="median_price", count_out="n")
    return m.withColumn("median_price", F.round("median_price", 4))


@register("mean_by_group", f"""
SELECT l_returnflag, {sql_fixed_mean('l_extendedprice')} AS mean_price FROM lineitem GROUP BY 1
""")
def q_mean_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact (fixed-point) mean line price per return flag."""
    from homestat.operators.aggregates import group_mean
    return group_mean(P.table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice",
                      out="mean_price", scale=2)


@register("share_by_group", """
SELECT o_orderpriority, count(*) AS total, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS share
FROM orders GROUP BY 1
""")
def q_share_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: orders per priority and the share already fulfilled."""
    from homestat.operators.aggregates import group_share
    o = P.table(spark, sf_dir, "orders")
    return group_share(o, "o_orderpriority", F.col("o_orderstatus") == "F")


@register("argmax_group", """
SELECT c_nationkey, c_custkey, c_acctbal FROM (
  SELECT c_nationkey, c_custkey, c_acctbal,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey DESC) AS rn
  FROM customer WHERE c_acctbal IS NOT NULL) WHERE rn = 1
""")
def q_argmax_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer with the highest balance in each nation."""
    from homestat.operators.aggregates import arg_extreme
    c = P.table(spark, sf_dir, "customer")
    return arg_extreme(c, "c_nationkey", "c_acctbal", ["c_custkey", "c_acctbal"], tie=["c_custkey"])


@register("argmin_group", """
SELECT p_brand, p_partkey, p_retailprice FROM (
  SELECT p_brand, p_partkey, p_retailprice,
         row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice ASC, p_partkey ASC) AS rn
  FROM part WHERE p_retailprice IS NOT NULL) WHERE rn = 1
""")
def q_argmin_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the cheapest part of every brand."""
    from homestat.operators.aggregates import arg_extreme
    p = P.table(spark, sf_dir, "part")
    return arg_extreme(p, "p_brand", "p_retailprice", ["p_partkey", "p_retailprice"], largest=False,
                       tie=["p_partkey"])


@register("latest_per_group", """
SELECT o_custkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate IS NOT NULL) WHERE rn = 1
""")
def q_latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chronologically last order of each customer via max_by."""
    from homestat.operators.aggregates import arg_extreme
    o = P.table(spark, sf_dir, "orders")
    return arg_extreme(o, "o_custkey", "o_orderdate", ["o_orderdate", "o_totalprice"], tie=["o_orderkey"])


# ------------------------------------------------------------------ scalar functions

@register("normalize_account", """
SELECT c_custkey, regexp_replace(regexp_replace(regexp_extract(c_name, '#(.*)$', 1), '^\\s+|\\s+$', '', 'g'),
                                 '^0+', '') AS account_key
FROM customer
""")
def q_normalize_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC1: zero-padded account numbers from the customer names, unpadded."""
    from homestat.functions.scalars import normalize_account
    c = P.table(spark, sf_dir, "customer")
    return c.select("c_custkey", normalize_account(F.regexp_extract("c_name", "#(.*)$", 1)).alias("account_key"))


def _address_sql(x: str) -> str:
    from homestat.functions.scalars import ADDRESS_ABBREVIATIONS
    s = f"regexp_replace(upper({x}), '^\\s+|\\s+$', '', 'g')"
    s = f"regexp_replace({s}, '[^A-Z0-9\\s]', '', 'g')"
    for full, abbr in ADDRESS_ABBREVIATIONS:
        s = f"replace({s}, '{full}', '{abbr}')"
    return f"coalesce(regexp_replace({s}, '\\s+', ' ', 'g'), '')"


@register("normalize_address", f"""
SELECT p_partkey, {_address_sql("p_name || ' street, north #' || p_type")} AS address FROM part
""")
def q_normalize_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC2: part names dressed as street addresses, normalised."""
    from homestat.functions.scalars import normalize_address
    p = P.table(spark, sf_dir, "part")
    raw = F.concat(F.col("p_name"), F.lit(" street, north #"), F.col("p_type"))
    return p.select("p_partkey", normalize_address(raw).alias("address"))


@register("build_address", f"SELECT account_key AS c_custkey, address FROM ({SQL_ADDRESS})")
def q_build_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC3/SC4: address line assembled from customer fields with a 5-character zip."""
    from homestat.functions.scalars import build_address
    c = P.customer_parcels(spark, sf_dir)
    return c.select(F.col("account_key").alias("c_custkey"),
                    build_address(F.col("locn"), F.col("locs"), F.col("locd"), F.col("unit"), F.col("zip"),
                                  P.CITY).alias("address"))


@register("number_cleaning", f"""
SELECT event_id, {sql_number("regexp_replace(regexp_extract(props, ':([^}}]*)', 1), '[\",]', '', 'g')")} AS k
FROM events
""")
def q_number_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC5/SC8: numbers pulled out of JSON text, quotes and separators removed, coerced."""
    from homestat.functions.scalars import clean_number
    ev = P.table(spark, sf_dir, "events")
    return ev.select("event_id", clean_number(F.regexp_extract("props", ":([^}]*)", 1)).alias("k"))


@register("date_formats", """
SELECT o_orderkey, strftime(o_orderdate, '%b %d') AS week_label, strftime(o_orderdate, '%b %d, %Y') AS day_label,
       strftime(o_orderdate, '%b %Y') AS month_label, strftime(o_orderdate, '%B %d, %Y') AS long_label,
       date_diff('day', o_orderdate, TIMESTAMP '2001-01-01 00:00:00') AS days_to_as_of
FROM orders
""")
def q_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC10/SC11: display formats of order dates and whole days to as_of."""
    from homestat.functions import scalars as S
    o = P.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.week_label("o_orderdate").alias("week_label"),
                    S.day_label("o_orderdate").alias("day_label"), S.month_label("o_orderdate").alias("month_label"),
                    S.long_day_label("o_orderdate").alias("long_label"),
                    S.days_between(F.col("o_orderdate"), F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
                    .alias("days_to_as_of"))


@register("display_formats", f"""
SELECT o_orderkey, '$' || format('{{:,.0f}}', o_totalprice) AS price_text,
       {sql_pct('o_totalprice / 500000.0', 1, True)} AS share_text,
       ({sql_fixed('o_totalprice / 100000.0', 2)} || 'x') AS ratio_text,
       least(100, CAST(trunc(o_totalprice / 500000.0 * 100) AS INTEGER)) AS bar_width
FROM orders
""")
def q_display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC17/SC20: money, signed percent, ratio text and share-bar width."""
    from homestat.functions import scalars as S
    o = P.table(spark, sf_dir, "orders")
    share = F.col("o_totalprice") / F.lit(500000.0)
    return o.select("o_orderkey", S.money_text("o_totalprice").alias("price_text"),
                    S.pct_text(share, 1, signed=True).alias("share_text"),
                    S.ratio_text(F.col("o_totalprice") / F.lit(100000.0), 2).alias("ratio_text"),
                    S.bar_width(share).alias("bar_width"))


# ------------------------------------------------------------------ history (K2, K3, W5, A8), health

EVENT_RUNS_SQL = """SELECT CAST(ts AS DATE) AS run_date, event_type AS metric, count(*) AS n
  FROM events GROUP BY 1, 2"""


def _event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = P.table(spark, sf_dir, "events")
    return ev.groupBy(F.to_date("ts").alias("run_date"), F.col("event_type").alias("metric")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("metric_counts", f"""
SELECT DATE '2001-01-01' AS run_date, metric, n FROM (
  SELECT 'zip_price_trends' AS metric, count(*) AS n FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 0
      AND c_nationkey IN (SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
                          WHERE o_orderdate >= {NOW_365} AND c_acctbal > 0)
      AND c_nationkey IN (SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
                          WHERE o_orderdate >= {PRIOR_730} AND o_orderdate < {NOW_365} AND c_acctbal > 0))
  UNION ALL SELECT 'bulk_transfer_keys', count(*) FROM ({BULK_KEYS_SQL})
  UNION ALL SELECT 'flip_summary', 0)
""")
def q_metric_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of each result of a run (non-table results count 0)."""
    import datetime as dt
    from homestat.sources.history import metric_counts
    results = {"zip_price_trends": zip_price_trends(spark, sf_dir),
               "bulk_transfer_keys": bulk_transfer_keys(spark, sf_dir),
               "flip_summary": "text result"}
    return metric_counts(spark, results, dt.date(2001, 1, 1))


@register("history_retention", f"""
SELECT run_date, metric, n FROM ({EVENT_RUNS_SQL}) WHERE date_diff('day', run_date, DATE '2024-01-30') <= 28
""")
def q_history_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: runs kept by the 28-day retention at as_of 2024-01-30 (the first day expires)."""
    from homestat.sources.history import expire_history
    kept, _ = expire_history(_event_runs(spark, sf_dir), P.EVENTS_AS_OF.date(), days=28)
    return kept


@register("metric_history_trend", f"""
SELECT run_date, metric, n, lag(n) OVER (PARTITION BY metric ORDER BY run_date) AS prev_n,
       n - lag(n) OVER (PARTITION BY metric ORDER BY run_date) AS delta
FROM ({EVENT_RUNS_SQL})
""")
def q_metric_history_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-over-run change of every metric's count."""
    from homestat.sources.history import metric_trend
    return metric_trend(_event_runs(spark, sf_dir))


HEALTH_SQL = """
WITH h AS (
  SELECT 'orders' AS source, count(*) AS row_count, max(o_orderdate) AS newest FROM orders
  UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem
  UNION ALL SELECT 'events', count(*), max(ts) FROM events
  UNION ALL SELECT 'customer', count(*), CAST(NULL AS TIMESTAMP) FROM customer
  UNION ALL SELECT 'part', count(*), CAST(NULL AS TIMESTAMP) FROM part),
s AS (SELECT *, date_diff('day', newest, TIMESTAMP '2001-01-01 00:00:00') AS age_days,
             CASE WHEN row_count = 0 THEN 'FAILED' ELSE 'OK' END AS status FROM h)
SELECT *, count(*) FILTER (WHERE status = 'OK') OVER () AS healthy_sources,
       count(*) FILTER (WHERE status = 'OK') OVER () = 0 AS degraded FROM s"""


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homestat.sources.health import source_health
    t = lambda n: P.table(spark, sf_dir, n)
    return source_health({"orders": (t("orders"), "o_orderdate"), "lineitem": (t("lineitem"), "l_shipdate"),
                          "events": (t("events"), "ts"), "customer": (t("customer"), None),
                          "part": (t("part"), None)}, P.AS_OF)


@register("source_health", HEALTH_SQL)
def q_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-source rows, newest date, age and status; the run is degraded when all fail."""
    return _health(spark, sf_dir)


# ------------------------------------------------------------------ M11 snapshot

def _tagged(df: DataFrame) -> DataFrame:
    return df.withColumn("region", F.lit(P.REGION))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.market_snapshot(price_pressure(spark, sf_dir), inventory_absorption(spark, sf_dir),
                             _tagged(zip_price_trends(spark, sf_dir)), _tagged(buyer_value_index(spark, sf_dir)),
                             _tagged(resale_flips(spark, sf_dir)))


def _labels_sql() -> str:
    sup = "weeks_supply"
    money = "'$' || format('{:,.0f}', median_price)"
    has = "median_price IS NOT NULL AND median_price <> 0"
    sup_t = sql_fixed(sup, 0)
    phase = (f"CASE WHEN {sup} IS NULL THEN 'Market Data Unavailable' "
             f"WHEN {sup} >= 18 AND (price_yoy IS NULL OR price_yoy < 0) THEN 'Buyer''s Market' "
             f"WHEN {sup} >= 18 THEN 'Shifting Toward Buyers' "
             f"WHEN {sup} <= 8 AND price_yoy IS NOT NULL AND price_yoy > 0 THEN 'Seller''s Market' "
             f"WHEN {sup} <= 8 THEN 'Cooling Seller''s Market' ELSE 'Balanced Market' END")
    return f"""
  CASE WHEN median_price IS NULL AND price_yoy IS NULL AND sale_to_list IS NULL THEN ''
       WHEN price_yoy IS NOT NULL THEN {sql_pct('price_yoy', 1, True)} || ' vs. last year ('
            || CASE WHEN price_yoy > 0 THEN 'up' ELSE 'down' END || ')'
       ELSE 'Year-over-year change unavailable' END AS price_yoy_label,
  CASE WHEN {sup} IS NULL THEN '' WHEN {sup} > 18 THEN 'Buyers have significant leverage'
       WHEN {sup} < 8 THEN 'Limited homes available — competitive market' ELSE 'Balanced inventory levels' END
       AS supply_label,
  {phase} AS market_phase,
  CASE WHEN contains({phase}, 'Buyer') AND {has} AND {sup_t} IS NOT NULL
         THEN 'With ' || {sup_t} || ' months of supply and a median price of ' || {money}
              || ', buyers currently have more negotiating room than usual.'
       WHEN contains({phase}, 'Seller') AND {has} AND {sup_t} IS NOT NULL
         THEN 'With only ' || {sup_t} || ' months of supply and prices at ' || {money}
              || ', sellers are in a strong position — expect competition.'
       WHEN {has} AND {sup_t} IS NOT NULL
         THEN 'The market is balanced. Median sale price is ' || {money} || ' with ' || {sup_t}
              || ' months of inventory.'
       ELSE 'See sections below for detailed market conditions.' END AS headline"""


SNAPSHOT_SQL = None  # filled below, once all component SQL strings exist


def _snapshot_sql() -> str:
    # DuckDB oracle only: p, i and f are one-row CTEs (the Spark plan has no cross join)
    q = ORACLE_SQL
    return f"""
WITH pp AS ({q['price_pressure']}), inv AS ({q['inventory_absorption']}), zt AS ({q['zip_price_trends']}),
bv AS ({q['buyer_value_index']}), fl AS ({q['resale_flips']}),
p AS (SELECT median_price, price_yoy, sale_to_list FROM pp ORDER BY week DESC LIMIT 1),
i AS (SELECT weeks_of_supply AS weeks_supply, new_listings, homes_sold FROM inv ORDER BY week DESC LIMIT 1),
h AS (SELECT zip AS hottest_zip, yoy_change AS hy, sales_volume AS hv FROM zt
      WHERE yoy_change > 0 AND sales_volume >= 20 ORDER BY yoy_change DESC, zip DESC LIMIT 1),
b AS (SELECT zip AS best_value_zip, value_ratio AS bvr FROM bv WHERE value_ratio IS NOT NULL
      ORDER BY value_ratio ASC, zip ASC LIMIT 1),
f AS (SELECT count(*) AS flip_count, count(*) FILTER (WHERE outcome = 'PROFITABLE') AS prof FROM fl),
base AS (SELECT * FROM p CROSS JOIN i CROSS JOIN f LEFT JOIN h ON true LEFT JOIN b ON true)
SELECT 'ALL' AS region, median_price, price_yoy, sale_to_list, weeks_supply, new_listings, homes_sold, {_labels_sql()},
  hottest_zip,
  CASE WHEN hottest_zip IS NOT NULL THEN 'Zip ' || hottest_zip || ' saw the strongest price growth ('
       || {sql_pct('hy', 1, True)} || ') with ' || CAST(hv AS VARCHAR) || ' sales in the past year' ELSE '' END
       AS hottest_zip_label,
  best_value_zip,
  CASE WHEN best_value_zip IS NOT NULL THEN 'Zip ' || best_value_zip || ' has the lowest sale-to-assessed ratio ('
       || {sql_fixed('bvr', 2)} || 'x) — relatively more affordable' ELSE '' END AS best_value_label,
  flip_count, CASE WHEN flip_count > 0 THEN prof / flip_count ELSE 0.0 END AS flip_profitable_pct,
  flip_count BETWEEN 10 AND 150 AS flip_count_in_range,
  CASE WHEN flip_count > 0 THEN CAST(flip_count AS VARCHAR) || ' total — ' || CAST(prof AS VARCHAR)
       || ' profitable, ' || CAST(flip_count - prof AS VARCHAR) || ' loss' ELSE 'No flips detected' END AS flip_summary
FROM base
"""


@register("market_snapshot", _snapshot_sql())
def q_market_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary row built from price, inventory, zip trends, value index and flips."""
    return _snapshot(spark, sf_dir)


# ------------------------------------------------------------------ X1–X10 report sections

def _wrap(sql: str, extra: str) -> str:
    return f"SELECT *, {extra} FROM ({sql})"


@register("report_buyer_value", _wrap(ORACLE_SQL["buyer_value_index"],
          "CASE WHEN value_ratio > 1.3 THEN 'badge-warning' WHEN value_ratio < 0.95 THEN 'badge-success' "
          f"ELSE 'badge-neutral' END AS badge, {sql_money('median_sale_price')} AS price_text, "
          f"{sql_money('avg_assessed')} AS assessed_text, {sql_fixed('value_ratio', 2)} || 'x' AS ratio_text"))
def q_report_buyer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5."""
    from homestat.plans.report import buyer_value_section
    return buyer_value_section(buyer_value_index(spark, sf_dir))


@register("report_price_changes", _wrap(ORACLE_SQL["zip_price_trends"],
          "CASE WHEN yoy_change > 0.05 THEN 'badge-warning' WHEN yoy_change < -0.05 THEN 'badge-down' "
          "ELSE 'badge-neutral' END AS badge, yoy_flag = 'low_data' AS limited_data, "
          f"{sql_money('price_now')} AS price_text, {sql_money('price_prior')} AS prior_text, "
          f"{sql_pct('yoy_change', 1, True)} AS yoy_text"))
def q_report_price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6."""
    from homestat.plans.report import price_change_section
    return price_change_section(zip_price_trends(spark, sf_dir))


@register("report_assessments", _wrap(ORACLE_SQL["assessment_ratio"],
          "CASE WHEN median_ratio > 1.2 THEN 'badge-warning' WHEN median_ratio < 0.95 THEN 'badge-success' "
          f"ELSE 'badge-neutral' END AS badge, {sql_fixed('median_ratio', 2)} || 'x' AS ratio_text"))
def q_report_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7."""
    from homestat.plans.report import assessment_section
    return assessment_section(assessment_ratio(spark, sf_dir))


@register("report_investors", _wrap(ORACLE_SQL["investor_activity"],
          "CASE WHEN investor_share > 0.6 THEN 'badge-warning' WHEN investor_share < 0.3 THEN 'badge-success' "
          "ELSE 'badge-neutral' END AS badge, least(100, CAST(trunc(investor_share * 100) AS INTEGER)) AS bar_width, "
          f"{sql_pct('investor_share', 0)} AS share_text"))
def q_report_investors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9."""
    from homestat.plans.report import investor_section
    return investor_section(investor_activity(spark, sf_dir))


@register("report_flips", f"""
SELECT * EXCLUDE (rn), rn AS position,
  CASE WHEN sqft IS NOT NULL AND sqft <> 0 THEN format('{{:,.0f}}', sqft) || ' sqft' ||
       CASE WHEN beds IS NOT NULL AND beds <> 0 THEN ', ' || {sql_fixed('beds', 0)} || ' bed' ELSE '' END END AS detail,
  CASE WHEN outcome = 'PROFITABLE' THEN 'badge-success' ELSE 'badge-danger' END AS badge,
  {sql_money('first_sale_price')} AS first_price_text, {sql_money('second_sale_price')} AS second_price_text,
  {sql_pct('markup_pct', 1, True)} AS markup_text,
  strftime(first_sale_date, '%b %d, %Y') AS first_label, strftime(second_sale_date, '%b %d, %Y') AS second_label
FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY account ASC NULLS LAST, first_sale_date,
                                   second_sale_date) AS rn
      FROM ({ORACLE_SQL['resale_flips']})) WHERE rn <= 10
""")
def q_report_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten profitable and ten loss flips in account order."""
    from homestat.plans.report import flip_section
    return flip_section(resale_flips(spark, sf_dir))


@register("report_prices", f"""
SELECT *, strftime(week, '%b %d') AS week_label,
  CASE WHEN median_price IS NOT NULL AND median_price <> 0 THEN '$' || format('{{:,.0f}}', median_price) ELSE 'N/A' END
    AS price_text,
  coalesce({sql_pct('price_delta', 1, True)}, '—') AS delta_text,
  coalesce({sql_pct('price_yoy', 1, True)}, '—') AS yoy_text,
  CASE WHEN lr IS NOT NULL AND lr <> 0 AND lr < 0.97 THEN 'Homes are selling below asking price (' || {sql_pct('lr', 1)}
            || ' of list on average). Buyers may have room to negotiate.'
       WHEN lr IS NOT NULL AND lr <> 0 AND lr > 1.0 THEN 'Homes are selling above asking price (' || {sql_pct('lr', 1)}
            || ' of list). Expect competition and consider offering at or above list price.'
       ELSE 'Homes are selling near asking price. The market is fairly balanced right now.' END AS insight
FROM (SELECT *, first_value(sale_to_list) OVER (ORDER BY week DESC) AS lr FROM ({ORACLE_SQL['price_pressure']}))
""".replace("SELECT *, strftime", "SELECT * EXCLUDE (lr), strftime"))
def q_report_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2."""
    from homestat.plans.report import price_section
    return price_section(price_pressure(spark, sf_dir))


@register("report_inventory", f"""
SELECT * EXCLUDE (ls, ll, lh), strftime(week, '%b %d') AS week_label,
  coalesce({sql_pct('supply_yoy', 1, True)}, 'N/A') AS yoy_text, coalesce({sql_fixed('weeks_of_supply', 1)}, 'N/A') AS supply_text,
  CASE WHEN new_listings <> 0 THEN format('{{:,.0f}}', new_listings) ELSE 'N/A' END AS listings_text,
  CASE WHEN homes_sold <> 0 THEN format('{{:,.0f}}', homes_sold) ELSE 'N/A' END AS sold_text,
  CASE WHEN ls IS NOT NULL AND ls <> 0 AND ls > 18 THEN 'At ' || {sql_fixed('ls', 0)}
            || ' months of supply, buyers have significant negotiating power — there are more homes available than buyers right now.'
       WHEN ls IS NOT NULL AND ls <> 0 AND ls < 8 THEN 'At only ' || {sql_fixed('ls', 0)}
            || ' months of supply, homes are moving fast. Buyers should be prepared to act quickly.'
       ELSE 'The market has a relatively balanced amount of inventory.' END ||
  CASE WHEN ll IS NOT NULL AND ll <> 0 AND lh IS NOT NULL AND lh <> 0 THEN ' New listings (' || format('{{:,.0f}}', ll)
       || ') are ' || CASE WHEN ll > lh THEN 'outpacing' ELSE 'below' END || ' homes sold (' || format('{{:,.0f}}', lh)
       || ') this week.' ELSE '' END AS insight
FROM (SELECT *, first_value(weeks_of_supply) OVER (ORDER BY week DESC) AS ls,
             first_value(new_listings) OVER (ORDER BY week DESC) AS ll,
             first_value(homes_sold) OVER (ORDER BY week DESC) AS lh FROM ({ORACLE_SQL['inventory_absorption']}))
""")
def q_report_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3."""
    from homestat.plans.report import inventory_section
    return inventory_section(inventory_absorption(spark, sf_dir))


@register("report_trend", f"""
SELECT * EXCLUDE (lf, lz, lr), strftime(month, '%b %Y') AS month_label, {sql_money('zhvi')} AS value_text,
  {sql_money('zori')} || '/mo' AS rent_text, {sql_pct('flow_ratio', 2)} AS ratio_text,
  'A ' || {sql_pct('lf', 1)} || ' annual rent-to-value ratio means that for a typical ' || '$' || format('{{:,.0f}}', lz)
  || ' home, gross annual rent is roughly ' || '$' || format('{{:,.0f}}', lr * 12)
  || '. This is a county-wide estimate — actual figures vary significantly by neighborhood.' AS insight
FROM (SELECT *, first_value(flow_ratio) OVER (ORDER BY month DESC) AS lf, first_value(zhvi) OVER (ORDER BY month DESC) AS lz,
             first_value(zori) OVER (ORDER BY month DESC) AS lr FROM ({ORACLE_SQL['trend_lines']}))
""")
def q_report_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4."""
    from homestat.plans.report import trend_section
    return trend_section(trend_lines(spark, sf_dir))


@register("report_snapshot", f"""
SELECT *, CASE WHEN median_price IS NOT NULL AND median_price <> 0 THEN '$' || format('{{:,.0f}}', median_price) END
          AS price_text,
       CASE WHEN weeks_supply IS NOT NULL AND weeks_supply <> 0 THEN {sql_fixed('weeks_supply', 0)} || ' mo' END
          AS supply_text
FROM ({ORACLE_SQL['market_snapshot']})
""")
def q_report_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1."""
    from homestat.plans.report import snapshot_cells
    return snapshot_cells(_snapshot(spark, sf_dir))


@register("report_health", _wrap(HEALTH_SQL.replace("\n", " "),
          "CASE WHEN status = 'OK' THEN 'badge-success' ELSE 'badge-danger' END AS badge"))
def q_report_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10."""
    from homestat.plans.report import health_section
    return health_section(_health(spark, sf_dir))


# ------------------------------------------------------------------ landed-file scans
# Data derived from the driver tables is written in each landed format under the
# session's shared checkpoint folder, then read back through the library's scans.

@register("weekly_export_scan", """
WITH o AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period_end, o_totalprice FROM orders)
SELECT 'ALL' AS region, period_end, round(median(o_totalprice), 4) AS median_price FROM o GROUP BY period_end
""")
def q_weekly_export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2/S3/SC5/SC6: weekly medians exported as a UTF-16 tab crosstab ('M/d/yyyy'
    dates, thousands separators), found by its byte-order mark and read back."""
    from homestat.operators.aggregates import group_median
    from homestat.sources import exports as X
    from homestat.sources.readers import read_weekly_detect
    o = P.table(spark, sf_dir, "orders").select(
        F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 6).alias("period_end"), "o_totalprice")
    med = group_median(o, "period_end", "o_totalprice", out="m").withColumn("m", F.round("m", 4))
    text = med.select(X.us_date_text("period_end").alias("Period End"),
                      F.format_number("m", 4).alias("Median Sale Price"))
    path = X.scratch_path(spark, "weekly")
    X.write_weekly_csv(text, path, encoding="UTF-16")
    return read_weekly_detect(spark, path, region="ALL").select("region", "period_end", "median_price")


@register("county_export_scan", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS account,
       regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), '^0+', '') AS account_key,
       CAST(c_nationkey AS VARCHAR) AS zip, c_acctbal AS living, c_name || ' Peña' AS locs,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'X' END AS homestead
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def q_county_export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4/M13/F2/P1/SC1: customers exported as a Latin-1 parcel file (zero-padded
    accounts, untidy city names, an extra column), cleaned for one city."""
    from homestat.sources import exports as X
    from homestat.sources.readers import clean_parcels, read_county
    c = P.table(spark, sf_dir, "customer")
    raw = c.select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("ACCOUNT"),
                   F.col("c_custkey").cast("string").alias("LOCN"),
                   F.concat(F.col("c_name"), F.lit(" Peña")).alias("LOCS"),
                   F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit("  springfield "))
                   .otherwise(F.lit("Shelbyville")).alias("LOCCITY"),
                   F.col("c_nationkey").cast("string").alias("LOCZIP"),
                   F.col("c_acctbal").cast("string").alias("LIVING"),
                   F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("X")).alias("HOMESTEAD"),
                   F.lit("unused").alias("NOTES"))
    path = X.scratch_path(spark, "county")
    X.write_county_csv(raw, path)
    parcels = clean_parcels(read_county(spark, path), city="SPRINGFIELD")
    return parcels.select("account", "account_key", "zip", "living", "locs", "homestead")


# The oracle below pairs regions with the six newest months in DuckDB (both tiny)
# to list the NULL cells an unpivot keeps; the Spark side only unpivots.
@register("index_export_scan", """
WITH m AS (SELECT c_mktsegment AS region, last_day(o_orderdate) AS month, round(median(o_totalprice), 4) AS value
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
months AS (SELECT DISTINCT month FROM m ORDER BY month DESC LIMIT 6),
regions AS (SELECT DISTINCT region FROM m WHERE region <> 'AUTOMOBILE')
SELECT r.region, mo.month, m.value FROM regions r CROSS JOIN months mo
LEFT JOIN m ON m.region = r.region AND m.month = mo.month
""")
def q_index_export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly median order price per market segment as a wide index
    CSV (metadata columns + one column per month end), filtered by state and
    unpivoted to the newest six months."""
    from homestat.operators.aggregates import group_median
    from homestat.operators.relational import unpivot_dates
    from homestat.sources import exports as X
    from homestat.sources.readers import read_index_wide
    o = P.table(spark, sf_dir, "orders").join(P.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select(F.col("c_mktsegment").alias("seg"), F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd")
                 .alias("_month"), "o_totalprice")
    med = group_median(o, ["seg", "_month"], "o_totalprice", out="v").withColumn("v", F.round("v", 4))
    wide = med.groupBy("seg").pivot("_month", P.month_values(o)).agg(F.first("v"))
    state = F.when(F.col("seg") == "AUTOMOBILE", F.lit("GA")).otherwise(F.lit("FL"))
    meta = [F.col("seg").alias("RegionID"), F.lit("1").alias("SizeRank"), F.col("seg").alias("RegionName"),
            F.lit("segment").alias("RegionType"), state.alias("StateName"), state.alias("State"),
            F.concat(F.col("seg"), F.lit(", "), state).alias("Metro"), F.lit("12").alias("StateCodeFIPS"),
            F.lit("115").alias("MunicipalCodeFIPS")]
    months = [c for c in wide.columns if c != "seg"]
    path = X.scratch_path(spark, "index")
    wide.select(*meta, *[F.col(f"`{m}`") for m in months]).write.mode("overwrite").option("header", True).csv(path)
    return unpivot_dates(read_index_wide(spark, path, state="FL"), ["region"], latest=6)


@register("history_json_scan", EVENT_RUNS_SQL)
def q_history_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event counts written as one run-summary JSON per day, read back long."""
    from homestat.sources import exports as X
    from homestat.sources.history import read_history_json
    path = X.scratch_path(spark, "history")
    X.write_history_json(_event_runs(spark, sf_dir), path)
    return read_history_json(spark, f"{path}/*/*.json")


from homestat.plans import cases, regions, upkeep  # noqa: E402,F401  (they register their queries)
