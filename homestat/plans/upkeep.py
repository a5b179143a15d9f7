"""Queries of what keeps a long-running job going: metrics from changes alone, published
runs, streamed files of any encoding, discovery over real folders, address matching.

Files and tables are derived from the driver's tables, by the same rule on both sides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.plans import metrics as M
from homestat.plans import proxies as P
from homestat.plans import regions as G
from homestat.plans.queries import ORACLE_SQL, _address_sql, register
from homestat.sources.exports import scratch_path

# ------------------------------------------------------------------ M6, M7, M8, M10 from changes


@register("incremental_zip_metrics", f"""
SELECT * FROM (SELECT region, zip, price_now, sales_volume, price_prior, yoy_change FROM ({G._TREND}))
FULL JOIN ({G._RATIO}) USING (region, zip)
FULL JOIN (SELECT region, zip, median_sale_price, avg_assessed, value_ratio FROM ({G._VALUE})) USING (region, zip)
FULL JOIN ({G._INVESTORS}) USING (region, zip)""")
def incremental_zip_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6/M7/M8/M10 of all regions from four runs' changes: wrong prices that are corrected, late
    sales, one run without sales, parcels that are assessed anew; then the state is compacted."""
    from homestat.plans.incremental import CHANGE, ZipState, row_changes
    sales, parcels = G.regional_sales(spark, sf_dir), G.regional_parcels(spark, sf_dir)
    late, wrong = F.col("sale_id") % 3 == 2, F.col("sale_id") % 7 == 0
    first = sales.where(~late).withColumn("sale_price", F.when(wrong, F.col("sale_price") * 2).otherwise(F.col("sale_price")))
    old = parcels.withColumn("just", F.when(F.col("account_key") % 5 == 0, F.col("just") + 500).otherwise(F.col("just"))) \
        .withColumn("homestead", F.when(F.col("account_key") % 4 != 0, F.col("homestead")))
    state = ZipState(spark, scratch_path(spark, "zip-state"), by=G.BY)
    state.apply(dt.date(2000, 12, 11), old, first)
    corrected = row_changes(first, sales.where(~late))
    state.apply(dt.date(2000, 12, 18), old, corrected.unionByName(sales.where(late).withColumn(CHANGE, F.lit(1).cast("bigint"))))
    state.apply(dt.date(2000, 12, 25), old)
    state.apply(dt.date(2001, 1, 1), parcels, parcel_changes=row_changes(old, parcels), sales=sales)
    state.compact(P.AS_OF)
    out = state.metrics(P.AS_OF, median_decimals=4)
    parts = [out["zip_price_trends"].select("region", "zip", "price_now", "sales_volume", "price_prior", "yoy_change"),
             out["assessment_ratio"].drop("meaning"),
             out["buyer_value_index"].select("region", "zip", "median_sale_price", "avg_assessed", "value_ratio"), out["investor_activity"]]
    for part in parts[1:]:
        parts[0] = parts[0].join(part, ["region", "zip"], "full")
    return parts[0]


# ------------------------------------------------------------------ K1, K2, K4: published runs

@register("published_runs", """
SELECT 'current' AS seen, CAST('2001-01-08' AS DATE) AS run_date, o_orderpriority, count(*) + 2 AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'archive', run_date, o_orderpriority, n + more FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
  (VALUES (DATE '2001-01-01', 0), (DATE '2001-01-08', 2)) AS r(run_date, more)""")
def published_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K2/K4: a run, the next one, its rerun, and one that stops before it is published: what readers see."""
    from homestat.sources.versions import VersionStore
    counts = P.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    store = VersionStore(spark, scratch_path(spark, "runs"))
    for day, more, whole in ((1, 0, True), (8, 1, True), (8, 2, True), (15, 3, False)):
        name = store.begin()
        section = counts.select(F.lit(f"2001-01-{day:02d}").cast("date").alias("run_date"), "o_orderpriority", (F.col("n") + more).alias("n"))
        section.write.parquet(f"{store.folder(name)}/sections/priority")
        if whole:
            store.publish(name, f"2001-01-{day:02d}")
    current, archive = store.table("sections/priority"), store.archive("sections/priority")
    return current.select(F.lit("current").alias("seen"), "*").unionByName(archive.select(F.lit("archive").alias("seen"), "*"))


# ------------------------------------------------------------------ S2, S3, S5: streamed files

@register("weekly_stream_mixed", """
WITH w AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period_end, max(o_totalprice) AS price, count(*)::DOUBLE AS sold FROM orders GROUP BY 1),
k AS (SELECT *, date_diff('day', DATE '1970-01-04', period_end) // 7 % 3 AS kind FROM w)
SELECT 'ALL' AS region, period_end, CASE WHEN kind <> 1 THEN price END AS median_price, CASE WHEN kind <> 2 THEN sold END AS homes_sold, NULL AS line FROM k
UNION ALL SELECT 'ALL', NULL, NULL, NULL, 'week ' || strftime(period_end, '%Y-%m-%d') || ',"1,5"' FROM k WHERE kind = 2""")
def weekly_stream_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2/S3/S5 as a stream: three arrivals (UTF-16 with tabs; UTF-8 with other columns; UTF-8 with a
    byte-order mark and weeks that do not parse), the ingest started anew for each of them."""
    from homestat.sources.exports import us_date_text, write_weekly_csv
    from homestat.streaming.landing import start_mixed_ingest
    week = F.date_add(F.to_date(F.date_trunc("week", "o_orderdate")), 6)
    w = P.table(spark, sf_dir, "orders").groupBy(week.alias("end")).agg(F.max("o_totalprice").alias("price"), F.count(F.lit(1)).alias("sold"))
    w = w.withColumn("kind", F.floor(F.date_diff("end", F.lit("1970-01-04").cast("date")) / 7) % 3).checkpoint()
    end, price, sold = us_date_text("end").alias("Period End"), F.col("price").cast("string"), F.col("sold").cast("string")
    root = scratch_path(spark, "stream")
    third = w.where("kind = 2")
    arrivals = [(w.where("kind = 0").select(end, price.alias("Median Sale Price"), sold.alias("Adjusted Average Homes Sold")), "UTF-16"),
                (w.where("kind = 1").select(sold.alias("Adjusted Average Homes Sold"), F.lit("x, y").alias("Note"), end), "UTF-8"),
                (third.select(us_date_text("end").alias("﻿Period End"), price.alias("Median Sale Price")).unionAll(
                    third.select(F.concat(F.lit("week "), F.col("end").cast("string")), F.lit("1,5"))), "UTF-8")]
    for i, (df, encoding) in enumerate(arrivals):
        write_weekly_csv(df, f"{root}/landing/{i}", encoding=encoding)
        start_mixed_ingest(spark, f"{root}/landing", f"{root}/clean", f"{root}/rejected", f"{root}/checkpoint").awaitTermination()
    clean, bad = spark.read.parquet(f"{root}/clean"), spark.read.parquet(f"{root}/rejected")
    out = clean.select("region", "period_end", "median_price", "homes_sold", F.lit(None).cast("string").alias("line"))
    return out.unionByName(bad.select("region", "line"), allowMissingColumns=True)


_KINDS = {"median sale price": "median_sale_price", "Homes_Sold": "homes_sold", "new listings": "new_listings",
          "DAYS TO CLOSE": "days_to_close", "Months of Supply": "weeks_of_supply", "sale to list ratio": "avg_sale_to_list"}


@register("landed_file_discovery", f"""
WITH y AS (SELECT year(o_orderdate) AS y, max(o_orderdate) AS newest, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT key, name || ' ' || y || '.csv' AS name, n, newest FROM y, (VALUES {', '.join(map(str, _KINDS.items()))}) AS k(name, key)
      WHERE newest >= DATE '2001-01-01' - INTERVAL 1500 DAY)
SELECT key, name, true AS complete, (SELECT count(*) FROM orders WHERE year(o_orderdate) = (SELECT max(y) FROM y)) AS n_rows
FROM f WHERE newest = (SELECT max(newest) FROM y)""")
def landed_file_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5/F18/SC19 over real files: one of each kind and year, as old as that year's last order; the
    newest of each kind is found in the folder and read."""
    from homestat.sources.readers import discover, list_files
    root = scratch_path(spark, "landed")
    o = P.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), "o_orderdate", "o_orderkey")
    years = o.groupBy("y").agg(F.unix_millis(F.max("o_orderdate").cast("timestamp")).alias("at")).collect()  # a row a year
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    o.repartition("y").write.partitionBy("y").option("header", True).csv(f"{root}/raw")
    fs = jvm.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in years:
        source = [s.getPath() for s in fs.listStatus(jvm.Path(f"{root}/raw/y={r['y']}")) if s.getPath().getName().endswith(".csv")]
        for kind in _KINDS:
            target = jvm.Path(f"{root}/files/{kind} {r['y']}.csv")
            jvm.FileUtil.copy(fs, source[0], fs, target, False, spark.sparkContext._jsc.hadoopConfiguration())
            fs.setTimes(target, r["at"], -1)
    found = discover(list_files(spark, f"{root}/files"), P.AS_OF, max_age_days=1500).select("key", "path", "name", "complete")
    paths = [r["path"] for r in found.select("path").collect()]  # one per kind
    rows = spark.read.option("header", True).schema("o_orderdate string, o_orderkey bigint").csv(paths)
    name = F.url_decode(F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1), r"\\+", "%2B"))
    rows = rows.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return found.join(rows, "name", "left").select("key", "name", "complete", "n_rows")


@register("read_or_empty", "SELECT o_orderpriority, count(*) AS n, 0 AS n_missing FROM orders GROUP BY ALL")
def read_or_empty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is there and one that is not, read with the same schema."""
    from homestat.sources.readers import read_or_empty
    schema = P.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").schema
    here = read_or_empty(spark, f"{sf_dir}/orders.parquet", schema).withColumn("missing", F.lit(0))
    gone = read_or_empty(spark, f"{sf_dir}/orders_of_no_year.parquet", schema).withColumn("missing", F.lit(1))
    return here.unionByName(gone).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("missing").cast("int").alias("n_missing"))


# ------------------------------------------------------------------ L16, O2, O4

@register("run_has_metrics", f"""
SELECT 'whole' AS run, (SELECT count(*) FROM ({ORACLE_SQL['zip_price_trends']})) + (SELECT count(*) FROM ({ORACLE_SQL['investor_activity']})) > 0 AS has_metrics
UNION ALL SELECT 'without sales', false""")
def run_has_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with results, and one whose results are all empty."""
    from homestat.sources import history as H
    out = []
    for run, sales in (("whole", P.orders_sales(spark, sf_dir)), ("without sales", P.orders_sales(spark, sf_dir).where("sale_id < 0"))):
        results = M.zip_metrics(sales, P.customer_parcels(spark, sf_dir), as_of=P.AS_OF, zip_pattern=P.NUMERIC_ZIP)
        results = {k: results[k] for k in ("zip_price_trends", "investor_activity")}
        out.append(H.has_metrics(H.run_counts(spark, results, P.AS_OF.date())).select(F.lit(run).alias("run"), "has_metrics"))
    return out[0].unionByName(out[1])


@register("section_order", f"""
SELECT 'prices' AS section, CAST(week AS VARCHAR) AS row, row_number() OVER (ORDER BY week) AS position FROM ({ORACLE_SQL['price_pressure']})
UNION ALL SELECT 'inventory', CAST(week AS VARCHAR), row_number() OVER (ORDER BY week DESC) FROM ({ORACLE_SQL['inventory_absorption']})
UNION ALL SELECT 'price_changes', zip, row_number() OVER (ORDER BY price_now DESC NULLS LAST, zip) FROM ({ORACLE_SQL['zip_price_trends']})""")
def section_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order in which three report sections list their rows."""
    from pyspark.sql import Window

    from homestat.plans import queries as Q
    from homestat.plans import report as X
    sections = {"prices": (X.price_section(Q.QUERIES["price_pressure"](spark, sf_dir)), F.col("week").cast("string")),
                "inventory": (X.inventory_section(Q.QUERIES["inventory_absorption"](spark, sf_dir)), F.col("week").cast("string")),
                "price_changes": (X.price_change_section(Q.QUERIES["zip_price_trends"](spark, sf_dir)), F.col("zip"))}
    out = None
    for name, (section, row) in sections.items():  # a few rows each; ids rise in the order of the rows
        listed = section.select(F.lit(name).alias("section"), row.alias("row"), F.monotonically_increasing_id().alias("_at"))
        listed = listed.select("section", "row", F.row_number().over(Window.partitionBy("section").orderBy("_at")).cast("bigint").alias("position"))
        out = listed if out is None else out.unionByName(listed)
    return out


# ------------------------------------------------------------------ SC2: address matching

_STREETS = ["North Oak Street", "Ocean View Boulevard", "Harbour Drive", "Palm Grove Lane", "Old Mill Road", "Sunset Terrace", "Bay Parkway"]
_PARCEL_SQL = f"""SELECT c_custkey AS account_key, CAST(c_nationkey AS VARCHAR) AS zip, r_name AS region,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE (c_custkey // 3 % 40) || ' ' || {_STREETS!r}[c_custkey % 7 + 1] || CASE WHEN c_custkey % 4 = 0 THEN ' #' || c_custkey % 5 ELSE '' END END AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_RECORD_SQL = f"""SELECT o_orderkey AS record, p.region, p.zip,
  CASE o_orderkey % 4 WHEN 0 THEN o_custkey WHEN 1 THEN -o_custkey END AS account_key,
  CASE o_orderkey // 4 % 8 WHEN 0 THEN lower(address) WHEN 1 THEN substr(address, 1, 4) || substr(address, 6) WHEN 2 THEN substr(address, 1, 5) || 'qx' || substr(address, 6)
    WHEN 3 THEN substr(address, 1, 6) || 'Z' || substr(address, 8) WHEN 4 THEN '  ' || replace(address, ' ', '  ') WHEN 5 THEN 'Unknown Way ' || o_orderkey
    WHEN 6 THEN address || 'xyz' ELSE substr(address, 1, length(address) - 2) END AS address
  FROM orders JOIN ({_PARCEL_SQL}) p ON o_custkey = p.account_key"""
_MATCH_SQL = f"""WITH p AS (SELECT region, substr(trim(zip), 1, 5) AS zip, account_key, {_address_sql('address')} AS a FROM ({_PARCEL_SQL})),
k AS (SELECT region, zip, a, array_to_string(regexp_extract_all(a, '[0-9]+'), ' ') AS d, min(account_key) AS key FROM p WHERE a <> '' GROUP BY ALL),
r AS (SELECT *, array_to_string(regexp_extract_all(a, '[0-9]+'), ' ') AS d FROM (SELECT record, region, zip, account_key, {_address_sql('address')} AS a FROM ({_RECORD_SQL}))),
own AS (SELECT record, account_key AS key FROM r SEMI JOIN p USING (region, account_key)),
same AS (SELECT record, key FROM r JOIN k USING (region, zip, a)),
asked AS (SELECT DISTINCT region, zip, a, d FROM r WHERE a <> ''),
near AS (SELECT q.region, q.zip, q.a, min({{'e': levenshtein(q.a, k.a), 'key': k.key}}) AS best FROM asked q JOIN k ON q.region = k.region AND q.zip = k.zip AND q.d = k.d
         WHERE levenshtein(q.a, k.a) <= 2 GROUP BY ALL)
SELECT r.record, CASE WHEN own.key IS NOT NULL THEN 'account' WHEN same.key IS NOT NULL THEN 'address' WHEN best IS NOT NULL THEN 'near' ELSE 'none' END AS match_kind,
       coalesce(own.key, same.key, best.key) AS match_key, CASE WHEN own.key IS NOT NULL OR same.key IS NOT NULL THEN 0 ELSE best.e END AS match_edits
FROM r LEFT JOIN own USING (record) LEFT JOIN same USING (record) LEFT JOIN near ON near.region = r.region AND near.zip = r.zip AND near.a = r.a"""


def _address_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parcels whose addresses are made of their keys, and sales that give some keys, some wrong ones, and misspelled addresses."""
    c = G._customers(spark, sf_dir)
    n = F.col("c_custkey")
    street = F.element_at(F.array(*map(F.lit, _STREETS)), (n % 7 + 1).cast("int"))
    unit = F.when(n % 4 == 0, F.concat(F.lit(" #"), (n % 5).cast("string"))).otherwise(F.lit(""))
    whole = F.concat(F.expr("c_custkey div 3 % 40").cast("string"), F.lit(" "), street, unit)
    parcels = c.select(n.alias("account_key"), F.col("c_nationkey").cast("string").alias("zip"), F.col("r_name").alias("region"),
                       F.when(n % 11 != 0, whole).alias("address"))
    a, key = F.col("address"), F.col("o_orderkey")
    kind, size = F.expr("o_orderkey div 4 % 8"), F.length("address")
    rest = lambda start: F.substring(a, F.lit(start), size)
    said = (F.when(kind == 0, F.lower(a)).when(kind == 1, F.concat(F.substring(a, 1, 4), rest(6)))
            .when(kind == 2, F.concat(F.substring(a, 1, 5), F.lit("qx"), rest(6))).when(kind == 3, F.concat(F.substring(a, 1, 6), F.lit("Z"), rest(8)))
            .when(kind == 4, F.concat(F.lit("  "), F.replace(a, F.lit(" "), F.lit("  ")))).when(kind == 5, F.concat(F.lit("Unknown Way "), key.cast("string")))
            .when(kind == 6, F.concat(a, F.lit("xyz"))).otherwise(F.substring(a, F.lit(1), size - 2)))
    given = F.when(key % 4 == 0, F.col("o_custkey")).when(key % 4 == 1, -F.col("o_custkey"))
    records = P.table(spark, sf_dir, "orders").join(parcels, F.col("o_custkey") == F.col("account_key")).select(
        key.alias("record"), "region", "zip", given.alias("account_key"), said.alias("address"))
    return records, parcels


@register("address_match", _MATCH_SQL)
def address_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC2/J3: sales to parcels by account, else address, else an address at most two edits away."""
    from homestat.operators.matching import match_parcels
    records, parcels = _address_tables(spark, sf_dir)
    return match_parcels(records, parcels, by=G.BY).select("record", "match_kind", "match_key", "match_edits")


@register("address_match_rates", f"""WITH m AS (SELECT match_kind, region FROM ({_MATCH_SQL}) JOIN (SELECT record, region FROM ({_RECORD_SQL})) USING (record)),
t AS (SELECT region, count(*) AS total FROM m GROUP BY 1)
SELECT region, k AS match_kind, (SELECT count(*) FROM m WHERE m.region = t.region AND m.match_kind = k) AS n,
       (SELECT count(*) FROM m WHERE m.region = t.region AND m.match_kind = k)::DOUBLE / total AS share
FROM t, (VALUES ('account'), ('address'), ('near'), ('none')) AS kinds(k)""")
def address_match_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC2: how many sales of each region were matched in each way."""
    from homestat.operators.matching import match_parcels, match_rates
    return match_rates(match_parcels(*_address_tables(spark, sf_dir), by=G.BY), by=G.BY)
