"""Scans of the landed source files and their cleaning into the metric vocabulary.

* S1 wide monthly index CSV (metadata columns + one column per month end)
* S2 weekly crosstab CSV (UTF-8, quoted numbers with thousands separators)
* S3 the same crosstab exported as UTF-16 + tab (detected by its byte-order mark)
* S4 county parcels / deed sales (Latin-1, every column read as text)
* S5 discovery of the newest fresh file per metric in a landing folder
* M13 cleaning: region / city / deed filters, column selection, typed columns
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.functions.scalars import (clean_number, discovery_name, normalize_account, parse_timestamp,
                                        parse_us_date, strip_ws, to_number)
from homestat.operators.relational import date_columns, select_existing

# Source column names of the weekly crosstabs -> cleaned names.
WEEKLY_COLUMNS = {
    "Median Sale Price": "median_price",
    "Median Sale Price Yoy": "price_yoy",
    "Average Sale To List Ratio": "sale_to_list",
    "Average Sale To List Ratio Yoy": "sale_to_list_yoy",
    "Adjusted Average Homes Sold": "homes_sold",
    "Adjusted Average Homes Sold Yoy": "homes_sold_yoy",
    "Adjusted Average New Listings": "new_listings",
    "Adjusted Average New Listings Yoy": "new_listings_yoy",
    "Months Of Supply": "supply",
    "Months Of Supply Yoy": "supply_yoy_abs",
    "Median Days To Close": "days_to_close",
    "Median Days To Close Yoy": "days_to_close_yoy",
}

# File-name patterns per weekly metric (matched on the lower-cased
# name with '_' read as ' '; the first matching key wins).
DISCOVERY_PATTERNS = {
    "median_sale_price": ["median sale price", "median_sale_price"],
    "homes_sold": ["homes sold", "homes_sold"],
    "new_listings": ["new listings", "new_listings"],
    "days_to_close": ["days to close", "days_to_close"],
    "weeks_of_supply": ["weeks of supply", "months of supply", "weeks_of_supply"],
    "avg_sale_to_list": ["average sale to list", "avg sale to list", "sale to list ratio"],
}

# Parcel columns kept by the cleaning step, in this order.
PARCEL_COLUMNS = ["ACCOUNT", "LOCN", "LOCS", "LOCD", "UNIT", "LOCCITY", "LOCZIP", "LIVING", "BEDR", "BATH",
                  "YRBL", "JUST", "ASSD", "SALE_AMT", "SALE_DATE", "HOMESTEAD"]

# Metadata (non-month) columns of the wide monthly index files.
INDEX_ID_COLUMNS = ["RegionID", "SizeRank", "RegionName", "RegionType", "StateName", "State", "Metro",
                    "StateCodeFIPS", "MunicipalCodeFIPS"]


BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                  **options) -> DataFrame:
    """A missing path gives an empty frame with the expected schema."""
    found = or_none(lambda: spark.read.format(fmt).options(**options).schema(schema).load(path))
    return spark.createDataFrame([], schema) if found is None else found


def or_none(scan):
    """What `scan` reads, or None where there is nothing (no path, or no file in it)."""
    try:
        return scan()
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _text_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV with a header, every column as text (no inference pass over the data)."""
    return spark.read.options(header=True, inferSchema=False, **options).csv(path)


# ------------------------------------------------------------------ S1

def read_index_wide(spark: SparkSession, path: str, *, state: str | None = None,
                    region_name: str | None = None) -> DataFrame:
    """Wide monthly index; optional state / region-name filter; month
    columns typed DOUBLE, ids kept as text."""
    df = _text_csv(spark, path)
    if state is not None:
        df = df.where(F.col("StateName") == state)
    if region_name is not None:
        df = df.where(F.col("RegionName") == region_name)
    ids = [c for c in df.columns if c in INDEX_ID_COLUMNS]
    months = date_columns(df)  # P5: columns named like a date, in name order
    return df.select(*ids, F.col("RegionName").alias("region") if "RegionName" in ids else F.lit(None).alias("region"),
                     *[to_number(F.col(f"`{c}`")).alias(c) for c in months])


# ------------------------------------------------------------------ S2, S3

def bom_encoding(spark: SparkSession, paths) -> dict[str, list[str]]:
    """Encoding -> files, from the first two bytes of each file: UTF-16LE/BE by BOM, else UTF-8.

    Only the listing and two bytes a file are read, on the driver; empty files are left out."""
    files = spark.read.format("binaryFile").load(paths).where("length > 0").select("path").collect()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: dict[str, list[str]] = {}
    for row in files:
        path = jvm.org.apache.hadoop.fs.Path(row["path"])
        stream = path.getFileSystem(conf).open(path)
        try:
            head = (stream.read(), stream.read())
        finally:
            stream.close()
        encoding = {(0xFF, 0xFE): "UTF-16LE", (0xFE, 0xFF): "UTF-16BE"}.get(head, "UTF-8")
        out.setdefault(encoding, []).append(row["path"])
    return out


def _weekly_text(spark: SparkSession, path, encoding: str) -> DataFrame:
    """A crosstab as text columns. UTF-16 exports are tab separated. With a known byte
    order they are read line by line with an explicit line separator, which keeps large
    files splittable across tasks; a plain 'UTF-16' needs `multiLine` (one task per file)."""
    enc = encoding.upper()
    if enc in ("UTF-16LE", "UTF-16BE"):
        raw = _text_csv(spark, path, sep="\t", encoding=enc, lineSep="\n")
    elif enc.startswith("UTF-16"):
        raw = _text_csv(spark, path, sep="\t", encoding=encoding, multiLine=True)
    else:
        raw = _text_csv(spark, path, encoding=encoding)
    return raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns])


def read_weekly(spark: SparkSession, path, *, region: str = "ALL", encoding: str = "UTF-8") -> DataFrame:
    """Weekly crosstab files of one encoding -> (region, period_begin, period_end, metric columns…)."""
    raw = _weekly_text(spark, path, encoding)
    cols = [F.lit(region).alias("region")]
    if "Period Begin" in raw.columns:
        cols.append(parse_us_date(F.col("`Period Begin`")).alias("period_begin"))
    cols.append(parse_us_date(F.col("`Period End`")).alias("period_end"))
    for src, dst in WEEKLY_COLUMNS.items():
        if src in raw.columns:
            cols.append(clean_number(F.col(f"`{src}`")).alias(dst))
    return raw.select(*cols).where(F.col("period_end").isNotNull())


def read_weekly_detect(spark: SparkSession, path, *, region: str = "ALL") -> DataFrame:
    """S3: crosstabs whatever their encoding; files of one folder may differ in it."""
    parts = [read_weekly(spark, files, region=region, encoding=enc)
             for enc, files in sorted(bom_encoding(spark, path).items())]
    if not parts:
        return spark.createDataFrame([], "region string, period_end date")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def rejected_weeks(spark: SparkSession, path) -> DataFrame:
    """`Period End` of the rows where it does not parse (they are dropped, and counted here)."""
    parts = [_weekly_text(spark, files, enc).select(F.col("`Period End`").alias("period_end"))
             for enc, files in sorted(bom_encoding(spark, path).items())]
    if not parts:
        return spark.createDataFrame([], "period_end string")
    return reduce(DataFrame.unionByName, parts).where(parse_us_date(F.col("period_end")).isNull())


# ------------------------------------------------------------------ S4, M13

def read_county(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 county CSV, all text."""
    return _text_csv(spark, path, encoding="ISO-8859-1")


def clean_parcels(raw: DataFrame, *, city: str | None = None) -> DataFrame:
    """Parcels of one city (trimmed, upper-cased match), the listed
    columns that exist, typed into the metric vocabulary."""
    df = raw
    if city is not None:
        df = df.where(F.upper(strip_ws(F.col("LOCCITY"))) == city.upper())
    df = select_existing(df, PARCEL_COLUMNS)
    have = set(df.columns)
    opt = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    cols = [F.col("ACCOUNT").alias("account"), normalize_account(F.col("ACCOUNT")).alias("account_key"),
            opt("LOCZIP").alias("zip"), to_number(opt("LIVING")).alias("living"), to_number(opt("JUST")).alias("just"),
            to_number(opt("BEDR")).alias("beds"), opt("LOCN").alias("locn"), opt("LOCS").alias("locs"),
            opt("LOCD").alias("locd"), opt("UNIT").alias("unit")]
    if "HOMESTEAD" in have:
        cols.append(F.col("HOMESTEAD").alias("homestead"))
    return df.select(*cols)


def clean_sales(raw: DataFrame, *, deed_type: str | None = "WD") -> DataFrame:
    """Warranty-deed sales with typed date and price. `sale_id` is a hash
    of the row, a deterministic tie-breaker for same-day sales of one account."""
    df = raw if deed_type is None else raw.where(F.col("DeedType") == deed_type)
    return df.select(F.col("Account").alias("account"), normalize_account(F.col("Account")).alias("account_key"),
                     parse_timestamp(F.col("SaleDate")).alias("sale_date"),
                     to_number(F.col("SalePrice")).alias("sale_price"),
                     F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]).alias("sale_id"))


# ------------------------------------------------------------------ S5

def list_files(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """File listing (path, name, modificationTime, length); contents are not read. A
    missing folder lists nothing."""
    files = read_or_empty(spark, directory, BINARY_SCHEMA, "binaryFile", pathGlobFilter=glob)
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "modificationTime", "length")


def discover(files: DataFrame, as_of: dt.datetime, *, patterns: dict | None = None,
             max_age_days: int = 7) -> DataFrame:
    """Newest fresh file per metric key, plus `complete` (all keys found).

    Files older than `max_age_days` at `as_of` are skipped; a file matches the
    first key (in pattern order) one of whose patterns its normalised name contains."""
    patterns = patterns or DISCOVERY_PATTERNS
    name = discovery_name(F.col("name"))
    key = None
    for k, pats in patterns.items():
        cond = None
        for p in pats:
            c = name.contains(p)
            cond = c if cond is None else cond | c
        key = F.when(cond, F.lit(k)) if key is None else key.when(cond, F.lit(k))
    cutoff = F.lit((as_of - dt.timedelta(days=max_age_days)).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    fresh = files.where(F.col("modificationTime") >= cutoff).withColumn("key", key).where(F.col("key").isNotNull())
    w = Window.partitionBy("key").orderBy(F.col("modificationTime").desc(), F.col("path"))
    best = fresh.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    n_keys = len(patterns)
    return best.withColumn("complete", F.count(F.lit(1)).over(Window.partitionBy()) == n_keys)


# ------------------------------------------------------------------ K1, K4

def write_table(df: DataFrame, path: str, *, partition_by=("region",), mode: str = "overwrite") -> None:
    """K1: cleaned table as parquet, partitioned (dynamic overwrite keeps other partitions).

    Rows of a partition are brought together before the write, in pieces of even size
    where there are many (a rebalancing shuffle), so no task writes a file for each."""
    cols = [c for c in partition_by if c in df.columns]
    w = (df.hint("rebalance", *cols) if cols else df).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*cols) if cols else w).parquet(path)


def write_partition(df: DataFrame, root: str, keys: dict[str, str]) -> None:
    """K1/K4: `df` as the one partition of the table at `root` that `keys` name, replacing it whole.

    Rows are not looked at for their keys, so a partition that has become empty is emptied."""
    folder = "/".join(f"{k}={quote(v, safe=' ')}" for k, v in keys.items())
    df.drop(*keys).hint("rebalance").write.mode("overwrite").parquet(f"{root}/{folder}")


def archive_sections(sections: dict, root: str, run_date: dt.date, region: str | None = None) -> None:
    """K4: every report section table under `root/<name>/run_date=…` (never expired).

    With `region`, the sections are those of one region: each (run, region) is a folder of
    its own, and another region's run on the same day leaves it as it is."""
    for name, df in sections.items():
        if region is not None:
            write_partition(df, f"{root}/{name}", {"run_date": run_date.isoformat(), "region": region})
        else:
            write_table(df.withColumn("run_date", F.lit(run_date.isoformat()).cast("date")), f"{root}/{name}", partition_by=("run_date",))
