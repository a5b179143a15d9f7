"""Run history: per-metric row counts per run, retention, run-over-run change.

The history is a table `(run_date DATE, region STRING, metric STRING, n BIGINT)`
partitioned by `run_date` and `region`; writing a region's run replaces only that
partition, so runs of several regions share a folder.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.functions.scalars import stem_date

HISTORY_JSON_SCHEMA = "run_date string, metric_counts map<string,bigint>"


# The results of a run, in the order of the run; the last two are not tables.
RUN_RESULTS = ("price_pressure", "inventory_absorption", "buyer_value_index", "trend_lines", "zip_price_trends",
               "assessment_ratio", "investor_activity", "flip_detector", "flip_summary", "market_snapshot")
NOT_TABLES = ("flip_summary", "market_snapshot")


ALL_REGIONS = "ALL"


def run_counts(spark: SparkSession, results: dict, run_date: dt.date, regions: DataFrame | None = None) -> DataFrame:
    """K2: the counts of a weekly run: every result of `RUN_RESULTS`, 0 where it is
    missing or not a table. With `regions` (a column `region`), for each of them."""
    tables = {name: results.get(name) if name not in NOT_TABLES else None for name in RUN_RESULTS}
    return metric_counts(spark, tables, run_date, regions)


def metric_counts(spark: SparkSession, results: dict, run_date: dt.date, regions: DataFrame | None = None) -> DataFrame:
    """One row per result — its row count, 0 for non-table results.

    With `regions`, one row per region and result: the rows that carry the region. The
    counts are aggregates unioned into one plan: one job, nothing collected."""
    parts = []
    if regions is not None:
        expected = regions.select("region").distinct().select("region", F.explode(F.array(*map(F.lit, results))).alias("metric"))
        tables = {k: v for k, v in results.items() if isinstance(v, DataFrame)}
        rows = [v.groupBy("region").agg(F.count(F.lit(1)).alias("n")).select("region", F.lit(k).alias("metric"), "n") for k, v in tables.items()]
        out = expected.withColumn("n", F.lit(0).cast("bigint"))
        if rows:
            out = expected.join(reduce(DataFrame.unionByName, rows), ["region", "metric"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
        return out.select(F.lit(run_date.isoformat()).cast("date").alias("run_date"), "region", "metric", "n")
    for name, value in results.items():
        if isinstance(value, DataFrame):
            parts.append(value.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n"))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("metric"), F.lit(0).cast("bigint").alias("n")))
    if not parts:
        return spark.createDataFrame([], "run_date date, metric string, n bigint")
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(run_date.isoformat()).cast("date").alias("run_date"), "metric", "n")


def has_metrics(counts: DataFrame) -> DataFrame:
    """One row telling whether the run produced any metric at all (a row in any result)."""
    return counts.agg((F.coalesce(F.sum("n"), F.lit(0)) > 0).alias("has_metrics"))


def record_run(counts: DataFrame, path: str, region: str = ALL_REGIONS) -> None:
    """K2: write the run's counts, replacing only its own (`run_date`, `region`) partitions.

    Counts without a region column are those of `region`."""
    counts = counts if "region" in counts.columns else counts.withColumn("region", F.lit(region))
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date", "region").parquet(path))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The recorded history table (partition columns restored as DATE and text)."""
    rows = spark.read.parquet(path)
    return rows.select(F.col("run_date").cast("date").alias("run_date"), F.col("region").cast("string").alias("region"), "metric", "n")


def read_history_json(spark: SparkSession, pattern: str) -> DataFrame:
    """Run-summary JSON files `{run_date: 'YYYYMMDD', metric_counts: {...}}` -> long.

    `pattern` should match only dated files (e.g. `history_*.json`), never a
    'latest' copy, or that run is counted twice."""
    raw = spark.read.schema(HISTORY_JSON_SCHEMA).option("multiLine", True).json(pattern)
    return (raw.select(F.try_to_date("run_date", "yyyyMMdd").alias("run_date"),
                       F.explode("metric_counts").alias("metric", "n"))
            .where(F.col("run_date").isNotNull()))


def history_files(spark: SparkSession, directory: str) -> DataFrame:
    """Dated history files in a folder with the date parsed from the stem (K3 input)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "history_*.json").load(directory) \
        .select("path")
    stem = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    return files.select("path", stem_date(stem).alias("run_date"))


def expire_history(history: DataFrame, as_of: dt.date, days: int = 28, date_col: str = "run_date"):
    """K3: (kept, expired) — a run expires when it is more than `days` days old.

    Rows without a parseable date are kept (they are ignored, never deleted)."""
    age = F.date_diff(F.lit(as_of.isoformat()).cast("date"), F.col(date_col))
    expired_cond = age > days
    kept = history.where(~expired_cond | F.col(date_col).isNull())
    expired = history.where(expired_cond)
    return kept, expired


def drop_expired(spark: SparkSession, path: str, as_of: dt.date, days: int = 28) -> list[dt.date]:
    """K3 on a stored history: delete the folders of expired runs; returns their dates.

    A run is a folder of its own (`run_date=…`), so nothing is rewritten; the dates of
    the expired runs are all that is collected."""
    _, expired = expire_history(read_history(spark, path), as_of, days=days)
    dates = [r["run_date"] for r in expired.select("run_date").distinct().orderBy("run_date").collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for d in dates:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/run_date={d.isoformat()}")
        folder.getFileSystem(conf).delete(folder, True)
    return dates


def metric_trend(history: DataFrame) -> DataFrame:
    """Change of each metric's count vs its previous run (of its region, where runs have one)."""
    w = Window.partitionBy(*[c for c in ("region", "metric") if c in history.columns]).orderBy("run_date")
    return (history.withColumn("prev_n", F.lag("n").over(w))
            .withColumn("delta", F.col("n") - F.col("prev_n")))


def latest_run(history: DataFrame) -> DataFrame:
    """The newest run's rows ('latest' is a view over the table, not a second copy); of each
    region its newest, where runs have one."""
    if "region" in history.columns:
        newest = history.groupBy(F.col("region").alias("_r")).agg(F.max("run_date").alias("_d"))
        return history.join(newest, F.col("region").eqNullSafe(F.col("_r")) & (F.col("run_date") == F.col("_d"))).drop("_d", "_r")
    newest = history.agg(F.max("run_date").alias("_d"))
    return history.join(F.broadcast(newest), F.col("run_date") == F.col("_d")).drop("_d")
