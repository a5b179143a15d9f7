"""Source health derived from the data itself (rows, newest date, freshness)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATUS_OK = "OK"
STATUS_FAILED = "FAILED"


def source_health(sources: dict, as_of: dt.datetime, *, max_age_days: int | None = None,
                  spark: SparkSession | None = None) -> DataFrame:
    """One row per source: row_count, newest, age_days, status, plus the run-level
    `degraded` flag (every source failed) and `healthy_sources` count.

    `sources` maps a name to `(DataFrame, date_column or None)`, or to None for a source
    that was expected and not found. A source fails when it is not there, has no rows or,
    with `max_age_days`, when its newest row is older.
    Each source is one partial aggregate; the union is a handful of rows.
    """
    parts = []
    spark = spark or next(s[0].sparkSession for s in sources.values() if s is not None)
    missing = spark.createDataFrame([], "x int")
    for name, source in sources.items():
        df, date_col = source or (missing, None)
        newest = F.max(F.col(date_col)).cast("timestamp_ntz") if date_col else F.lit(None).cast("timestamp_ntz")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), newest.alias("newest"))
                     .select(F.lit(name).alias("source"), "row_count", "newest"))
    out = reduce(DataFrame.unionByName, parts)
    as_of_lit = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    out = out.withColumn("age_days", F.timestamp_diff("DAY", F.col("newest"), as_of_lit).cast("bigint"))
    failed = F.col("row_count") == 0
    if max_age_days is not None:
        failed = failed | (F.col("age_days") > max_age_days)
    out = out.withColumn("status", F.when(failed, F.lit(STATUS_FAILED)).otherwise(F.lit(STATUS_OK)))
    everything = Window.partitionBy()
    return (out.withColumn("healthy_sources", F.count_if(F.col("status") == STATUS_OK).over(everything))
            .withColumn("degraded", F.col("healthy_sources") == 0))
