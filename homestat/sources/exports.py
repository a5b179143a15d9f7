"""Writers for the landed file formats the scans read (the inverse of `readers`).

Used to publish cleaned data in the shapes downstream tools expect, and to land
Spark-derived data in those formats so the scans run over data that grows with
the tables. Files go under the shared folder from `scratch_path`, never a
machine-local one (outside tests).
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.session import checkpoint_dir


_MADE: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder; removed when Python ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_remove_made)
    _MADE.append((spark, path))
    return path


def _remove_made() -> None:
    for spark, path in _MADE:
        if spark.sparkContext._jsc is None:  # the session has ended: its folder is the cluster's to clean
            return
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def us_date_text(c) -> F.Column:
    """DATE -> 'M/d/yyyy' text."""
    return F.date_format(c, "M/d/yyyy")


def write_weekly_csv(df: DataFrame, path: str, *, encoding: str = "UTF-8") -> None:
    """Crosstab text file(s): header, all values as text; UTF-16 exports are tab separated."""
    sep = "\t" if encoding.upper().startswith("UTF-16") else ","
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding) \
        .option("quoteAll", False).csv(path)


def write_county_csv(df: DataFrame, path: str) -> None:
    """County extract: Latin-1 CSV with a header."""
    df.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)


def write_history_json(counts: DataFrame, path: str) -> None:
    """One JSON document per run: {run_date: 'YYYYMMDD', metric_counts: {metric: n}}.

    Each run's metrics (a handful) are gathered into a map; partitioning by the
    run key puts every run in its own file."""
    runs = counts.groupBy(F.date_format("run_date", "yyyyMMdd").alias("run_date")).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "n"))).alias("metric_counts"))
    runs.withColumn("run_key", F.col("run_date")).write.mode("overwrite").partitionBy("run_key").json(path)
