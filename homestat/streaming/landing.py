"""Incremental ingestion of landed crosstab files with Structured Streaming.

The weekly pipeline is a batch job over files that arrive in a landing folder.
Running the cleaning as a file-source stream with `trigger(availableNow=True)`
turns it into an exactly-once incremental batch: the checkpoint remembers which
files were processed, a restarted job (or a lost executor) resumes from it, and
every run cleans only the new files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.functions.scalars import clean_number, parse_us_date
from homestat.sources.readers import BINARY_SCHEMA, WEEKLY_COLUMNS


def weekly_text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def clean_weekly_batch(raw: DataFrame, region: str = "ALL") -> DataFrame:
    """Same typing as `read_weekly`, plus the source file of every row."""
    cols = [F.lit(region).alias("region"), F.col("_source").alias("source_file"),
            parse_us_date(F.col("`Period End`")).alias("period_end")]
    for src, dst in WEEKLY_COLUMNS.items():
        if src in raw.columns:
            cols.append(clean_number(F.col(f"`{src}`")).alias(dst))
    return raw.select(*cols).where(F.col("period_end").isNotNull())


def start_weekly_ingest(spark: SparkSession, landing_dir: str, output_dir: str, checkpoint: str,
                        columns: list[str], *, region: str = "ALL", available_now: bool = True):
    """Stream new CSV files from `landing_dir` into a cleaned parquet table.

    Returns the StreamingQuery; with `available_now` it stops by itself once
    every file present at start has been processed."""
    stream = (spark.readStream.schema(weekly_text_schema(columns)).option("header", True)
              .csv(landing_dir).withColumn("_source", F.col("_metadata.file_name")))
    cleaned = clean_weekly_batch(stream, region)
    writer = (cleaned.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .option("path", output_dir).partitionBy("region").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


# ------------------------------------------------------------------ files of any encoding

def decoded_lines(files: DataFrame) -> DataFrame:
    """Binary files as lines: `source_file`, `header` (names) and `fields` (texts) per data line.

    The byte-order mark names the encoding (UTF-16 of either order, else UTF-8); a header with
    a tab is tab-separated. Every file has its own header, so columns may come, go and move."""
    mark = F.hex(F.substring(F.col("content"), 1, 2))
    text = F.when(mark.isin("FFFE", "FEFF"), F.decode(F.col("content"), "UTF-16")).otherwise(F.decode(F.col("content"), "UTF-8"))
    lines = F.split(F.regexp_replace(text, "^﻿", ""), "\r\n|\n|\r")
    rows = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"), lines.alias("_lines"))
    rows = rows.select("source_file", F.col("_lines")[0].alias("_head"), F.explode(F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(0)))).alias("_line"))
    outside_quotes = '(?=(?:[^"]*"[^"]*")*[^"]*$)'
    tabbed = F.contains("_head", F.lit("\t"))
    def parts(c: str) -> Column:
        return F.transform(F.when(tabbed, F.split(c, "\t" + outside_quotes)).otherwise(F.split(c, "," + outside_quotes)),
                           lambda x: F.replace(x, F.lit('"'), F.lit("")))
    return rows.where(F.trim("_line") != "").select("source_file", F.transform(parts("_head"), F.trim).alias("header"),
                                                    parts("_line").alias("fields"), F.col("_line").alias("line"))


def _field(name: str) -> Column:
    at = F.array_position("header", name)
    return F.when(at > 0, F.get("fields", (at - 1).cast("int")))


def clean_weekly_lines(lines: DataFrame, region: str = "ALL") -> DataFrame:
    """All weekly columns of decoded lines; a column that a file lacks is NULL. `line` is the text as it came."""
    cols = {dst: clean_number(_field(src)) for src, dst in WEEKLY_COLUMNS.items()}
    return lines.select(F.lit(region).alias("region"), "source_file", parse_us_date(_field("Period End")).alias("period_end"),
                        *[c.alias(n) for n, c in cols.items()], "line")


def start_mixed_ingest(spark: SparkSession, landing_dir: str, output_dir: str, quarantine_dir: str, checkpoint: str, *,
                       region: str = "ALL", files_per_batch: int = 1000, available_now: bool = True):
    """Stream crosstab files of any encoding and header into a cleaned table, each file once.

    Lines whose week does not parse go to `quarantine_dir` with their file and text. Each batch
    writes its own partition `batch`, replacing it if it is run again after a failure, so
    a restart neither loses nor repeats a row. A file is decoded by one task (crosstabs are small)."""
    def write(batch: DataFrame, number: int) -> None:
        rows = clean_weekly_lines(decoded_lines(batch), region).persist()
        good, bad = F.col("period_end").isNotNull(), F.col("period_end").isNull()
        rows.where(good).drop("line").write.mode("overwrite").parquet(f"{output_dir}/batch={number}")
        rows.where(bad).select("region", "source_file", "line").write.mode("overwrite").parquet(f"{quarantine_dir}/batch={number}")
        rows.unpersist()

    files = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", files_per_batch).load(landing_dir).select("path", "content"))
    writer = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
