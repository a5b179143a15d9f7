"""Time of the exact median for a group holding a third of all rows, cut and uncut.

usage: python scripts/skew_check.py [rows] [partitions]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from homestat.operators import splits  # noqa: E402
from homestat.operators.aggregates import group_median  # noqa: E402
from homestat.session import build_session  # noqa: E402


def main():
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 64
    spark = build_session("local[8]", parts, extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 1000).cast("string")))
        .alias("g"), (F.rand(7) * 1e6).alias("v"))
    for hot_rows in (splits.HOT_ROWS, rows):
        splits.HOT_ROWS = hot_rows
        t0 = time.perf_counter()
        group_median(df, "g", "v", out="m").write.format("noop").mode("overwrite").save()
        print(f"median, groups cut from {hot_rows:,} rows: {time.perf_counter() - t0:.1f}s")
    spark.stop()


if __name__ == "__main__":
    main()
