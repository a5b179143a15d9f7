"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``class``, the smallest id that links (``a``, ``b``) connect it with.

    Every round each node takes the smallest class among its own and its neighbours',
    then the class of that class, so chains shorten by halves. The table of a round is
    written before the next; a count of changes is all that reaches the driver.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    classes = staged(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("class")))
    while True:
        near = both.join(classes, both["b"] == classes["id"]).groupBy("a").agg(F.min("class").alias("near"))
        new = classes.join(near, classes["id"] == near["a"]).select("id", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        up = classes.select(F.col("id").alias("_of"), F.col("class").alias("_up"))
        new = staged(new.join(up, F.col("class") == F.col("_of"), "left").select(
            "id", "old", F.least("class", F.coalesce("_up", "class")).alias("class")))
        changed = new.where("class <> old").limit(1).count()
        classes = new.select("id", "class")
        if not changed:
            return classes


def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` after more ``links``: only the classes that these touch are looked at again."""
    known = classes.select(F.col("id").alias("_id"), F.col("class").alias("_class"))

    def classed(df: DataFrame, end: str) -> DataFrame:
        both = df.join(known, F.col(end) == F.col("_id"), "left")
        return both.withColumn(end, F.coalesce("_class", end)).drop("_id", "_class")

    merged = components(classed(classed(links, "a"), "b").where("a <> b").distinct())
    merged = merged.select(F.col("id").alias("_id"), F.col("class").alias("_class"))
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).distinct().join(classes, "id", "left_anti")
    rows = classes.unionByName(ends.withColumn("class", F.col("id")))
    return staged(rows.join(merged, F.col("class") == F.col("_id"), "left").select("id", F.coalesce("_class", "class").alias("class")))
