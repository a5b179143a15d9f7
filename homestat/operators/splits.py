"""Data-determined splits of large groups: the building block of the ordered operators.

A group that holds a large part of the rows must not be sorted in one task. One pass over
a thin sample, chosen by a hash of the rows, finds the groups of more than about
`HOT_ROWS` rows, and up to `PIECES - 1` sample rows of each that cut its sort order (the
order columns, then the tie-breakers, then a hash of the row) into pieces of about equal
size. A row's piece depends on its own values only, so every branch of a plan and every
retried task agree on it; rows of all other groups are in piece 0. An operator then works
inside (group, piece) and carries what crosses a cut in a table of a row per piece.

Columns of every sortable type can be cut, and a group whose order values are all equal is
cut by its tie-breakers. Rows that are equal in every column stay together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP, PIECE, HOT = "_group", "_piece", "_hot"
HOT_ROWS = 1_000_000  # a group of more rows is cut
PIECES = 64
SAMPLE = 1024  # rows that a group of `HOT_ROWS` has in the sample
_MOST = 4 * SAMPLE  # rows of one group that the cuts are chosen from


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL keys match each other (group keys, not entity keys)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, on=cond, how=how).drop(*[f"_r_{k}" for k in keys])


def group_hash(by: list[str]) -> Column:
    return F.xxhash64(*[F.col(b) for b in by]) if by else F.lit(0).cast("long")


def _cuts(df: DataFrame, by: list[str], sort: list[str], descending: bool) -> DataFrame:
    """Per very large group (`_g`) the sample rows that cut it, as an array of at most `PIECES` structs.

    One row per group of more than about `HOT_ROWS` rows: at most a millionth of the input."""
    rate = max(1, HOT_ROWS // SAMPLE)
    keys = [F.col(c).alias(f"s{i}") for i, c in enumerate(sort)]
    sample = df.select(group_hash(by).alias("_g"), *keys, F.xxhash64(*df.columns).alias("h"))
    sample = sample.where(F.pmod("h", F.lit(rate)) == 0)
    by_hash = F.row_number().over(Window.partitionBy("_g").orderBy(F.xxhash64("h"), "h"))
    sample = sample.withColumn("_rn", by_hash).where(F.col("_rn") <= _MOST)
    order = [F.col("s0").desc_nulls_last() if descending else F.col("s0").asc_nulls_last()]
    order += [F.col(f"s{i}").asc_nulls_last() for i in range(1, len(sort))] + [F.col("h")]
    place = F.row_number().over(Window.partitionBy("_g").orderBy(*order))
    sample = sample.withColumns({"_at": place, "_n": F.count(F.lit(1)).over(Window.partitionBy("_g"))})
    step = lambda at: F.floor(at * PIECES / F.col("_n"))
    picked = sample.where((F.col("_n") >= 0.9 * HOT_ROWS / rate) & (F.col("_at") < F.col("_n"))
                          & (step(F.col("_at")) > step(F.col("_at") - 1)))
    return picked.groupBy("_g").agg(F.collect_list(F.struct(*[f"s{i}" for i in range(len(sort))], "h")).alias("_cuts"))


def _precedes(cut: Column, sort: list[str], row_hash: Column, descending: bool) -> Column:
    """Whether a cut comes before the row in the sort order (NULLs last)."""
    steps = []
    for i, c in enumerate(sort):
        a, b = cut[f"s{i}"], F.col(c)
        less = (a > b) if descending and i == 0 else (a < b)
        steps.append((F.coalesce(less, F.lit(False)) | (a.isNotNull() & b.isNull()), a.eqNullSafe(b)))
    return reduce(lambda after, s: s[0] | (s[1] & after), reversed(steps), cut["h"] < row_hash)


def split_groups(df: DataFrame, by: list[str], order, tie=(), *, descending: bool = False) -> DataFrame:
    """Add `_group`, `_piece` (ascending in the sort order, NULLs last) and `_hot`.

    The sort order is `order` (its first column descending if asked), then `tie`. Without
    group keys the whole table is one group."""
    sort = [order] if isinstance(order, str) else list(order)
    sort += [t for t in tie if t not in sort]
    cuts, out = _cuts(df, by, sort, descending), df.withColumn(GROUP, group_hash(by))
    if by:
        out = out.join(F.broadcast(cuts), F.col(GROUP) == F.col("_g"), "left").drop("_g")  # a row per very large group
    else:
        out = out.withColumn("_cuts", cuts.select("_cuts").scalar())
    piece = F.size(F.filter("_cuts", lambda c: _precedes(c, sort, F.xxhash64(*df.columns), descending)))
    return (out.withColumn(HOT, F.col("_cuts").isNotNull())
            .withColumn(PIECE, F.when(F.col(HOT), piece).otherwise(F.lit(0))).drop("_cuts"))
