"""Ordered operators: latest-N, % change, direction, consecutive pairs, ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestat.functions import labels as L
from homestat.operators.splits import GROUP, HOT, PIECE, split_groups


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _orders(order, descending: bool = False) -> list[Column]:
    cols = [F.col(o) for o in _as_list(order)]
    return [c.desc_nulls_last() if descending else c.asc_nulls_last() for c in cols]


def latest_n(df: DataFrame, by, order, n: int, *, newest_first: bool = True) -> DataFrame:
    """Newest `n` rows per group. `row_number() <= n` lets Spark insert a partial
    WindowGroupLimit before the shuffle, so each map task sends at most n rows per group."""
    w = Window.partitionBy(*_as_list(by)).orderBy(*_orders(order, newest_first))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


_ADDED = (GROUP, HOT, PIECE)


def _carried(split: DataFrame, per_piece: Column, across: Column) -> DataFrame:
    """`split` with `_carry`: for rows of a cut group, `across` of `per_piece` over the
    group's pieces in order; NULL for all other rows.

    The joined table has a row per cut group and piece."""
    ends = split.where(F.col(HOT)).groupBy(GROUP, PIECE).agg(per_piece.alias("_end"))
    carry = ends.select(F.col(GROUP).alias("_cg"), F.col(PIECE).alias("_cp"), across.alias("_carry"))
    cond = (F.col(GROUP) == F.col("_cg")) & (F.col(PIECE) == F.col("_cp")) & F.col(HOT)
    return split.join(F.broadcast(carry), cond, "left").drop("_cg", "_cp")


def _key(order) -> Column:
    """The order columns as one value that sorts like them, NULLs last."""
    cols = _as_list(order)
    return F.struct(*[x for i, c in enumerate(cols) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}"))])


def _pieces():
    return Window.partitionBy(GROUP).orderBy(PIECE)


def _all_earlier():
    return _pieces().rowsBetween(Window.unboundedPreceding, -1)


def pct_change(df: DataFrame, by, order, value: str, out: str, *, bounded_groups: bool = False) -> DataFrame:
    """Change vs the previous row of the group, after carrying the last non-null value
    forward (so a gap repeats the last value). Division by zero gives NULL.

    Skew-proof by default: a very large group is cut into pieces by its order column
    (`splits`), and each piece starts its forward fill from the last non-null value of
    the group's earlier pieces. One shuffle. `bounded_groups=True` is for inputs whose
    groups have a proven small size (e.g. after `latest_n`): one plain window.
    """
    by = _as_list(by)
    if bounded_groups:
        w = Window.partitionBy(*by).orderBy(*_orders(order))
        filled = F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        prev = F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return df.withColumn(out, F.try_divide(filled, prev) - F.lit(1.0))
    split = split_groups(df, by, _as_list(order))
    j = _carried(split, F.max_by(F.col(value), F.when(F.col(value).isNotNull(), _key(order))),
                 F.last("_end", ignorenulls=True).over(_all_earlier()))
    w = Window.partitionBy(*by, PIECE).orderBy(*_orders(order))
    filled = F.coalesce(F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                        F.col("_carry"))
    prev = F.coalesce(F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                      F.col("_carry"))
    return j.withColumn(out, F.try_divide(filled, prev) - F.lit(1.0)).drop(*_ADDED, "_carry")


def direction(df: DataFrame, by, order, value: str, out: str = "direction",
              band: float = 0.001, *, bounded_groups: bool = False) -> DataFrame:
    """Up / down / flat vs the previous row with a ±`band` dead zone; first row flat.

    Skew-proof like `pct_change` (the previous row may sit in an earlier piece);
    `bounded_groups=True` uses one plain window for short series."""
    by = _as_list(by)
    if bounded_groups:
        w = Window.partitionBy(*by).orderBy(*_orders(order))
        return df.withColumn(out, L.trend_direction(F.col(value), F.lag(value).over(w), band))
    split = split_groups(df, by, _as_list(order))
    j = _carried(split, F.max_by(F.col(value), _key(order)), F.lag("_end").over(_pieces()))
    w = Window.partitionBy(*by, PIECE).orderBy(*_orders(order))
    # the first row of a piece compares with the carried value; the group's very first
    # row has no carry, so it stays flat
    prev = F.when(F.lag(F.lit(1)).over(w).isNull(), F.col("_carry")).otherwise(F.lag(value).over(w))
    return j.withColumn(out, L.trend_direction(F.col(value), prev, band)).drop(*_ADDED, "_carry")


def rank_by(df: DataFrame, by, order_desc: str, tie: list[str] | None = None, out: str = "rank", *,
            bounded_groups: bool = False) -> DataFrame:
    """1..n by `order_desc` descending (NULLs last), ties broken by `tie` ascending.

    Neither a global rank (`by` empty) nor a very large group funnels through one task:
    both are cut into pieces by value (`splits`), rows are numbered inside a piece and
    start after the rows of the earlier pieces. One shuffle. `bounded_groups=True`: one
    plain window, for groups of a proven small size."""
    by = _as_list(by)
    order = [F.col(order_desc).desc_nulls_last()] + [F.col(t).asc() for t in (tie or [])]
    if bounded_groups:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))
    split = split_groups(df, by, order_desc, tie or (), descending=True)
    j = _carried(split, F.count(F.lit(1)), F.sum("_end").over(_all_earlier()))
    place = F.row_number().over(Window.partitionBy(*by, PIECE).orderBy(*order))
    return j.withColumn(out, (place + F.coalesce(F.col("_carry"), F.lit(0))).cast("bigint")).drop(*_ADDED, "_carry")


def consecutive_pairs(df: DataFrame, by, order: str, tie: list[str], carry: list[str],
                      first_prefix: str = "first_", second_prefix: str = "second_") -> DataFrame:
    """Pair every row with the next row of its group (by `order` asc, NULLs last, then `tie`).

    Output: group keys, then first_/second_ copies of `order` and `carry`. `tie`
    should make the order unique (rows that tie completely are interchangeable).

    Skew-proof: `lead` runs inside (group, piece), a very large group being cut by its
    order column (`splits`). The pair that straddles a cut comes from the last row of
    one piece and the first of the group's next: a table of a row per piece of such a
    group. One shuffle.
    """
    by = _as_list(by)
    vals = [order] + [c for c in carry if c != order]
    extra_tie = [t for t in tie if t not in vals and t not in by]
    split = split_groups(df.select(*by, *vals, *extra_tie), by, order, tie)

    w = Window.partitionBy(*by, PIECE).orderBy(*_orders(order), *[F.col(t).asc() for t in tie])
    nxt = [F.lead(c).over(w).alias(f"_next_{c}") for c in vals]
    has_next = F.lead(F.lit(1)).over(w).alias("_has_next")
    inside = (split.select(*by, *vals, *nxt, has_next).where(F.col("_has_next").isNotNull())
              .select(*by, *[F.col(c).alias(first_prefix + c) for c in vals],
                      *[F.col(f"_next_{c}").alias(second_prefix + c) for c in vals]))

    key = F.struct(_key(order).alias("_o"), *[F.col(t).alias(f"_t_{t}") for t in tie])
    row = F.struct(*[F.col(c) for c in vals])
    ends = split.where(F.col(HOT)).groupBy(GROUP, PIECE, *by).agg(
        F.min_by(row, key).alias("_first"), F.max_by(row, key).alias("_last"))
    across = ends.select(*by, "_last", F.lead("_first").over(_pieces()).alias("_next")).where(F.col("_next").isNotNull())
    across = across.select(*by, *[F.col(f"_last.{c}").alias(first_prefix + c) for c in vals],
                           *[F.col(f"_next.{c}").alias(second_prefix + c) for c in vals])
    return inside.unionByName(across)
