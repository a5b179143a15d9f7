"""Grouped aggregates: exact median, fixed-point mean, shares, arg-extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.operators import splits
from homestat.operators.splits import null_safe_join


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


_FINE = 4096  # buckets a step of e in size
_ABOVE = 4_000_000  # over 745 * _FINE, so that the buckets of positive numbers are positive


def _bucket(v: Column) -> Column:
    """A whole number that never falls as `v` rises: the logarithm's steps of 1 / `_FINE`, mirrored below zero.

    NaN sorts above all numbers, as in Spark's own order."""
    step = lambda x: F.floor(F.log(x) * _FINE).cast("long") + _ABOVE
    far = F.lit(4 * _ABOVE).cast("long")
    return (F.when(F.isnan(v), far + 1).when(v == float("inf"), far).when(v == float("-inf"), -far)
            .when(v > 0, step(v)).when(v < 0, -step(-v)).otherwise(F.lit(0).cast("long")))


def _brackets(df: DataFrame, by: list[str], values: list[str], weight: Column) -> DataFrame:
    """Per group with a very long column the buckets around its middle: `_b`, a map of the
    column's number to (`lo`, `hi`). A row per such group, at most a millionth of the input."""
    long = df.select(*by, weight.alias("_w"), F.posexplode(F.array(*values)).alias("_i", "_v")).where(F.col("_v").isNotNull())
    counted = long.groupBy(*by, "_i", _bucket(F.col("_v")).alias("_k")).agg(F.sum("_w").alias("_n"))
    near = 2.0 / splits.HOT_ROWS  # two ranks at least, in a column of more than HOT_ROWS values
    around = F.expr(f"percentile(_k, array({max(0.0, 0.5 - near)}D, {min(1.0, 0.5 + near)}D), _n)")
    hot = counted.groupBy(*by, "_i").agg(F.sum("_n").alias("_all"), around.alias("_q")).where(F.col("_all") > splits.HOT_ROWS)
    bracket = F.struct(F.floor(F.col("_q")[0]).alias("lo"), F.ceil(F.col("_q")[1]).alias("hi"))
    return hot.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_i", bracket))).alias("_b"))


def group_medians(df: DataFrame, by, values: dict[str, Column], others: dict[str, Column] | None = None, *,
                  weight: str | None = None) -> DataFrame:
    """Exact interpolated medians of several columns per group (NULLs ignored) in one aggregation.

    `values` maps output names to columns, `others` to further aggregates of the same rows.
    A group without a value keeps its row, with a NULL median. With `weight`, a whole number
    above zero, a row stands for as many equal rows.

    Spark's `median` keeps a group's different values, so columns of more than
    `splits.HOT_ROWS` values in a group are narrowed first: values are counted by bucket (an
    order-preserving whole number, partial counts in each task), and what lies outside the
    buckets around the middle becomes one value below or above all others. That moves no
    median, and neither a large group nor one frequent value gathers in a task. Two reads of
    the input, the first of which shuffles counts only.
    """
    by = _as_list(by)
    names = [f"_v{i}" for i in range(len(values))]
    base = df.withColumns({n: v.cast("double") for n, v in zip(names, values.values(), strict=True)})
    found = _brackets(base, by, names, F.col(weight) if weight else F.lit(1).cast("bigint"))
    if by:
        rows = null_safe_join(base, F.broadcast(found), by, "left")  # a row per very large group
    else:
        rows = base.withColumn("_b", found.scalar())
    def clamped(i: int) -> Column:
        v, bracket = F.col(f"_v{i}"), F.try_element_at("_b", F.lit(i))
        return (F.when(bracket.isNull() | v.isNull(), v).when(_bucket(v) < bracket["lo"], F.lit(float("-inf")))
                .when(_bucket(v) > bracket["hi"], F.lit(float("inf"))).otherwise(v))
    middle = (lambda v: F.percentile(v, 0.5, F.col(weight))) if weight else F.median
    aggs = [middle(clamped(i)).alias(out) for i, out in enumerate(values)]
    return rows.groupBy(*by).agg(*aggs, *[a.alias(n) for n, a in (others or {}).items()])


def group_median(df: DataFrame, by, value: str, *, out: str = "median", count_out: str | None = None) -> DataFrame:
    """Exact interpolated median of `value` per group (NULLs ignored), optional non-null count (:func:`group_medians`)."""
    return group_medians(df, by, {out: F.col(value)}, {count_out: F.count(value)} if count_out else None)


def fixed_point_mean(value, scale: int = 2) -> Column:
    """Mean of values with at most `scale` decimals (money), summed exactly as
    BIGINT units: independent of summation order, so every engine and every
    partitioning returns the same double."""
    units = F.round(F.col(value) * F.lit(float(10 ** scale))).cast("bigint") if isinstance(value, str) \
        else F.round(value * F.lit(float(10 ** scale))).cast("bigint")
    cnt = F.count(units)
    return F.when(cnt > 0, F.sum(units).cast("double") / (cnt.cast("double") * F.lit(float(10 ** scale))))


def group_mean(df: DataFrame, by, value: str, *, out: str = "mean", scale: int | None = None) -> DataFrame:
    """Mean per group; `scale` switches to the exact fixed-point sum."""
    agg = fixed_point_mean(value, scale) if scale is not None else F.avg(value)
    return df.groupBy(*_as_list(by)).agg(agg.alias(out))


def group_share(df: DataFrame, by, cond: Column, *, count_col: str | None = None,
                count_out: str = "total", share_out: str = "share") -> DataFrame:
    """Row count (of non-null `count_col`, or all rows) and the share where `cond` holds."""
    cnt = F.count(count_col) if count_col else F.count(F.lit(1))
    return df.groupBy(*_as_list(by)).agg(
        cnt.alias(count_out), F.avg(cond.cast("double")).alias(share_out))


def arg_extreme(df: DataFrame, by, key: str, cols: list[str], *, largest: bool = True,
                where: Column | None = None, tie: list[str] | None = None) -> DataFrame:
    """The row with the largest (or smallest) `key` per group, as columns `cols`.

    `max_by`/`min_by` aggregate partially on every partition, so a hot group costs
    one row per partition in the shuffle. `tie` makes the pick deterministic.
    """
    if where is not None:
        df = df.where(where)
    df = df.where(F.col(key).isNotNull())
    order_key = F.struct(F.col(key), *[F.col(t) for t in (tie or [])])
    payload = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(payload, order_key) if largest else F.min_by(payload, order_key)
    by = _as_list(by)
    return df.groupBy(*by).agg(pick.alias("_pick")).select(*by, *[F.col(f"_pick.{c}").alias(c) for c in cols])
