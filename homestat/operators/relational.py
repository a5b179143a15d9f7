"""Joins, filters and projections shared by the metrics."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.functions.scalars import normalize_account

DATE_COLUMN = r"\d{4}-\d{2}-\d{2}"


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# ------------------------------------------------------------------ filters

def _literal_like(df: DataFrame, column: str, value: dt.datetime) -> Column:
    """A literal of the column's own type, so the comparison is pushed to the scan."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DateType):
        return F.lit(value.date().isoformat()).cast("date")
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype.simpleString())


def trailing(df: DataFrame, date: str, as_of: dt.datetime, days: int) -> DataFrame:
    """Rows with `date >= as_of - days` (no upper bound: later rows stay)."""
    return df.where(F.col(date) >= _literal_like(df, date, as_of - dt.timedelta(days=days)))


def prior(df: DataFrame, date: str, as_of: dt.datetime, days: int, offset: int) -> DataFrame:
    """Rows in `[as_of - offset - days, as_of - offset)`."""
    lo = _literal_like(df, date, as_of - dt.timedelta(days=offset + days))
    hi = _literal_like(df, date, as_of - dt.timedelta(days=offset))
    return df.where((F.col(date) >= lo) & (F.col(date) < hi))


def period_of(df: DataFrame, date: str, as_of: dt.datetime, days: int = 365) -> Column:
    """'now' for the trailing window, 'prior' for the window before it, else NULL."""
    now_lo = _literal_like(df, date, as_of - dt.timedelta(days=days))
    prior_lo = _literal_like(df, date, as_of - dt.timedelta(days=2 * days))
    d = F.col(date)
    return F.when(d >= now_lo, F.lit("now")).when((d >= prior_lo) & (d < now_lo), F.lit("prior"))


# ------------------------------------------------------------------ joins

def account_key(df: DataFrame, column: str, out: str = "account_key") -> DataFrame:
    """Add the normalised account key (string keys lose padding; integer keys stay)."""
    return df.withColumn(out, normalize_account(F.col(column), df.schema[column].dataType))


def join_on_account(fact: DataFrame, dim: DataFrame, fact_key: str = "account_key",
                    dim_key: str = "account_key", how: str = "inner", dedupe: bool = False, by=()) -> DataFrame:
    """Fact ⋈ dimension on the normalised account key (and `by`, keys both have: an account
    number belongs to its region). NULL keys never match.

    Duplicate dimension keys multiply fact rows unless `dedupe` keeps one per key.
    The planner picks broadcast vs shuffle from runtime sizes (AQE), and splits a
    hot key's partition on the fact side (AQE skew join).
    """
    if dedupe:
        dim = dim.dropDuplicates([*by, dim_key])
    if fact_key != dim_key:
        dim = dim.withColumnRenamed(dim_key, fact_key)
    return fact.join(dim, on=[*by, fact_key], how=how)


def drop_bulk(df: DataFrame, keys, threshold: int = 3) -> DataFrame:
    """Remove rows whose key combination occurs more than `threshold` times.

    Counting aggregates partially per partition; the anti join keeps rows with a
    NULL key (they form no group), like a group-by that drops NULL keys.
    """
    keys = _as_list(keys)
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else not_null & c
    bulk = (df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > threshold).select(*keys))
    return df.join(bulk, on=keys, how="left_anti")


def bulk_keys(df: DataFrame, keys, threshold: int = 3) -> DataFrame:
    """The key combinations `drop_bulk` removes, with their row counts."""
    keys = _as_list(keys)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return (df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > threshold))


def attach_scalar(df: DataFrame, one_row: DataFrame, by=None) -> DataFrame:
    """Attach the columns of a scalar result.

    Without `by`, `one_row` is a global aggregate: its single row is fetched (a
    handful of values) and attached as typed literals, so no join is planned at
    all. With `by` it is an equi-join on the keys and the planner sizes it.
    """
    by = _as_list(by)
    if by:
        return df.join(one_row, on=by, how="inner")
    rows = one_row.take(2)
    if len(rows) > 1:
        raise ValueError("attach_scalar without keys needs a one-row frame")
    out = df
    for field in one_row.schema.fields:
        value = rows[0][field.name] if rows else None
        out = out.withColumn(field.name, F.lit(value).cast(field.dataType))
    return out


def align_series(left: DataFrame, right: DataFrame, on, fill: float | None = 0.0) -> DataFrame:
    """Left join on the keys; missing right-hand values become `fill`."""
    on = _as_list(on)
    out = left.join(right, on=on, how="left")
    if fill is None:
        return out
    for c in right.columns:
        if c not in on:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(fill)))
    return out


# -------------------------------------------------------------- projections

def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def with_default(df: DataFrame, col: str, value, dtype: str) -> DataFrame:
    """Add `col` with a constant when the input lacks it."""
    if col in df.columns:
        return df
    return df.withColumn(col, F.lit(value).cast(dtype))


def date_columns(df: DataFrame, pattern: str = DATE_COLUMN) -> list[str]:
    """Columns whose name starts with a date (the growing month columns), in name order."""
    rx = re.compile(pattern)
    return sorted(c for c in df.columns if rx.match(c))


def unpivot_dates(df: DataFrame, ids, pattern: str = DATE_COLUMN, *, latest: int | None = None,
                  month: str = "month", value: str = "value") -> DataFrame:
    """Wide month columns -> long (ids…, month DATE, value DOUBLE).

    `latest` keeps only the newest N month columns. The choice is made on the
    schema, so the scan reads only those columns.
    """
    ids = _as_list(ids)
    cols = date_columns(df, pattern)
    if latest is not None:
        cols = cols[-latest:] if latest > 0 else []
    if not cols:
        empty = df.select(*ids, F.lit(None).cast("date").alias(month), F.lit(None).cast("double").alias(value))
        return empty.limit(0)
    narrow = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = narrow.unpivot(ids, cols, "_month_text", value)
    return long.select(*ids, F.to_date(F.substring("_month_text", 1, 10)).alias(month), value)
