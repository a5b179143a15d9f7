"""Composite market metrics as lazy DataFrame plans.

Input vocabulary (produced by `homestat.sources.readers` or by a projection of
any other table):

* sales:   account, account_key, sale_date (timestamp/date), sale_price (double),
           sale_id (optional unique tie-breaker)
* parcels: account, account_key, zip (text), living, just, beds (double),
           homestead (text, optional), locn, locs, locd, unit (text, optional),
           zip_pattern (text, optional: the pattern of the parcel's own region)
* series:  region, period_end (date) + value columns

With `by` (say `("region",)`) a metric covers many regions at once: sales and parcels carry
those columns, accounts match within them, and every result is keyed by them.

`as_of` is an explicit datetime (midnight), never the wall clock; cut-offs are
inclusive (`>=`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.functions import labels as L
from homestat.functions.scalars import build_address, strip_ws, to_number, zip5
from homestat.operators.aggregates import group_mean, group_medians
from homestat.operators.relational import (align_series, attach_scalar, date_columns, drop_bulk,
                                           join_on_account, period_of, trailing, unpivot_dates,
                                           with_default)
from homestat.operators.windows import consecutive_pairs, direction, latest_n, pct_change, rank_by
from homestat.session import checkpoint_dir

# Fixed value: the default zip filter of the zip-level metrics (five digits, prefix 342).
DEFAULT_ZIP_PATTERN = r"^342[0-9][0-9]$"


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _round(c, decimals):
    return c if decimals is None else F.round(c, decimals)


def _zip_parcels(parcels: DataFrame, zip_pattern: str, *cols, by=()) -> DataFrame:
    """Parcels whose zip fits: the pattern of their region, where they carry one, else `zip_pattern`."""
    p = parcels.withColumn("zip", zip5(F.col("zip")))
    fits = F.rlike("zip", F.col("zip_pattern")) if "zip_pattern" in parcels.columns else F.col("zip").rlike(zip_pattern)
    return p.where(fits).select(*by, "account_key", "zip", *cols)


def in_regions(parcels: DataFrame, regions: DataFrame, city_col: str | None = None) -> DataFrame:
    """Parcels of the regions listed, with each region's `zip_pattern`.

    `regions` has `region`, `zip_pattern` and, optionally, `city` and `state`: with `city_col`,
    only parcels of that city stay (trimmed, upper-cased; a null city takes all). An
    equi-join on the region, whose side the planner broadcasts by its size."""
    r = regions.select("region", "zip_pattern", *(["city"] if city_col and "city" in regions.columns else []))
    out = parcels.join(r.withColumnRenamed("city", "_city"), "region")
    if "_city" in out.columns:
        out = out.where(F.col("_city").isNull() | (F.upper(strip_ws(F.col(city_col))) == F.upper(strip_ws(F.col("_city"))))).drop("_city")
    return out


# ---------------------------------------------------------------- M1, M2

def price_pressure(price_df: DataFrame, ratio_df: DataFrame, *, by=("region",), latest: int = 4) -> DataFrame:
    """M1: latest weeks of median price and sale-to-list with week-over-week change
    (computed after the cut, so the first row's change is NULL) and the signal."""
    by = _as_list(by)
    price_df = with_default(price_df, "price_yoy", 0.0, "double")
    j = price_df.select(*by, "period_end", "median_price", "price_yoy").join(
        ratio_df.select(*by, "period_end", "sale_to_list"), on=[*by, "period_end"], how="inner")
    j = latest_n(j, by, "period_end", latest)
    j = pct_change(j, by, "period_end", "median_price", "price_delta", bounded_groups=True)  # <= `latest` rows
    return j.select(*by, F.col("period_end").alias("week"), "median_price", "sale_to_list",
                    "price_yoy", "price_delta",
                    L.price_signal(F.col("sale_to_list"), F.col("price_delta")).alias("signal"))


def inventory_absorption(supply_df: DataFrame, listings_df: DataFrame, sold_df: DataFrame, *,
                         by=("region",), latest: int = 4) -> DataFrame:
    """M2: latest weeks of supply, new listings, homes sold (inner-joined on the
    period), market state, supply YoY as a ratio of the absolute delta, absorption."""
    by = _as_list(by)
    keys = [*by, "period_end"]
    supply_df = with_default(supply_df, "supply_yoy_abs", None, "double")
    j = (supply_df.select(*keys, "supply", "supply_yoy_abs")
         .join(listings_df.select(*keys, "new_listings"), on=keys, how="inner")
         .join(sold_df.select(*keys, "homes_sold"), on=keys, how="inner"))
    j = latest_n(j, by, "period_end", latest)
    prior_supply = F.col("supply") - F.col("supply_yoy_abs")
    yoy = F.when(prior_supply > 0, F.try_divide(F.col("supply_yoy_abs"), prior_supply))
    return j.select(*by, F.col("period_end").alias("week"),
                    F.col("supply").cast("double").alias("weeks_of_supply"),
                    F.col("new_listings").cast("double").alias("new_listings"),
                    F.col("homes_sold").cast("double").alias("homes_sold"),
                    L.market_state(F.col("supply")).alias("market_state"),
                    yoy.alias("supply_yoy"),
                    F.try_divide(F.col("homes_sold").cast("double"), F.col("new_listings").cast("double"))
                    .alias("absorption_ratio"))


# ---------------------------------------------------------------- M3, M4, M9

def residential_mean_just(parcels: DataFrame, *, scale: int | None = None, by=None) -> DataFrame:
    """Mean assessed value of residential parcels (just > 0 and living > 0)."""
    res = parcels.where((F.col("just") > 0) & (F.col("living") > 0))
    return group_mean(res, _as_list(by), "just", out="avg_just", scale=scale)


def cash_flow_zones(latest_rent: DataFrame, parcels: DataFrame, *, zip_prefix: str = "342",
                    scale: int | None = None) -> DataFrame:
    """M3: mean assessed value of residential parcels per numeric zip with the
    given prefix, the latest rent (one-row frame, column `rent`) × 12, their
    ratio and a 1..n rank by ratio (descending)."""
    p = parcels.where((F.col("just") > 0) & (F.col("living") > 0))
    znum = to_number(F.col("zip"))
    p = p.withColumn("_znum", znum).where(
        F.col("_znum").isNotNull() & F.col("_znum").cast("string").startswith(zip_prefix))
    by_zip = group_mean(p, "_znum", "just", out="avg_assessed", scale=scale)
    by_zip = by_zip.select(F.col("_znum").cast("int").cast("string").alias("zip"), "avg_assessed")
    rent = latest_rent.select((F.col("rent") * 12).alias("est_annual_rent"))
    z = attach_scalar(by_zip, rent)
    z = z.withColumn("cash_flow_ratio", F.try_divide(F.col("est_annual_rent"), F.col("avg_assessed")))
    return rank_by(z, None, "cash_flow_ratio", tie=["zip"], out="rank", bounded_groups=True)  # a row per zip


def latest_value(series_long: DataFrame, *, by=None, value: str = "value", out: str = "rent") -> DataFrame:
    """Value at the newest month that exists anywhere in the table, as it is (NULL stays
    NULL), one row per `by`."""
    by = _as_list(by)
    newest = series_long.agg(F.max("month").alias("_m"))
    picked = series_long.join(F.broadcast(newest), F.col("month") == F.col("_m"))
    return picked.select(*by, F.col(value).alias(out))


def trend_lines(value_wide: DataFrame, rent_wide: DataFrame, parcels: DataFrame | None, *, ids=("region",),
                months: int = 6, scale: int | None = None) -> DataFrame:
    """M4: the newest `months` month columns of the value index with rent aligned
    by month (missing rent -> 0), flow ratio, gap to the mean residential assessed
    value (of the region, where parcels have the `ids`; without parcels 0) and the
    direction of the flow ratio."""
    ids = _as_list(ids)
    value = unpivot_dates(value_wide, ids, latest=months, value="zhvi")
    wanted = set(date_columns(value_wide)[-months:])
    rent_cols = [c for c in date_columns(rent_wide) if c in wanted]
    rent = rent_wide.select(*ids, *[F.col(f"`{c}`") for c in rent_cols])
    rent = unpivot_dates(rent, ids, value="zori")
    j = align_series(value, rent, on=[*ids, "month"], fill=0.0)
    if parcels is None:
        j = j.withColumn("avg_just", F.lit(None).cast("double"))
    elif set(ids) <= set(parcels.columns):
        j = j.join(residential_mean_just(parcels, scale=scale, by=ids), ids, "left")
    else:
        j = attach_scalar(j, residential_mean_just(parcels, scale=scale))
    flow = F.when(F.col("zhvi") > 0, F.try_divide(F.col("zori") * 12, F.col("zhvi"))).otherwise(F.lit(0.0))
    gap = F.when(F.col("avg_just") > 0, F.try_divide(F.col("zhvi") - F.col("avg_just"), F.col("avg_just"))) \
        .otherwise(F.lit(0.0))
    j = j.select(*ids, "month", "zhvi", "zori", flow.alias("flow_ratio"), gap.alias("appraisal_gap"))
    return direction(j, ids, "month", "flow_ratio", out="direction", bounded_groups=True)  # <= `months` rows


def appraisal_gap(value_long_by_zip: DataFrame, parcels: DataFrame, *, scale: int | None = None) -> DataFrame:
    """M9: newest value per zip vs the mean assessed value of all parcels of the
    zip (numeric zip join), flagged HOT_MARKET / COOLING; unflagged zips dropped."""
    newest = value_long_by_zip.agg(F.max("month").alias("_m"))
    z = (value_long_by_zip.join(F.broadcast(newest), F.col("month") == F.col("_m"))
         .select(to_number(F.col("zip")).alias("zip_code"), F.col("value").alias("zhvi")))
    p = parcels.withColumn("_z", to_number(F.col("zip")))
    avg = group_mean(p.where(F.col("_z").isNotNull()), "_z", "just", out="avg_just", scale=scale) \
        .withColumnRenamed("_z", "zip_code")
    j = z.join(avg, on="zip_code", how="inner")
    j = j.withColumn("gap_pct", F.try_divide(F.col("zhvi") - F.col("avg_just"), F.col("avg_just")))
    j = j.withColumn("flag", L.appraisal_flag(F.col("gap_pct")))
    return j.where(F.col("flag") != "")


# ---------------------------------------------------------------- M5

def resale_flips(sales: DataFrame, parcels: DataFrame | None = None, *, as_of: dt.datetime,
                 min_days: int = 120, max_days: int = 365, recent_days: int = 180,
                 bulk_threshold: int = 3, max_loss: float = -0.5, city: str = "", by=()) -> DataFrame:
    """M5: consecutive sales of one account held `min_days..max_days` days whose
    second sale is at most `recent_days` old, after removing bulk transfers
    (more than `bulk_threshold` sales sharing date and price).

    Only sales that can still complete such a pair are read. `days_held` counts whole
    days, so the first sale lies less than `max_days + 1` days before the second; bulk
    groups share one date. The cut is thus exact, and pushed to the scan. Sales without
    an account (NULL key) belong to nobody and make no pair; an empty key is a key.
    """
    by = _as_list(by)
    horizon = recent_days + max_days + 1
    s = trailing(sales, "sale_date", as_of, horizon)
    s = drop_bulk(s, [*by, "sale_date", "sale_price"], bulk_threshold)
    tie = ["sale_id"] if "sale_id" in s.columns else []
    s = s.where(F.col("account_key").isNotNull())  # after the bulk test, which counts them
    pairs = consecutive_pairs(s, [*by, "account_key"], "sale_date", tie, ["sale_price", "account"])
    held = F.timestamp_diff("DAY", F.col("first_sale_date"), F.col("second_sale_date")).cast("bigint")
    f = pairs.withColumn("days_held", held).where(F.col("days_held").between(min_days, max_days))
    f = f.where(F.col("first_sale_price") > 0)
    f = f.withColumn("markup", F.col("second_sale_price") - F.col("first_sale_price"))
    f = f.withColumn("markup_pct", F.col("markup") / F.col("first_sale_price"))
    f = f.where(F.col("markup_pct") >= max_loss)
    f = trailing(f, "second_sale_date", as_of, recent_days)
    f = f.select(*by, "account_key", F.col("first_account").alias("account"), "first_sale_date", "first_sale_price",
                 "second_sale_date", "second_sale_price", "days_held", "markup", "markup_pct",
                 L.flip_outcome(F.col("first_sale_price"), F.col("second_sale_price")).alias("outcome"))
    if parcels is None:
        return f.select("*", F.lit(L.ADDRESS_UNAVAILABLE).alias("address"),
                        F.lit(None).cast("double").alias("beds"),
                        F.lit(None).cast("double").alias("sqft")).drop("account_key")
    cols = set(parcels.columns)
    part = lambda c: F.col(c) if c in cols else F.lit(None).cast("string")
    lookup = parcels.select(
        *by, "account_key",
        build_address(part("locn"), part("locs"), part("locd"), part("unit"), part("zip"), city).alias("address"),
        to_number(part("beds")).alias("beds"), to_number(part("living")).alias("sqft"))
    out = join_on_account(f, lookup, how="left", by=by)
    return out.withColumn("address", F.coalesce(F.col("address"), F.lit(L.ADDRESS_UNAVAILABLE))) \
        .drop("account_key")


# ---------------------------------------------------------------- M6, M7, M8, M10

def sales_base(sales: DataFrame, parcels: DataFrame, *, as_of: dt.datetime, by=(), zip_pattern: str = DEFAULT_ZIP_PATTERN) -> DataFrame:
    """J3, the joined base: every parcel of a zip that fits, with its sales of two years.

    A row per parcel and sale, or one without a sale: `sale_price`, `_now` (the trailing
    year, else the one before; NULL without a sale), the parcel's `zip`, `living`, `just`,
    `homestead` (where there is one), and `_parcel`, a number of the parcel's row.
    """
    by = _as_list(by)
    cols = ["living", "just", *(["homestead"] if "homestead" in parcels.columns else [])]
    p = _zip_parcels(parcels, zip_pattern, *cols, by=by).withColumn("_parcel", F.monotonically_increasing_id())
    s = trailing(sales, "sale_date", as_of, 730)  # pushed to the scan
    s = s.select(*by, "account_key", "sale_price", (period_of(s, "sale_date", as_of) == "now").alias("_now"))
    return p.join(s, [*by, "account_key"], "left")


def _home() -> Column:
    return F.col("living") > 0


def _valued() -> Column:
    return F.col("just") > 0


def zip_statistics(base: DataFrame, *, by=()) -> DataFrame:
    """Everything that the zip metrics need of the sales, from one aggregation of the joined base.

    Medians of the price of both years and of price over assessed value, each over its own
    rows; how many rows each has; all sales of the year and how many were without homestead."""
    by, now, price = _as_list(by), F.col("_now"), F.col("sale_price")
    mark = F.col("homestead") if "homestead" in base.columns else F.lit(None).cast("string")
    investor = F.coalesce(strip_ws(mark) != F.lit("X"), F.lit(True))
    rows = {"trend_now": now & _home(), "trend_prior": ~now & _home(), "ratio": now & _valued(), "value": now & _home() & _valued()}
    medians = {f"med_{k}": F.when(c, price / F.col("just") if k == "ratio" else price) for k, c in rows.items()}
    counts = {f"has_{k}": F.count_if(c) for k, c in rows.items()} | {f"n_{k}": F.count(F.when(c, price)) for k, c in rows.items()}
    counts |= {"n_sales": F.count_if(now), "n_investors": F.count_if(now & investor)}
    return group_medians(base.where(now.isNotNull()), [*by, "zip"], medians, counts)


def zip_assessments(base: DataFrame, *, by=(), scale: int | None = None) -> DataFrame:
    """Mean assessed value of each zip's residential parcels, sold or not (every parcel row counts once)."""
    parcels = base.select(*_as_list(by), "zip", "living", "just", "_parcel").dropDuplicates(["_parcel"])
    return group_mean(parcels.where(_home() & _valued()), [*_as_list(by), "zip"], "just", out="avg_assessed", scale=scale)


def trend_of(stats: DataFrame, *, by=(), low_volume_limit: int = 20, yoy_limit: float = 0.40, median_decimals: int | None = None) -> DataFrame:
    """M6 of the zip statistics."""
    z = stats.where((F.col("has_trend_now") > 0) & (F.col("has_trend_prior") > 0)).select(
        *_as_list(by), "zip", _round(F.col("med_trend_now"), median_decimals).alias("price_now"), F.col("n_trend_now").alias("sales_volume"),
        _round(F.col("med_trend_prior"), median_decimals).alias("price_prior"))
    z = z.withColumn("yoy_change", F.try_divide(F.col("price_now") - F.col("price_prior"), F.col("price_prior")))
    z = z.withColumn("low_volume", L.low_volume(F.col("sales_volume"), low_volume_limit))
    return z.select(*_as_list(by), "zip", "price_now", "sales_volume", "price_prior", "yoy_change", "low_volume",
                    L.zip_display(F.col("zip"), F.col("low_volume")).alias("zip_display"),
                    L.yoy_flag(F.col("yoy_change"), yoy_limit).alias("yoy_flag"))


def ratio_of(stats: DataFrame, *, by=(), median_decimals: int | None = None) -> DataFrame:
    """M7 of the zip statistics."""
    r = stats.where(F.col("has_ratio") > 0).select(*_as_list(by), "zip", _round(F.col("med_ratio"), median_decimals).alias("median_ratio"))
    return r.withColumn("meaning", L.ratio_meaning(F.col("median_ratio")))


def value_of(stats: DataFrame, assessments: DataFrame, *, by=(), min_sales: int = 20, median_decimals: int | None = None) -> DataFrame:
    """M8 of the zip statistics and the zips' assessments."""
    by = _as_list(by)
    med = stats.where(F.col("n_value") >= min_sales).select(
        *by, "zip", _round(F.col("med_value"), median_decimals).alias("median_sale_price"), F.col("n_value").alias("sales_volume"))
    j = med.join(assessments, on=[*by, "zip"], how="inner")
    j = j.withColumn("value_ratio", F.try_divide(F.col("median_sale_price"), F.col("avg_assessed")))
    return j.select(*by, "zip", "median_sale_price", "sales_volume", "avg_assessed", "value_ratio",
                    L.buyer_signal(F.col("value_ratio")).alias("buyer_signal"))


def investors_of(stats: DataFrame, *, by=()) -> DataFrame:
    """M10 of the zip statistics."""
    share = F.col("n_investors") / F.col("n_sales")
    return stats.where(F.col("n_sales") > 0).select(*_as_list(by), "zip", F.col("n_sales").alias("total_sales"), share.alias("investor_share"))


def zip_metrics(sales: DataFrame, parcels: DataFrame, *, as_of: dt.datetime, by=(), zip_pattern: str = DEFAULT_ZIP_PATTERN,
                low_volume_limit: int = 20, yoy_limit: float = 0.40, min_sales: int = 20, scale: int | None = None,
                median_decimals: int | None = None) -> dict[str, DataFrame]:
    """M6, M7, M8 and M10 from one joined base, each equal to the metric by itself.

    Sales and parcels are read once, when this is called: the base and the tables of one row
    per zip made from it are checkpoints in the session's shared folder, and the metrics are
    projections of these. Without a homestead column there is no investor activity.
    """
    checkpoint_dir(sales.sparkSession)
    base = sales_base(sales, parcels, as_of=as_of, by=by, zip_pattern=zip_pattern).checkpoint()
    stats = zip_statistics(base, by=by).checkpoint()
    assessments = zip_assessments(base, by=by, scale=scale).checkpoint()
    out = {"zip_price_trends": trend_of(stats, by=by, low_volume_limit=low_volume_limit, yoy_limit=yoy_limit, median_decimals=median_decimals),
           "assessment_ratio": ratio_of(stats, by=by, median_decimals=median_decimals),
           "buyer_value_index": value_of(stats, assessments, by=by, min_sales=min_sales, median_decimals=median_decimals),
           "investor_activity": investors_of(stats, by=by)}
    if "homestead" not in parcels.columns:
        out["investor_activity"] = out["investor_activity"].limit(0)
    return out


def trailing_year_trend(sales: DataFrame, parcels: DataFrame, *, as_of: dt.datetime,
                        zip_pattern: str = DEFAULT_ZIP_PATTERN, low_volume_limit: int = 20,
                        yoy_limit: float = 0.40, median_decimals: int | None = None, by=()) -> DataFrame:
    """M6: per zip, median price and volume of the trailing year vs the median of
    the year before (residential parcels; zips with sales in both years only).

    One pass: both medians come from one aggregation instead of two and a join.
    """
    by = _as_list(by)
    p = _zip_parcels(parcels.where(_home()), zip_pattern, by=by)
    s = trailing(sales, "sale_date", as_of, 730)  # pushed to the scan
    s = s.select(*by, "account_key", "sale_price", (period_of(s, "sale_date", as_of) == "now").alias("_now"))
    now, price = F.col("_now"), F.col("sale_price")
    z = group_medians(join_on_account(s, p, by=by), [*by, "zip"],
                      {"med_trend_now": F.when(now, price), "med_trend_prior": F.when(~now, price)},
                      {"n_trend_now": F.count(F.when(now, price)), "has_trend_now": F.count_if(now), "has_trend_prior": F.count_if(~now)})
    return trend_of(z, by=by, low_volume_limit=low_volume_limit, yoy_limit=yoy_limit, median_decimals=median_decimals)


def assessment_ratio(sales: DataFrame, parcels: DataFrame, *, as_of: dt.datetime,
                     zip_pattern: str = DEFAULT_ZIP_PATTERN, median_decimals: int | None = None, by=()) -> DataFrame:
    """M7: median sale-price / assessed-value ratio per zip over the trailing year
    (no residential filter; assessed value must be positive)."""
    by = _as_list(by)
    p = _zip_parcels(parcels.where(_valued()), zip_pattern, "just", by=by)
    s = trailing(sales, "sale_date", as_of, 365).select(*by, "account_key", "sale_price")
    r = group_medians(join_on_account(s, p, by=by), [*by, "zip"], {"med_ratio": F.col("sale_price") / F.col("just")}, {"has_ratio": F.count(F.lit(1))})
    return ratio_of(r, by=by, median_decimals=median_decimals)


def buyer_value_index(sales: DataFrame, parcels: DataFrame, *, as_of: dt.datetime,
                      zip_pattern: str = DEFAULT_ZIP_PATTERN, min_sales: int = 20, scale: int | None = None,
                      median_decimals: int | None = None, by=()) -> DataFrame:
    """M8: trailing-year median sale price and volume per zip (residential parcels,
    at least `min_sales` sales) against the zip's mean assessed value."""
    by = _as_list(by)
    p = _zip_parcels(parcels.where(_home() & _valued()), zip_pattern, "just", by=by)
    avg = group_mean(p, [*by, "zip"], "just", out="avg_assessed", scale=scale)
    s = trailing(sales, "sale_date", as_of, 365).select(*by, "account_key", "sale_price")
    m = join_on_account(s, p.drop("just"), by=by)
    med = group_medians(m, [*by, "zip"], {"med_value": F.col("sale_price")}, {"n_value": F.count("sale_price")})
    return value_of(med, avg, by=by, min_sales=min_sales, median_decimals=median_decimals)


def investor_activity(sales: DataFrame, parcels: DataFrame, *, as_of: dt.datetime,
                      zip_pattern: str = DEFAULT_ZIP_PATTERN, by=()) -> DataFrame:
    """Trailing-year sales per zip and the share bought without a homestead
    exemption. Parcels without a `homestead` column give an empty result."""
    by = _as_list(by)
    if "homestead" not in parcels.columns:
        empty = parcels.select(*by, "zip", F.lit(0).cast("bigint").alias("total_sales"), F.lit(0.0).alias("investor_share"))
        return empty.limit(0)
    p = _zip_parcels(parcels, zip_pattern, "homestead", by=by)
    s = trailing(sales, "sale_date", as_of, 365).select(*by, "account_key")
    investor = F.coalesce(strip_ws(F.col("homestead")) != F.lit("X"), F.lit(True))
    m = join_on_account(s, p, by=by).groupBy(*by, "zip").agg(F.count(F.lit(1)).alias("n_sales"), F.count_if(investor).alias("n_investors"))
    return investors_of(m, by=by)


# ---------------------------------------------------------------- M11, M12

def market_snapshot(price: DataFrame | None, inventory: DataFrame | None, zip_trends: DataFrame | None,
                    value_index: DataFrame | None, flips: DataFrame | None, *, by=("region",),
                    min_volume: int = 20, area: str = "The market", regions: DataFrame | None = None) -> DataFrame:
    """One row per region summarising the other metrics (all inputs carry
    the region columns; any may be missing, and `regions` lists regions that get a row
    whatever is missing). Every input is reduced to one row per region first
    (partial aggregation); the small results are stacked and folded into one row
    per region, so each input is planned once and a region present in any input
    gets a row."""
    by = _as_list(by)
    row = lambda *cs: F.struct(*[F.col(c) for c in cs])
    parts = [] if regions is None else [regions.select(*by)]
    if price is not None:
        parts.append(price.groupBy(*by).agg(F.max_by(row("median_price", "price_yoy", "sale_to_list"), "week")
                                            .alias("p")).select(*by, "p.*"))
    if inventory is not None:
        parts.append(inventory.groupBy(*by).agg(F.max_by(row("weeks_of_supply", "new_listings", "homes_sold"), "week")
                                                .alias("i")).select(*by, "i.*"))
    if zip_trends is not None:
        parts.append(zip_trends.where((F.col("yoy_change") > 0) & (F.col("sales_volume") >= min_volume))
                     .groupBy(*by).agg(F.max_by(row("zip", "yoy_change", "sales_volume"),
                                                F.struct(F.col("yoy_change"), F.col("zip"))).alias("h"))
                     .select(*by, F.col("h.zip").alias("hottest_zip"), F.col("h.yoy_change").alias("_hy"),
                             F.col("h.sales_volume").alias("_hv")))
    if value_index is not None:
        parts.append(value_index.where(F.col("value_ratio").isNotNull()).groupBy(*by).agg(
            F.min_by(row("zip", "value_ratio"), F.struct(F.col("value_ratio"), F.col("zip"))).alias("b"))
            .select(*by, F.col("b.zip").alias("best_value_zip"), F.col("b.value_ratio").alias("_bv")))
    if flips is not None:
        parts.append(flips.groupBy(*by).agg(F.count(F.lit(1)).alias("flip_count"),
                                            F.count_if(F.col("outcome") == L.OUTCOME_PROFIT).alias("_profitable")))
    # every column comes from exactly one part: stack the parts and take each
    # column's one non-null value per region (one small aggregate, no joins)
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    value_cols = [c for c in stacked.columns if c not in by]
    snap = (stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in value_cols]) if value_cols
            else stacked.distinct())
    defaults = {"median_price": "double", "price_yoy": "double", "sale_to_list": "double", "weeks_of_supply": "double",
                "new_listings": "double", "homes_sold": "double",
                "hottest_zip": "string", "_hy": "double", "_hv": "bigint", "best_value_zip": "string",
                "_bv": "double", "flip_count": "bigint", "_profitable": "bigint"}
    for c, t in defaults.items():
        snap = with_default(snap, c, None, t)
    snap = snap.withColumn("price_yoy_label", F.when(F.col("median_price").isNull() & F.col("price_yoy").isNull()
                                                     & F.col("sale_to_list").isNull(), F.lit(""))
                           .otherwise(L.yoy_label(F.col("price_yoy"))))
    snap = snap.withColumnRenamed("weeks_of_supply", "weeks_supply")
    snap = snap.withColumn("supply_label", L.supply_label(F.col("weeks_supply")))
    snap = snap.withColumn("market_phase", L.market_phase(F.col("weeks_supply"), F.col("price_yoy")))
    snap = snap.withColumn("headline", L.headline(F.col("market_phase"), F.col("weeks_supply"),
                                                  F.col("median_price"), area))
    snap = snap.withColumn("hottest_zip_label", L.hottest_zip_label(F.col("hottest_zip"), F.col("_hy"),
                                                                    F.col("_hv")))
    snap = snap.withColumn("best_value_label", L.best_value_label(F.col("best_value_zip"), F.col("_bv")))
    prof = F.coalesce(F.col("_profitable"), F.lit(0))
    snap = snap.withColumn("flip_count", F.coalesce(F.col("flip_count"), F.lit(0)).cast("bigint"))
    snap = snap.withColumn("flip_profitable_pct", F.when(F.col("flip_count") > 0, prof / F.col("flip_count"))
                           .otherwise(F.lit(0.0)))
    snap = snap.withColumn("flip_count_in_range", L.in_sane_range(F.col("flip_count")))
    snap = snap.withColumn("flip_summary", L.flip_summary(F.col("flip_count"), prof, F.col("flip_count") - prof))
    return snap.select(*by, "median_price", "price_yoy", "price_yoy_label", "sale_to_list", "weeks_supply",
                       "supply_label", "new_listings", "homes_sold", "market_phase", "headline",
                       "hottest_zip", "hottest_zip_label", "best_value_zip", "best_value_label",
                       "flip_count", "flip_profitable_pct", "flip_count_in_range", "flip_summary")


def run_metrics(sources: dict, *, as_of: dt.datetime, region: str = "ALL", min_sale_price: float = 10000.0,
                zip_pattern: str = DEFAULT_ZIP_PATTERN, city: str = "", materialize: bool = False,
                regions: DataFrame | None = None, **options) -> dict[str, DataFrame]:
    """Every metric from one set of cleaned sources, snapshot last.

    With `regions` (`region`, `zip_pattern`, optionally `city`, `state`) one run covers them
    all: sales, parcels and series carry `region`, each region's zips are those of its
    pattern, every result is keyed by region, and the snapshot has a row for each. Without,
    everything is the one `region` named. The zip metrics come from one joined base
    (:func:`zip_metrics`), which is written when this is called.

    `sources` may hold: sales, parcels, price, ratio, supply, listings, sold,
    value_wide, rent_wide. Missing sources skip their metrics (no exception is
    swallowed for present ones); the snapshot is built from whatever there is. Sales below `min_sale_price` are dropped first.

    With `materialize`, the filtered sales and the parcels are checkpointed once
    to the shared `spark.checkpoint.dir` before the metrics read them: the eight
    metric plans then start from stored files (short lineage, nothing recomputed
    when an executor is lost) instead of re-running the cleaning each time.
    """
    out: dict[str, DataFrame] = {}
    sales, parcels = sources.get("sales"), sources.get("parcels")
    if sales is not None:
        sales = sales.where(F.col("sale_price") > min_sale_price)
    by = [] if regions is None else ["region"]
    if regions is not None:
        listed = regions.select("region")
        sources = {k: df if df is None or k == "parcels" else df.join(listed, "region", "left_semi") for k, df in sources.items()}
        sales = None if sales is None else sales.join(listed, "region", "left_semi")
        parcels = None if parcels is None else in_regions(parcels, regions, "loccity" if "loccity" in parcels.columns else None)
    if materialize:
        spark = (sales if sales is not None else parcels).sparkSession
        checkpoint_dir(spark)
        sales = sales.checkpoint(eager=True) if sales is not None else None
        parcels = parcels.checkpoint(eager=True) if parcels is not None else None
    if sources.get("price") is not None and sources.get("ratio") is not None:
        out["price_pressure"] = price_pressure(sources["price"], sources["ratio"])
    if all(sources.get(k) is not None for k in ("supply", "listings", "sold")):
        out["inventory_absorption"] = inventory_absorption(sources["supply"], sources["listings"], sources["sold"])
    if sources.get("value_wide") is not None and sources.get("rent_wide") is not None:
        out["trend_lines"] = trend_lines(sources["value_wide"], sources["rent_wide"], parcels)
    if sales is not None and parcels is not None:
        out |= zip_metrics(sales, parcels, as_of=as_of, by=by, zip_pattern=zip_pattern, **options)
    if sales is not None:
        out["flip_detector"] = resale_flips(sales, parcels, as_of=as_of, city=city, by=by)
    if not out:
        return out
    tag = lambda df: df if df is None or by else df.withColumn("region", F.lit(region))
    if "flip_detector" in out:
        out["flip_summary"] = flip_summary(out["flip_detector"], by=by)
    spark = next(iter(out.values())).sparkSession
    out["market_snapshot"] = market_snapshot(
        out.get("price_pressure"), out.get("inventory_absorption"), tag(out.get("zip_price_trends")),
        tag(out.get("buyer_value_index")), tag(out.get("flip_detector")),
        regions=spark.range(1).select(F.lit(region).alias("region")) if regions is None else regions)
    return out


def flip_summary(flips: DataFrame, *, by=()) -> DataFrame:
    """The one-line summary of all flips (one row; with `by`, one for each group that has any)."""
    n = F.count(F.lit(1))
    return (flips.groupBy(*by) if by else flips).agg(L.flip_summary(n, F.count_if(F.col("outcome") == L.OUTCOME_PROFIT),
                                    F.count_if(F.col("outcome") != L.OUTCOME_PROFIT)).alias("flip_summary"))
