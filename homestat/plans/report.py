"""The data behind every report section, as DataFrames.

Each builder keeps the raw metric columns, adds display text and a `badge`
(warning / success / down / neutral / danger) and applies the section's display
order (O2/O4; ties broken by zip so the order is stable). Rendering HTML is left
to the caller; only these small tables ever need to leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homestat.functions import labels as L
from homestat.functions import scalars as S

# Insight sentences of the report.
PRICE_BELOW = "Homes are selling below asking price ({} of list on average). Buyers may have room to negotiate."
PRICE_ABOVE = ("Homes are selling above asking price ({} of list). Expect competition and consider offering "
               "at or above list price.")
PRICE_NEAR = "Homes are selling near asking price. The market is fairly balanced right now."
INV_HIGH = ("At {} months of supply, buyers have significant negotiating power — there are more homes "
            "available than buyers right now.")
INV_LOW = "At only {} months of supply, homes are moving fast. Buyers should be prepared to act quickly."
INV_MID = "The market has a relatively balanced amount of inventory."
RENT_INSIGHT = ("A {} annual rent-to-value ratio means that for a typical {} home, gross annual rent is "
                "roughly {}. This is a county-wide estimate — actual figures vary significantly by neighborhood.")


def _fmt(template: str, *cols):
    """`str.format`-style sentence from Spark columns (literal parts + columns)."""
    pieces = template.split("{}")
    out = [F.lit(pieces[0])]
    for c, lit in zip(cols, pieces[1:]):
        out += [c, F.lit(lit)]
    return F.concat(*out)


def _badge(c, rules, otherwise="badge-neutral"):
    return L.band(c, rules, otherwise)


def snapshot_cells(snapshot: DataFrame) -> DataFrame:
    """Snapshot tiles (price and supply text, labels)."""
    price = F.when(F.col("median_price").isNotNull() & (F.col("median_price") != 0),
                   S.money_text("median_price"))
    supply = F.when(F.col("weeks_supply").isNotNull() & (F.col("weeks_supply") != 0),
                    F.concat(S.fixed_text(F.col("weeks_supply"), 0), F.lit(" mo")))
    return snapshot.select("*", price.alias("price_text"), supply.alias("supply_text"))


def price_section(price: DataFrame, by=("region",)) -> DataFrame:
    """Weekly price rows (oldest first) plus the insight on the latest sale-to-list ratio."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy(F.col("week").desc())
    latest_ratio = F.first("sale_to_list").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pct = S.pct_text(latest_ratio, 1)
    has = latest_ratio.isNotNull() & (latest_ratio != 0)
    insight = (F.when(has & (latest_ratio < 0.97), _fmt(PRICE_BELOW, pct))
               .when(has & (latest_ratio > 1.0), _fmt(PRICE_ABOVE, pct))
               .otherwise(F.lit(PRICE_NEAR)))
    out = price.select(
        "*", S.week_label("week").alias("week_label"),
        F.when(F.col("median_price").isNotNull() & (F.col("median_price") != 0), S.money_text("median_price"))
        .otherwise(F.lit("N/A")).alias("price_text"),
        S.or_dash(S.pct_text("price_delta", 1, signed=True)).alias("delta_text"),
        S.or_dash(S.pct_text("price_yoy", 1, signed=True)).alias("yoy_text"),
        insight.alias("insight"))
    return out.orderBy(*by, F.col("week").asc())


def inventory_section(inv: DataFrame, by=("region",)) -> DataFrame:
    """Supply rows (newest first) plus the insight on the latest week."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy(F.col("week").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sup, lis, sold = (F.first(c).over(w) for c in ("weeks_of_supply", "new_listings", "homes_sold"))
    sup_text = S.fixed_text(sup, 0)
    level = (F.when(sup.isNotNull() & (sup != 0) & (sup > 18), _fmt(INV_HIGH, sup_text))
             .when(sup.isNotNull() & (sup != 0) & (sup < 8), _fmt(INV_LOW, sup_text))
             .otherwise(F.lit(INV_MID)))
    flow = F.when(lis.isNotNull() & (lis != 0) & sold.isNotNull() & (sold != 0), F.concat(
        F.lit(" New listings ("), F.format_number(lis, 0), F.lit(") are "),
        F.when(lis > sold, F.lit("outpacing")).otherwise(F.lit("below")),
        F.lit(" homes sold ("), F.format_number(sold, 0), F.lit(") this week."))).otherwise(F.lit(""))
    count = lambda c: F.when(F.col(c).isNotNull() & (F.col(c) != 0), F.format_number(c, 0)).otherwise(F.lit("N/A"))
    out = inv.select("*", S.week_label("week").alias("week_label"),
                     S.or_dash(S.fixed_text(F.col("weeks_of_supply"), 1), "N/A").alias("supply_text"),
                     count("new_listings").alias("listings_text"), count("homes_sold").alias("sold_text"),
                     S.or_dash(S.pct_text("supply_yoy", 1, signed=True), "N/A").alias("yoy_text"),
                     F.concat(level, flow).alias("insight"))
    return out.orderBy(*by, F.col("week").desc())


def trend_section(trend: DataFrame, by=("region",)) -> DataFrame:
    """value/rent trend rows (oldest first) plus the rent-to-value sentence for the newest month."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy(F.col("month").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    flow, zhvi, zori = (F.first(c).over(w) for c in ("flow_ratio", "zhvi", "zori"))
    out = trend.select("*", S.month_label("month").alias("month_label"), S.money_text("zhvi").alias("value_text"),
                       F.concat(S.money_text("zori"), F.lit("/mo")).alias("rent_text"),
                       S.pct_text("flow_ratio", 2).alias("ratio_text"),
                       _fmt(RENT_INSIGHT, S.pct_text(flow, 1), S.money_text(zhvi),
                            S.money_text(zori * 12)).alias("insight"))
    return out.orderBy(*by, F.col("month").asc())


def buyer_value_section(bvi: DataFrame) -> DataFrame:
    """Badge warning above 1.3x, success below 0.95x; best value first."""
    badge = _badge("value_ratio", [(">", 1.3, "badge-warning"), ("<", 0.95, "badge-success")])
    out = bvi.select("*", badge.alias("badge"), S.money_text("median_sale_price").alias("price_text"),
                     S.money_text("avg_assessed").alias("assessed_text"), S.ratio_text("value_ratio", 2).alias("ratio_text"))
    return out.orderBy(F.col("value_ratio").asc_nulls_last(), "zip")


def price_change_section(trends: DataFrame) -> DataFrame:
    """Badge warning above +5 %, down below −5 %; a note on anomalous swings;
    most expensive zip first."""
    badge = _badge("yoy_change", [(">", 0.05, "badge-warning"), ("<", -0.05, "badge-down")])
    out = trends.select("*", badge.alias("badge"), S.money_text("price_now").alias("price_text"),
                        S.money_text("price_prior").alias("prior_text"), (F.col("yoy_flag") == L.FLAG_LOW_DATA).alias("limited_data"),
                        S.pct_text("yoy_change", 1, signed=True).alias("yoy_text"))
    return out.orderBy(F.col("price_now").desc_nulls_last(), "zip")


def assessment_section(ratio: DataFrame) -> DataFrame:
    """Badge warning above 1.2x, success below 0.95x; lowest ratio first."""
    badge = _badge("median_ratio", [(">", 1.2, "badge-warning"), ("<", 0.95, "badge-success")])
    out = ratio.select("*", badge.alias("badge"), S.ratio_text("median_ratio", 2).alias("ratio_text"))
    return out.orderBy(F.col("median_ratio").asc_nulls_last(), "zip")


def flip_section(flips: DataFrame, top: int = 10) -> DataFrame:
    """The first `top` flips of each outcome in account order (the report's
    top-10 lists), with the property detail line. Accounts sort as numbers where they
    are numbers, others after them as text."""
    account = F.col("account").cast("string")
    w = Window.partitionBy("outcome").orderBy(account.try_cast("decimal(38,0)").asc_nulls_last(), account.asc_nulls_last(),
                                              F.col("first_sale_date"), F.col("second_sale_date"))
    detail = F.when(F.col("sqft").isNotNull() & (F.col("sqft") != 0), F.concat(
        F.format_number("sqft", 0), F.lit(" sqft"),
        F.when(F.col("beds").isNotNull() & (F.col("beds") != 0),
               F.concat(F.lit(", "), S.fixed_text(F.col("beds"), 0), F.lit(" bed"))).otherwise(F.lit(""))))
    ranked = flips.withColumn("position", F.row_number().over(w).cast("bigint")).where(F.col("position") <= top)
    badge = F.when(F.col("outcome") == L.OUTCOME_PROFIT, F.lit("badge-success")).otherwise(F.lit("badge-danger"))
    out = ranked.select("*", detail.alias("detail"), badge.alias("badge"),
                        S.money_text("first_sale_price").alias("first_price_text"),
                        S.money_text("second_sale_price").alias("second_price_text"),
                        S.pct_text("markup_pct", 1, signed=True).alias("markup_text"),
                        S.day_label("first_sale_date").alias("first_label"),
                        S.day_label("second_sale_date").alias("second_label"))
    return out.orderBy(F.col("outcome").desc(), "position")


def investor_section(inv: DataFrame) -> DataFrame:
    """Badge warning above 60 %, success below 30 %, bar width; highest share first."""
    badge = _badge("investor_share", [(">", 0.6, "badge-warning"), ("<", 0.3, "badge-success")])
    out = inv.select("*", badge.alias("badge"), S.bar_width("investor_share").alias("bar_width"),
                     S.pct_text("investor_share", 0).alias("share_text"))
    return out.orderBy(F.col("investor_share").desc_nulls_last(), "zip")


def health_section(health: DataFrame) -> DataFrame:
    """Badge per source status."""
    return health.select("*", F.when(F.col("status") == "OK", F.lit("badge-success"))
                         .otherwise(F.lit("badge-danger")).alias("badge"))
