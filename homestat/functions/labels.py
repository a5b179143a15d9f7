"""Label rules as CASE WHEN expressions.

NULL inputs fall through to the `otherwise` branch, the way a NaN comparison is
false in the row functions these rules describe.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from homestat.functions.scalars import col_of, pct_text, fixed_text, money_text

# Every label text and threshold below must stay exactly as written.
SIGNAL_SELLERS = "SELLERS CONTROL"
SIGNAL_BUYERS = "BUYERS LEVERAGE"
SIGNAL_NEUTRAL = "NEUTRAL"
STATE_BUYERS = "Buyer's Market — Lots of inventory to choose from"
STATE_SELLERS = "Seller's Market — Limited homes available"
STATE_BALANCED = "Balanced Market — Normal amount of inventory"
OUTCOME_PROFIT = "PROFITABLE"
OUTCOME_LOSS = "LOSS"
MEANING_BELOW = "Selling below assessed — buyers getting value"
MEANING_NEAR = "Near assessed value — fair market"
MEANING_ABOVE = "Selling above assessed — competitive zip"
MEANING_WELL_ABOVE = "Well above assessed — high demand area"
BUYER_WELL_ABOVE = "Well above assessed"
BUYER_ABOVE = "Above assessed"
BUYER_NEAR = "Near assessed value"
BUYER_BELOW = "Below assessed"
FLAG_HOT = "HOT_MARKET"
FLAG_COOLING = "COOLING"
FLAG_LOW_DATA = "low_data"
DIR_UP = "↑ Expanding"
DIR_DOWN = "↓ Compressing"
DIR_FLAT = "→ Flat"
SUPPLY_HIGH = "Buyers have significant leverage"
SUPPLY_LOW = "Limited homes available — competitive market"
SUPPLY_MID = "Balanced inventory levels"
PHASE_BUYERS = "Buyer's Market"
PHASE_SHIFTING = "Shifting Toward Buyers"
PHASE_SELLERS = "Seller's Market"
PHASE_COOLING = "Cooling Seller's Market"
PHASE_BALANCED = "Balanced Market"
PHASE_UNAVAILABLE = "Market Data Unavailable"
YOY_UNAVAILABLE = "Year-over-year change unavailable"
HEADLINE_GENERIC = "See sections below for detailed market conditions."
NO_FLIPS = "No flips detected"
ADDRESS_UNAVAILABLE = "Address unavailable"

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "==": operator.eq, "!=": operator.ne}


def band(c, rules, otherwise) -> Column:
    """First matching rule wins: rules = [(op, limit, label), ...]."""
    c = col_of(c)
    expr = None
    for op, limit, label in rules:
        cond = _OPS[op](c, F.lit(limit))
        lab = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    other = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return other if expr is None else expr.otherwise(other)


def price_signal(ratio, delta) -> Column:
    """L1: '<LABEL> (Ratio: 95.3%, Price UP|DOWN)'; no price part when delta is NULL."""
    ratio, delta = col_of(ratio), col_of(delta)
    label = band(ratio, [(">", 1.0, SIGNAL_SELLERS), ("<", 0.97, SIGNAL_BUYERS)], SIGNAL_NEUTRAL)
    trend = F.when(delta < 0, F.lit("DOWN")).otherwise(F.lit("UP"))
    price = F.when(delta.isNotNull(), F.concat(F.lit(", Price "), trend)).otherwise(F.lit(""))
    return F.concat(label, F.lit(" (Ratio: "), F.coalesce(pct_text(ratio, 1), F.lit("nan%")),
                    price, F.lit(")"))


def market_state(supply) -> Column:
    """L2 (strict bounds)."""
    return band(supply, [(">", 18, STATE_BUYERS), ("<", 8, STATE_SELLERS)], STATE_BALANCED)


def flip_outcome(p1, p2) -> Column:
    """L3: an equal price is a loss."""
    return F.when(col_of(p2) > col_of(p1), F.lit(OUTCOME_PROFIT)).otherwise(F.lit(OUTCOME_LOSS))


def ratio_meaning(ratio) -> Column:
    """L4."""
    return band(ratio, [("<", 0.95, MEANING_BELOW), ("<", 1.05, MEANING_NEAR),
                        ("<", 1.20, MEANING_ABOVE)], MEANING_WELL_ABOVE)


def buyer_signal(ratio) -> Column:
    """L5."""
    return band(ratio, [(">", 1.3, BUYER_WELL_ABOVE), (">", 1.1, BUYER_ABOVE),
                        (">=", 0.95, BUYER_NEAR)], BUYER_BELOW)


def appraisal_flag(gap) -> Column:
    """L6: '' when neither hot nor cooling."""
    return band(gap, [(">", 0.15, FLAG_HOT), ("<=", 0, FLAG_COOLING)], "")


def low_volume(volume, limit: int = 20) -> Column:
    """A zip with fewer sales than `limit`."""
    return col_of(volume) < F.lit(limit)


def zip_display(zipc, is_low) -> Column:
    """L7: '<zip>*' for low-volume zips."""
    return F.when(col_of(is_low), F.concat(col_of(zipc).cast("string"), F.lit("*"))) \
        .otherwise(col_of(zipc).cast("string"))


def yoy_flag(yoy, limit: float = 0.40) -> Column:
    """L7: 'low_data' when |yoy| > limit."""
    return F.when(F.abs(col_of(yoy)) > F.lit(limit), F.lit(FLAG_LOW_DATA)).otherwise(F.lit(""))


def trend_direction(cur, prev, band_width: float = 0.001) -> Column:
    """±band dead zone around the previous value; first row is flat."""
    cur, prev = col_of(cur), col_of(prev)
    return (F.when(cur > prev * F.lit(1 + band_width), F.lit(DIR_UP))
            .when(cur < prev * F.lit(1 - band_width), F.lit(DIR_DOWN))
            .otherwise(F.lit(DIR_FLAT)))


def yoy_label(yoy) -> Column:
    """L9: '+4.5% vs. last year (up)'."""
    yoy = col_of(yoy)
    word = F.when(yoy > 0, F.lit("up")).otherwise(F.lit("down"))
    return F.when(yoy.isNotNull(),
                  F.concat(pct_text(yoy, 1, signed=True), F.lit(" vs. last year ("), word, F.lit(")"))) \
        .otherwise(F.lit(YOY_UNAVAILABLE))


def supply_label(supply) -> Column:
    """L10 (strict bounds); NULL supply -> ''."""
    supply = col_of(supply)
    return F.when(supply.isNull(), F.lit("")).otherwise(
        band(supply, [(">", 18, SUPPLY_HIGH), ("<", 8, SUPPLY_LOW)], SUPPLY_MID))


def market_phase(supply, yoy) -> Column:
    """L11 (inclusive bounds, unlike L2/L10)."""
    s, y = col_of(supply), col_of(yoy)
    return (F.when(s.isNull(), F.lit(PHASE_UNAVAILABLE))
            .when((s >= 18) & (y.isNull() | (y < 0)), F.lit(PHASE_BUYERS))
            .when(s >= 18, F.lit(PHASE_SHIFTING))
            .when((s <= 8) & y.isNotNull() & (y > 0), F.lit(PHASE_SELLERS))
            .when(s <= 8, F.lit(PHASE_COOLING))
            .otherwise(F.lit(PHASE_BALANCED)))


def headline(phase, supply, median_price, area: str = "The market") -> Column:
    """L12. Without a supply figure the generic sentence is used (no crash)."""
    phase, supply, price = col_of(phase), col_of(supply), col_of(median_price)
    sup = fixed_text(supply, 0)
    money = money_text(price)
    has = price.isNotNull() & (price != 0)
    return (F.when(phase.contains("Buyer") & has & sup.isNotNull(),
                   F.concat(F.lit("With "), sup, F.lit(" months of supply and a median price of "),
                            money, F.lit(", buyers currently have more negotiating room than usual.")))
            .when(phase.contains("Seller") & has & sup.isNotNull(),
                  F.concat(F.lit("With only "), sup, F.lit(" months of supply and prices at "), money,
                           F.lit(", sellers are in a strong position — expect competition.")))
            .when(has & sup.isNotNull(),
                  F.concat(F.lit(f"{area} is balanced. Median sale price is "), money,
                           F.lit(" with "), sup, F.lit(" months of inventory.")))
            .otherwise(F.lit(HEADLINE_GENERIC)))


def hottest_zip_label(zipc, yoy, volume) -> Column:
    """L13 (hottest)."""
    return F.when(col_of(zipc).isNotNull(), F.concat(
        F.lit("Zip "), col_of(zipc).cast("string"), F.lit(" saw the strongest price growth ("),
        pct_text(yoy, 1, signed=True), F.lit(") with "), col_of(volume).cast("bigint").cast("string"),
        F.lit(" sales in the past year"))).otherwise(F.lit(""))


def best_value_label(zipc, ratio) -> Column:
    """L13 (best value)."""
    return F.when(col_of(zipc).isNotNull(), F.concat(
        F.lit("Zip "), col_of(zipc).cast("string"), F.lit(" has the lowest sale-to-assessed ratio ("),
        fixed_text(ratio, 2), F.lit("x) — relatively more affordable"))).otherwise(F.lit(""))


def flip_summary(total, profitable, loss) -> Column:
    """L14."""
    return F.when(col_of(total) > 0, F.concat(
        col_of(total).cast("string"), F.lit(" total — "), col_of(profitable).cast("string"),
        F.lit(" profitable, "), col_of(loss).cast("string"), F.lit(" loss"))).otherwise(F.lit(NO_FLIPS))


def in_sane_range(count, low: int = 10, high: int = 150) -> Column:
    """Flip count inside the expected range (a warning flag, never a filter)."""
    return (col_of(count) >= low) & (col_of(count) <= high)
