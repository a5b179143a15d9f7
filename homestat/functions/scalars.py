"""Column -> Column scalar functions (cleaning, keys, addresses, formats).

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A plain decimal / scientific number. Guards `try_cast`, which would also accept
# strings such as '1d' or 'NaN' that a pandas-style numeric coerce rejects.
NUMERIC_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Street-type and direction abbreviations, applied in this order
# as plain substring replacements (not word-bounded).
ADDRESS_ABBREVIATIONS = [
    (" STREET", " ST"), (" AVENUE", " AVE"), (" BOULEVARD", " BLVD"),
    (" DRIVE", " DR"), (" LANE", " LN"), (" COURT", " CT"),
    (" PLACE", " PL"), (" ROAD", " RD"), (" CIRCLE", " CIR"),
    (" NORTH", " N"), (" SOUTH", " S"), (" EAST", " E"), (" WEST", " W"),
    (" HIGHWAY", " HWY"), (" PARKWAY", " PKWY"), (" TERRACE", " TER"),
]

_WS = r"(?U)\s"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace of any kind (Spark `trim` only drops spaces)."""
    return F.regexp_replace(col_of(c).cast("string"), rf"^{_WS}+|{_WS}+$", "")


def nan_to_null(c) -> Column:
    """NaN compares greater than everything in Spark; turn it into NULL once at the scan."""
    return F.nanvl(col_of(c).cast("double"), F.lit(None).cast("double"))


def to_number(c, dtype=None) -> Column:
    """Coerce to DOUBLE; anything that is not a plain number becomes NULL.

    Numeric inputs are cast directly (NaN -> NULL); strings are trimmed and must
    match NUMERIC_PATTERN before `try_cast`.
    """
    c = col_of(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        return nan_to_null(c)
    s = strip_ws(c)
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def clean_number(c) -> Column:
    """Weekly-export number: drop quotes and thousands separators, then coerce."""
    return to_number(F.regexp_replace(col_of(c).cast("string"), '[",]', ""))


def normalize_account(c, dtype=None) -> Column:
    """Account key: string, whitespace-stripped, leading zeros removed ('000' -> '')."""
    c = col_of(c)
    if dtype is not None and isinstance(dtype, T.IntegralType):
        # an integer has no padding: the key is the value itself
        return c
    return F.regexp_replace(strip_ws(c), r"^0+", "")


def normalize_address(c) -> Column:
    """Upper-case, strip, drop punctuation, abbreviate street words, collapse spaces.

    NULL becomes ''. The abbreviations are substring replacements in the fixed
    order above, so ' NORTHGATE' becomes ' NGATE' and a trailing space survives.
    """
    s = F.upper(col_of(c).cast("string"))
    s = F.regexp_replace(s, rf"^{_WS}+|{_WS}+$", "")
    s = F.regexp_replace(s, r"(?U)[^A-Z0-9\s]", "")
    for full, abbr in ADDRESS_ABBREVIATIONS:
        s = F.replace(s, F.lit(full), F.lit(abbr))
    s = F.regexp_replace(s, rf"{_WS}+", " ")
    return F.coalesce(s, F.lit(""))


def zip5(c) -> Column:
    """First five characters of the stripped zip ('34231-1234' -> '34231')."""
    return F.substring(strip_ws(c), 1, 5)


def _part(c) -> Column:
    """Address part: NULL when empty or the literal 'nan' text of a missing value."""
    s = strip_ws(c)
    return F.when((s == "") | (F.lower(s) == "nan"), F.lit(None)).otherwise(s)


def build_address(number, street, direction, unit, zipcode, city: str | Column = "") -> Column:
    """'<number> <street> <dir> #<unit>, <city> <zip5>' with empty parts skipped.

    The house number loses every '.0' (a float read of '12' is '12.0'); the result
    is stripped of ',' and ' ' on both ends. A missing zip is left out.
    """
    num = _part(F.replace(col_of(number).cast("string"), F.lit(".0"), F.lit("")))
    base = F.concat_ws(" ", num, _part(street), _part(direction))
    u = _part(unit)
    base = F.when(u.isNotNull(), F.concat(base, F.lit(" #"), u)).otherwise(base)
    city_c = city if isinstance(city, Column) else F.lit(city)
    z = zip5(zipcode)
    tail = F.concat_ws(" ", F.nullif(city_c, F.lit("")), F.nullif(z, F.lit("")))
    full = F.concat(base, F.lit(", "), F.coalesce(tail, F.lit("")))
    return F.regexp_replace(full, r"^[, ]+|[, ]+$", "")


def days_between(start, end) -> Column:
    """Whole days from start to end (floor of the difference), as BIGINT."""
    return F.timestamp_diff("DAY", col_of(start), col_of(end)).cast("bigint")


def parse_us_date(c) -> Column:
    """'M/d/yyyy' text -> DATE, NULL when malformed."""
    return F.try_to_date(strip_ws(c), "M/d/yyyy")


def parse_timestamp(c) -> Column:
    """Free-form timestamp text -> TIMESTAMP, NULL when it does not parse."""
    c = col_of(c)
    return F.coalesce(F.try_to_timestamp(strip_ws(c)),
                      F.try_to_timestamp(strip_ws(c), F.lit("M/d/yyyy")),
                      F.try_to_timestamp(strip_ws(c), F.lit("M/d/yyyy H:mm")))


def stem_date(c) -> Column:
    """Date from an 8-digit 'YYYYMMDD' token (file stems such as history_20260402)."""
    tok = F.regexp_extract(col_of(c), r"(?:^|_)([0-9]{8})$", 1)
    return F.when(F.length(tok) == 8, F.try_to_date(tok, "yyyyMMdd"))


def discovery_name(c) -> Column:
    """File name normalised for pattern matching: lower case, '_' -> ' '."""
    return F.replace(F.lower(col_of(c)), F.lit("_"), F.lit(" "))


# ---------------------------------------------------------------- formatting
# Numbers are rounded half-up on the binary value: floor(|x| * 10^k + 0.5). The
# same integer arithmetic is written in the oracle SQL, so text is comparable.

def _rounded_digits(x: Column, decimals: int) -> Column:
    return F.floor(F.abs(x) * F.lit(float(10 ** decimals)) + F.lit(0.5)).cast("bigint")


def fixed_text(x, decimals: int, signed: bool = False) -> Column:
    """`{:.Nf}` / `{:+.Nf}` text of a double (NULL stays NULL)."""
    x = col_of(x)
    n = _rounded_digits(x, decimals)
    if decimals:
        scale = 10 ** decimals
        body = F.concat((n / F.lit(scale)).cast("bigint").cast("string"), F.lit("."),
                        F.lpad((n % F.lit(scale)).cast("string"), decimals, "0"))
    else:
        body = n.cast("string")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+" if signed else ""))
    return F.when(x.isNotNull(), F.concat(sign, body))


def pct_text(x, decimals: int = 1, signed: bool = False) -> Column:
    """`{:.1%}` / `{:+.1%}` text."""
    return F.concat(fixed_text(col_of(x) * F.lit(100.0), decimals, signed), F.lit("%"))


def money_text(x) -> Column:
    """`${:,.0f}` text (half-even like Python's format)."""
    return F.concat(F.lit("$"), F.format_number(col_of(x), 0))


def ratio_text(x, decimals: int = 2) -> Column:
    """`{:.2f}x` text."""
    return F.concat(fixed_text(x, decimals), F.lit("x"))


def or_dash(text: Column, dash: str = "—") -> Column:
    return F.coalesce(text, F.lit(dash))


def week_label(c) -> Column:
    """'%b %d' (e.g. 'Feb 08')."""
    return F.date_format(col_of(c), "MMM dd")


def day_label(c) -> Column:
    """'%b %d, %Y'."""
    return F.date_format(col_of(c), "MMM dd, yyyy")


def month_label(c) -> Column:
    """'%b %Y'."""
    return F.date_format(col_of(c), "MMM yyyy")


def long_day_label(c) -> Column:
    """'%B %d, %Y'."""
    return F.date_format(col_of(c), "MMMM dd, yyyy")


def bar_width(share) -> Column:
    """min(100, int(share * 100)) for share bars."""
    return F.least(F.lit(100), (col_of(share) * 100).cast("int"))
