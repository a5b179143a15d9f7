"""Scalar functions and label rules: every threshold at, below and above."""

import pytest
from pyspark.sql import functions as F

from homestat.functions import labels as L
from homestat.functions import scalars as S


def one(spark, expr, value, dtype="double"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [("0000007002", "7002"), ("7002", "7002"), ("  0042 ", "42"),
                                          ("000", ""), ("\t12\n", "12"), (None, None)])
def test_normalize_account(spark, raw, expected):
    assert one(spark, S.normalize_account, raw, "string") == expected


@pytest.mark.parametrize("raw,expected", [
    ("123 Main Street", "123 MAIN ST"), ("45 north avenue", "45 N AVE"),
    ("  7 O'Brien   Boulevard ", "7 OBRIEN BLVD"), ("1 Northgate Rd.", "1 NGATE RD"),
    ("9 West Highway", "9 W HWY"), ("10 Parkway Terrace", "10 PKWY TER"), ("Parkway Terrace", "PARKWAY TER"), (None, "")])
def test_normalize_address(spark, raw, expected):
    assert one(spark, S.normalize_address, raw, "string") == expected


def test_build_address(spark):
    rows = [("12.0", "Main St", "N", "4B", "34231-1234"), ("7", "Oak Ave", None, "nan", None),
            (None, None, None, None, "34231"), ("nan", "", " ", None, " 34232 ")]
    df = spark.createDataFrame(rows, "n string, s string, d string, u string, z string")
    out = [r[0] for r in df.select(S.build_address("n", "s", "d", "u", "z", "Bayside FL")).collect()]
    assert out == ["12 Main St N #4B, Bayside FL 34231", "7 Oak Ave, Bayside FL", "Bayside FL 34231",
                   "Bayside FL 34232"]


@pytest.mark.parametrize("raw,expected", [('"452,872.5"', 452872.5), ("1,000", 1000.0), ("abc", None),
                                          ("1d", None), ("NaN", None), ("", None), (" 3.5 ", 3.5)])
def test_clean_number(spark, raw, expected):
    assert one(spark, S.clean_number, raw, "string") == expected


def test_zip5_and_dates(spark):
    assert one(spark, S.zip5, " 34231-1234", "string") == "34231"
    assert str(one(spark, S.parse_us_date, "2/8/2026", "string")) == "2026-02-08"
    assert one(spark, S.parse_us_date, "13/45/2026", "string") is None
    assert str(one(spark, S.stem_date, "history_20260402", "string")) == "2026-04-02"
    assert one(spark, S.stem_date, "history_2026040", "string") is None


@pytest.mark.parametrize("x,d,signed,expected", [(0.9525, 1, False, "95.3%"), (-0.0375, 1, True, "-3.8%"),
                                                 (0.0, 1, True, "+0.0%"), (0.5, 0, False, "50%"),
                                                 (1.0, 1, False, "100.0%"), (None, 1, False, None)])
def test_pct_text(spark, x, d, signed, expected):
    assert one(spark, lambda c: S.pct_text(c, d, signed), x) == expected


def test_money_ratio_bar(spark):
    assert one(spark, S.money_text, 418250.0) == "$418,250"
    assert one(spark, S.money_text, 2.5) == "$2"  # half-even like Python's format
    assert one(spark, lambda c: S.ratio_text(c, 2), 1.2345) == "1.23x"
    assert one(spark, S.bar_width, 0.456) == 45
    assert one(spark, S.bar_width, 1.7) == 100


@pytest.mark.parametrize("ratio,delta,expected", [
    (0.957920281, None, "BUYERS LEVERAGE (Ratio: 95.8%)"),
    (0.95, 0.0, "BUYERS LEVERAGE (Ratio: 95.0%, Price UP)"),
    (0.97, -0.01, "NEUTRAL (Ratio: 97.0%, Price DOWN)"),
    (1.0, 0.01, "NEUTRAL (Ratio: 100.0%, Price UP)"),
    (1.0001, None, "SELLERS CONTROL (Ratio: 100.0%)")])
def test_price_signal(spark, ratio, delta, expected):
    df = spark.createDataFrame([(ratio, delta)], "r double, d double")
    assert df.select(L.price_signal("r", "d")).first()[0] == expected


@pytest.mark.parametrize("supply,state", [(18.0, L.STATE_BALANCED), (18.5, L.STATE_BUYERS), (8.0, L.STATE_BALANCED),
                                          (7.9, L.STATE_SELLERS), (None, L.STATE_BALANCED)])
def test_market_state(spark, supply, state):
    assert one(spark, L.market_state, supply) == state


@pytest.mark.parametrize("ratio,meaning", [(0.9499, L.MEANING_BELOW), (0.95, L.MEANING_NEAR), (1.05, L.MEANING_ABOVE),
                                           (1.1999, L.MEANING_ABOVE), (1.2, L.MEANING_WELL_ABOVE)])
def test_ratio_meaning(spark, ratio, meaning):
    assert one(spark, L.ratio_meaning, ratio) == meaning


@pytest.mark.parametrize("ratio,signal", [(1.31, L.BUYER_WELL_ABOVE), (1.3, L.BUYER_ABOVE), (1.1, L.BUYER_NEAR),
                                          (0.95, L.BUYER_NEAR), (0.9499, L.BUYER_BELOW)])
def test_buyer_signal(spark, ratio, signal):
    assert one(spark, L.buyer_signal, ratio) == signal


@pytest.mark.parametrize("gap,flag", [(0.16, L.FLAG_HOT), (0.15, ""), (0.0, L.FLAG_COOLING), (-0.1, L.FLAG_COOLING),
                                      (None, "")])
def test_appraisal_flag(spark, gap, flag):
    assert one(spark, L.appraisal_flag, gap) == flag


@pytest.mark.parametrize("supply,yoy,phase", [
    (18.0, None, L.PHASE_BUYERS), (18.0, -0.01, L.PHASE_BUYERS), (18.0, 0.0, L.PHASE_SHIFTING),
    (8.0, 0.01, L.PHASE_SELLERS), (8.0, 0.0, L.PHASE_COOLING), (8.0, None, L.PHASE_COOLING),
    (12.0, 0.5, L.PHASE_BALANCED), (None, 0.5, L.PHASE_UNAVAILABLE)])
def test_market_phase(spark, supply, yoy, phase):
    df = spark.createDataFrame([(supply, yoy)], "s double, y double")
    assert df.select(L.market_phase("s", "y")).first()[0] == phase


def test_yoy_supply_labels_and_headline(spark):
    df = spark.createDataFrame([(0.045, 31.0, 418250.0, "Buyer's Market")], "y double, s double, p double, ph string")
    r = df.select(L.yoy_label("y"), L.supply_label("s"),
                  L.headline(F.col("ph"), F.col("s"), F.col("p"))).first()
    assert r[0] == "+4.5% vs. last year (up)"
    assert r[1] == L.SUPPLY_HIGH
    assert r[2] == ("With 31 months of supply and a median price of $418,250, buyers currently have more "
                    "negotiating room than usual.")
    nul = spark.createDataFrame([(None, None, 5.0, "Balanced Market")], "y double, s double, p double, ph string")
    r = nul.select(L.yoy_label("y"), L.supply_label("s"), L.headline(F.col("ph"), F.col("s"), F.col("p"))).first()
    assert (r[0], r[1], r[2]) == (L.YOY_UNAVAILABLE, "", L.HEADLINE_GENERIC)


def test_flip_labels(spark):
    df = spark.createDataFrame([(100.0, 100.0, 0, 0, 0), (100.0, 101.0, 3, 2, 1)], "a double, b double, t int, p int, l int")
    out = df.select(L.flip_outcome("a", "b"), L.flip_summary("t", "p", "l"), L.in_sane_range("t")).collect()
    assert [tuple(r) for r in out] == [("LOSS", "No flips detected", False), ("PROFITABLE", "3 total — 2 profitable, 1 loss", False)]


def test_low_volume_and_yoy_flag(spark):
    df = spark.createDataFrame([("34231", 19, 0.41), ("34232", 20, -0.40)], "z string, v long, y double")
    out = df.select(L.zip_display("z", L.low_volume("v")), L.yoy_flag("y")).collect()
    assert [tuple(r) for r in out] == [("34231*", "low_data"), ("34232", "")]
