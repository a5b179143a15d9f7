"""Metric plans: golden values and a synthetic county fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homestat.functions import labels as L
from homestat.plans import metrics as M

D = dt.date


def test_price_pressure_golden(spark):
    weeks = [(D(2026, 1, 11), 420000.0, 0.96, -0.03), (D(2026, 1, 18), 416875.0, 0.957920281, -0.037518038),
             (D(2026, 1, 25), 418500.0, 0.951554362, -0.042060086),
             (D(2026, 2, 1), 418250.0, 0.950200474, -0.048079659),
             (D(2026, 2, 8), 418250.0, 0.952593451, -0.064579256)]
    price = spark.createDataFrame([("FL", w, p, y) for w, p, _, y in weeks],
                                  "region string, period_end date, median_price double, price_yoy double")
    ratio = spark.createDataFrame([("FL", w, r) for w, _, r, _ in weeks],
                                  "region string, period_end date, sale_to_list double")
    out = M.price_pressure(price, ratio).orderBy("week").collect()
    assert [r["week"] for r in out] == [w for w, *_ in weeks[1:]]
    assert out[0]["price_delta"] is None
    assert out[1]["price_delta"] == pytest.approx(0.00389805097451279, abs=1e-15)
    assert out[2]["price_delta"] == pytest.approx(-0.0005973715651135247, abs=1e-15)
    assert out[3]["price_delta"] == 0.0
    assert [r["signal"] for r in out] == [
        "BUYERS LEVERAGE (Ratio: 95.8%)", "BUYERS LEVERAGE (Ratio: 95.2%, Price UP)",
        "BUYERS LEVERAGE (Ratio: 95.0%, Price DOWN)", "BUYERS LEVERAGE (Ratio: 95.3%, Price UP)"]


def test_price_pressure_without_yoy_column_and_many_regions(spark):
    rows = [(reg, D(2026, 1, d), 100.0 + d, 1.01) for reg in ("A", "B") for d in range(1, 8)]
    price = spark.createDataFrame([r[:3] for r in rows], "region string, period_end date, median_price double")
    ratio = spark.createDataFrame([(r[0], r[1], r[3]) for r in rows], "region string, period_end date, sale_to_list double")
    out = M.price_pressure(price, ratio).collect()
    assert len(out) == 8 and {r["price_yoy"] for r in out} == {0.0}
    assert all(r["signal"].startswith("SELLERS CONTROL") for r in out)


def test_inventory_absorption_golden(spark):
    rows = [(D(2026, 2, 8), 31, -8, 447.5, 193.5), (D(2026, 2, 1), 30, -6, 435.75, 195.75),
            (D(2026, 1, 25), 31, -8, 396.25, 189.0), (D(2026, 1, 18), 31, -7, 332.75, 183.5),
            (D(2026, 1, 11), 29, -1, 300.0, 180.0)]
    sup = spark.createDataFrame([("FL", r[0], r[1], r[2]) for r in rows],
                                "region string, period_end date, supply int, supply_yoy_abs int")
    lis = spark.createDataFrame([("FL", r[0], r[3]) for r in rows], "region string, period_end date, new_listings double")
    sold = spark.createDataFrame([("FL", r[0], r[4]) for r in rows], "region string, period_end date, homes_sold double")
    out = {r["week"]: r for r in M.inventory_absorption(sup, lis, sold).collect()}
    assert sorted(out) == [r[0] for r in rows[:4]][::-1]
    exp = {D(2026, 2, 8): -0.20512820512820512, D(2026, 2, 1): -0.16666666666666666,
           D(2026, 1, 25): -0.20512820512820512, D(2026, 1, 18): -0.18421052631578946}
    for w, v in exp.items():
        assert out[w]["supply_yoy"] == pytest.approx(v, abs=1e-15)
        assert out[w]["market_state"] == L.STATE_BUYERS
    assert out[D(2026, 2, 8)]["absorption_ratio"] == pytest.approx(193.5 / 447.5)


GOLDEN_M4 = [("2025-09-30", 401811.3393225914, 2164.357272865057, 0.06463801474136353, "→ Flat"),
             ("2025-10-31", 398961.7377214578, 2167.280984066713, 0.06518763417598222, "↑ Expanding"),
             ("2025-11-30", 396953.01625397545, 2167.8664639834155, 0.06553520568579495, "↑ Expanding"),
             ("2025-12-31", 395966.3143358417, 2165.529989008533, 0.0656277034870746, "↑ Expanding"),
             ("2026-01-31", 395743.929618426, 2156.460091949672, 0.06538955917364803, "↓ Compressing"),
             ("2026-02-28", 395847.6113887178, 2134.553875498804, 0.06470835182287449, "↓ Compressing")]


def test_trend_lines_golden(spark):
    months = ["2025-08-31"] + [m for m, *_ in GOLDEN_M4]
    zhvi = [402000.0] + [z for _, z, *_ in GOLDEN_M4]
    zori = [2160.0] + [r for _, _, r, *_ in GOLDEN_M4]
    cols = ", ".join(f"`{m}` double" for m in months)
    value = spark.createDataFrame([tuple(["Gulf County", "FL"] + zhvi)], f"region string, StateName string, {cols}")
    rent = spark.createDataFrame([tuple(["Gulf County", "FL"] + zori)], f"region string, StateName string, {cols}")
    parcels = spark.createDataFrame([(300000.0, 1500.0), (500000.0, 0.0), (0.0, 900.0), (400000.0, 2000.0)],
                                    "just double, living double")
    out = M.trend_lines(value, rent, parcels).orderBy("month").collect()
    assert len(out) == 6
    for r, (m, z, rr, flow, direction) in zip(out, GOLDEN_M4):
        assert str(r["month"]) == m
        assert r["flow_ratio"] == pytest.approx(flow, rel=1e-12)
        assert r["direction"] == direction
        assert r["appraisal_gap"] == pytest.approx((z - 350000.0) / 350000.0)


def test_trend_lines_missing_rent_month_is_zero(spark):
    value = spark.createDataFrame([("X", 100.0, 110.0)], "region string, `2026-01-31` double, `2026-02-28` double")
    rent = spark.createDataFrame([("X", 1.0)], "region string, `2026-01-31` double")
    parcels = spark.createDataFrame([(0.0, 0.0)], "just double, living double")
    out = M.trend_lines(value, rent, parcels).orderBy("month").collect()
    assert [r["zori"] for r in out] == [1.0, 0.0]
    assert [r["flow_ratio"] for r in out] == [pytest.approx(0.12), 0.0]
    assert [r["appraisal_gap"] for r in out] == [0.0, 0.0]


def test_metric_history_trend_golden(spark):
    from homestat.sources.history import metric_trend
    runs = [(D(2026, 3, 5), 229), (D(2026, 3, 12), 236), (D(2026, 3, 19), 247), (D(2026, 3, 26), 251),
            (D(2026, 4, 2), 249)]
    df = spark.createDataFrame([(d, "flip_detector", n) for d, n in runs], "run_date date, metric string, n long")
    out = [r["delta"] for r in metric_trend(df).orderBy("run_date").collect()]
    assert out == [None, 7, 11, 4, -2]


# ------------------------------------------------------------------ synthetic county fixture

AS_OF = dt.datetime(2026, 4, 1)


def _day(n):
    return AS_OF - dt.timedelta(days=n)


@pytest.fixture()
def county(spark):
    parcels = [
        ("0000007002", "12.0", "Main St", "N", None, "34231", "1500", "300000", "3", "X"),
        ("0000008000", "5", "Oak Ave", None, "2", "34231-1234", "1200", "250000", "2", None),
        ("0000009000", "9", "Pine Rd", None, None, "34300", "1000", "200000", "2", " X "),
        ("0000010000", "1", "Elm St", None, None, None, "0", "0", None, None),
        ("0000011000", "3", "Bay Dr", None, None, "34232", "900", "100000", "1", None),
        ("0000011000", "3", "Bay Dr", None, None, "34232", "900", "100000", "1", None),   # duplicate account
    ]
    p = spark.createDataFrame(parcels, "ACCOUNT string, LOCN string, LOCS string, LOCD string, UNIT string, "
                                       "LOCZIP string, LIVING string, JUST string, BEDR string, HOMESTEAD string")
    from homestat.sources.readers import clean_parcels, clean_sales
    sales = [
        # padded vs unpadded account, hold of exactly 120 days, recent
        ("7002", _day(150), 200000.0), ("7002", _day(30), 260000.0),
        # hold 119 (too short) then 365 later
        ("8000", _day(500), 100000.0), ("8000", _day(381), 150000.0), ("8000", _day(16), 160000.0),
        # markup -0.50 kept, -0.51 dropped
        ("9000", _day(300), 100000.0), ("9000", _day(100), 50000.0),
        ("11000", _day(300), 100000.0), ("11000", _day(100), 49000.0),
        # equal price is a loss; null date pairs with nothing
        ("10000", _day(400), 80000.0), ("10000", _day(170), 80000.0), ("10000", None, 90000.0),
        # bulk: four sales sharing date and price are removed, three are not
        ("20001", _day(200), 55555.0), ("20002", _day(200), 55555.0), ("20003", _day(200), 55555.0),
        ("20004", _day(200), 55555.0), ("20004", _day(60), 70000.0),
        ("30001", _day(220), 44444.0), ("30002", _day(220), 44444.0), ("30003", _day(220), 44444.0),
        ("30003", _day(50), 60000.0),
    ]
    s = spark.createDataFrame([(a, d.strftime("%Y-%m-%d") if d else None, str(p), "WD") for a, d, p in sales],
                              "Account string, SaleDate string, SalePrice string, DeedType string")
    return clean_sales(s), clean_parcels(p)


def test_resale_flips_fixture(spark, county):
    sales, parcels = county
    out = {(r["account"], r["days_held"]): r for r in
           M.resale_flips(sales, parcels, as_of=AS_OF, city="Bayside FL").collect()}
    assert set(out) == {("7002", 120), ("8000", 365), ("9000", 200), ("10000", 230), ("30003", 170)}
    assert out[("7002", 120)]["outcome"] == "PROFITABLE"
    assert out[("7002", 120)]["address"] == "12 Main St N, Bayside FL 34231"
    assert out[("8000", 365)]["address"] == "5 Oak Ave #2, Bayside FL 34231"
    assert out[("9000", 200)]["markup_pct"] == -0.5 and out[("9000", 200)]["outcome"] == "LOSS"
    assert out[("10000", 230)]["outcome"] == "LOSS"
    assert out[("30003", 170)]["address"] == "Address unavailable"
    assert out[("7002", 120)]["sqft"] == 1500.0 and out[("7002", 120)]["beds"] == 3.0


def test_zip_metrics_fixture(spark, county):
    sales, parcels = county
    z = {r["zip"]: r for r in M.trailing_year_trend(sales, parcels, as_of=AS_OF).collect()}
    # 34231 (7002 and the ZIP+4 parcel 8000): now = 200k, 260k, 160k; prior = 100k, 150k
    assert set(z) == {"34231"}
    assert z["34231"]["price_now"] == 200000.0 and z["34231"]["price_prior"] == 125000.0
    assert z["34231"]["sales_volume"] == 3 and z["34231"]["zip_display"] == "34231*"
    assert z["34231"]["yoy_change"] == pytest.approx(0.6) and z["34231"]["yoy_flag"] == "low_data"
    a = {r["zip"]: r["median_ratio"] for r in M.assessment_ratio(sales, parcels, as_of=AS_OF).collect()}
    assert a["34231"] == pytest.approx(statistics_median([200000 / 300000, 260000 / 300000, 160000 / 250000]))
    assert "34232" in a  # duplicated parcel account doubles its sales, like the source
    b = M.buyer_value_index(sales, parcels, as_of=AS_OF, min_sales=2).collect()
    assert {r["zip"] for r in b} == {"34231", "34232"}
    inv = {r["zip"]: (r["total_sales"], r["investor_share"]) for r in
           M.investor_activity(sales, parcels, as_of=AS_OF).collect()}
    assert inv["34231"] == (3, pytest.approx(1 / 3))
    assert inv["34232"] == (4, 1.0)


def statistics_median(vals):
    import statistics
    return statistics.median(vals)


def test_investor_activity_without_homestead(spark, county):
    sales, parcels = county
    assert M.investor_activity(sales, parcels.drop("homestead"), as_of=AS_OF).count() == 0


def test_run_metrics_and_snapshot(spark, county):
    sales, parcels = county
    price = spark.createDataFrame([("ALL", D(2026, 3, 1), 400000.0, -0.02)],
                                  "region string, period_end date, median_price double, price_yoy double")
    ratio = spark.createDataFrame([("ALL", D(2026, 3, 1), 0.96)], "region string, period_end date, sale_to_list double")
    sup = spark.createDataFrame([("ALL", D(2026, 3, 1), 20, None)],
                                "region string, period_end date, supply int, supply_yoy_abs int")
    lis = spark.createDataFrame([("ALL", D(2026, 3, 1), 10.0)], "region string, period_end date, new_listings double")
    sold = spark.createDataFrame([("ALL", D(2026, 3, 1), 5.0)], "region string, period_end date, homes_sold double")
    res = M.run_metrics({"sales": sales, "parcels": parcels, "price": price, "ratio": ratio, "supply": sup,
                         "listings": lis, "sold": sold}, as_of=AS_OF, materialize=True)
    snap = res["market_snapshot"].first()
    assert snap["market_phase"] == L.PHASE_BUYERS
    assert snap["headline"].startswith("With 20 months of supply and a median price of $400,000")
    assert snap["flip_summary"] == "5 total — 3 profitable, 2 loss"
    assert snap["hottest_zip"] is None and snap["hottest_zip_label"] == ""
    assert snap["flip_count_in_range"] is False
    assert set(res) == {"price_pressure", "inventory_absorption", "buyer_value_index", "zip_price_trends",
                        "assessment_ratio", "investor_activity", "flip_detector", "flip_summary", "market_snapshot"}
