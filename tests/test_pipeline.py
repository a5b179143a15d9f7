"""The weekly job end to end on landed files of every kind."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from homestat.plans.pipeline import weekly_run

AS_OF = dt.datetime(2026, 4, 2)

WEEKLY = {
    "median sale price.csv": ("Median Sale Price Yoy", "Median Sale Price", ["0.01", '"416,875"', '"418,500"']),
    "average sale to list ratio.csv": ("Average Sale To List Ratio Yoy", "Average Sale To List Ratio",
                                       ["0", "0.958", "0.952"]),
    "months of supply.csv": ("Months Of Supply Yoy", "Months Of Supply", ["-7", "31", "30"]),
    "new listings.csv": ("Adjusted Average New Listings Yoy", "Adjusted Average New Listings", ["0", "332.75", "396.25"]),
    "homes sold.csv": ("Adjusted Average Homes Sold Yoy", "Adjusted Average Homes Sold", ["0", "183.5", "189.0"]),
    "days to close.csv": ("Median Days To Close Yoy", "Median Days To Close", ["0", "30", "31"]),
}


def _land(scratch):
    wk = os.path.join(scratch, "weekly")
    os.makedirs(wk)
    for name, (yoy_col, col, vals) in WEEKLY.items():
        with open(os.path.join(wk, name), "w") as f:
            f.write(f"Period Begin,Period End,{yoy_col},{col}\n")
            f.write(f"12/22/2025,1/18/2026,{vals[0]},{vals[1]}\n")
            f.write(f"12/29/2025,1/25/2026,{vals[0]},{vals[2]}\n")
        os.utime(os.path.join(wk, name), (time.mktime(AS_OF.timetuple()),) * 2)
    head = "RegionID,SizeRank,RegionName,RegionType,StateName,State,Metro,StateCodeFIPS,MunicipalCodeFIPS"
    for name, base in (("value.csv", 400000.0), ("rent.csv", 2100.0)):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(head + ",2026-01-31,2026-02-28\n")
            f.write(f'1,1,Gulf County,county,FL,FL,"Bay, FL",12,1,{base},{base * 1.01}\n')
            f.write(f'2,2,Other County,county,GA,GA,"X, GA",13,1,1,2\n')
    with open(os.path.join(scratch, "parcels.csv"), "w", encoding="latin-1") as f:
        f.write("ACCOUNT,LOCN,LOCS,LOCCITY,LOCZIP,LIVING,JUST,BEDR,HOMESTEAD\n")
        f.write("0000007002,12,Main St,BAYSIDE,34231,1500,300000,3,X\n")
        f.write("0000008000,5,Oak Ave,BAYSIDE,34232,1200,250000,2,\n")
    with open(os.path.join(scratch, "sales.csv"), "w", encoding="latin-1") as f:
        f.write("Account,SaleDate,SalePrice,DeedType\n")
        for acct, day, price in [("7002", 500, 200000), ("7002", 300, 240000), ("7002", 20, 300000),
                                 ("8000", 400, 150000), ("8000", 100, 90000)]:
            f.write(f"{acct},{(AS_OF - dt.timedelta(days=day)).date()},{price},WD\n")
        f.write("8000,2026-01-01,1000,QC\n")
    return wk


def test_weekly_run_end_to_end(spark, scratch):
    wk = _land(scratch)
    out = os.path.join(scratch, "out")
    res = weekly_run(spark, out_dir=out, as_of=AS_OF, weekly_dir=wk, value_index=os.path.join(scratch, "value.csv"),
                     rent_index=os.path.join(scratch, "rent.csv"), parcels=os.path.join(scratch, "parcels.csv"),
                     sales=os.path.join(scratch, "sales.csv"), state="FL", region_name="Gulf County",
                     city="Bayside")
    r = res["results"]
    assert set(r) >= {"price_pressure", "inventory_absorption", "trend_lines", "zip_price_trends",
                      "assessment_ratio", "buyer_value_index", "investor_activity", "flip_detector",
                      "market_snapshot"}
    pp = r["price_pressure"].orderBy("week").collect()
    assert [p["median_price"] for p in pp] == [416875.0, 418500.0]
    snap = r["market_snapshot"].first()
    assert snap["weeks_supply"] == 30.0 and snap["market_phase"] == "Shifting Toward Buyers"
    flips = r["flip_detector"].collect()
    assert sorted((f["account"], f["days_held"], f["outcome"]) for f in flips) == [("7002", 280, "PROFITABLE"),
                                                                                   ("8000", 300, "LOSS")]
    assert r["trend_lines"].count() == 2
    health = {h["source"]: h["status"] for h in res["health"].collect()}
    assert len(health) == 10 and set(health.values()) == {"OK"}
    sections = spark.read.parquet(os.path.join(out, "sections", "prices"))
    assert sections.where(F.col("run_date") == "2026-04-02").count() == 2
    hist = {h["metric"]: h["n"] for h in spark.read.parquet(os.path.join(out, "history")).collect()}
    assert hist["flip_detector"] == 2 and hist["price_pressure"] == 2
    assert hist["market_snapshot"] == hist["flip_summary"] == 0 and len(hist) == 10
    assert r["flip_summary"].first()[0].startswith("2 total")
    assert res["expired_runs"] == [] and res["has_metrics"]
    assert {x["source"]: x["rejected"] for x in res["rejected"].collect()} == dict.fromkeys(
        ["median_sale_price", "homes_sold", "new_listings", "days_to_close", "weeks_of_supply", "avg_sale_to_list"], 0)
    again = dict(out_dir=out, as_of=AS_OF + dt.timedelta(days=29), sales=os.path.join(scratch, "sales.csv"))
    assert weekly_run(spark, **again)["expired_runs"] == [AS_OF.date()]  # that run leaves the history
    left = {str(h["run_date"]) for h in spark.read.parquet(os.path.join(out, "history")).select("run_date").collect()}
    assert left == {"2026-05-01"}


def test_missing_inputs_are_tolerated_and_reported(spark, scratch):
    wk = _land(scratch)
    os.remove(os.path.join(wk, "homes sold.csv"))  # an incomplete set does not count
    res = weekly_run(spark, out_dir=os.path.join(scratch, "out"), as_of=AS_OF, weekly_dir=wk,
                     value_index=os.path.join(scratch, "value.csv"), rent_index=os.path.join(scratch, "rent.csv"),
                     parcels=os.path.join(scratch, "none.csv"), sales=os.path.join(scratch, "sales.csv"),
                     state="FL", region_name="Gulf County")
    health = {h["source"]: h["status"] for h in res["health"].collect()}
    assert {k for k, v in health.items() if v == "OK"} == {"value_index", "rent_index", "sales"}
    assert len(health) == 10 and not res["health"].first()["degraded"]
    assert set(res["results"]) == {"trend_lines", "flip_detector", "flip_summary", "market_snapshot"}
    assert {x["appraisal_gap"] for x in res["results"]["trend_lines"].collect()} == {0.0}
    snap = res["results"]["market_snapshot"].first()
    assert snap["flip_count"] == 2 and snap["median_price"] is None and snap["market_phase"] == "Market Data Unavailable"


def test_a_run_without_any_source(spark, scratch):
    os.makedirs(os.path.join(scratch, "empty"))
    for folder in ("empty", "nowhere"):
        res = weekly_run(spark, out_dir=os.path.join(scratch, f"out-{folder}"), as_of=AS_OF, weekly_dir=os.path.join(scratch, folder))
        assert not res["has_metrics"] and res["health"].first()["degraded"]
        assert {h["n"] for h in spark.read.parquet(os.path.join(scratch, f"out-{folder}", "history")).collect()} == {0}


def test_a_missing_yoy_column_counts_as_zero(spark, scratch):
    wk = _land(scratch)
    path = os.path.join(wk, "median sale price.csv")
    with open(path, "w") as f:
        f.write('Period End,Median Sale Price\n1/18/2026,"416,875"\nnot a date,5\n')
    os.utime(path, (time.mktime(AS_OF.timetuple()),) * 2)
    res = weekly_run(spark, out_dir=os.path.join(scratch, "out"), as_of=AS_OF, weekly_dir=wk)
    assert [x["price_yoy"] for x in res["results"]["price_pressure"].collect()] == [0.0]
    assert {x["source"]: x["rejected"] for x in res["rejected"].collect()}["median_sale_price"] == 1
