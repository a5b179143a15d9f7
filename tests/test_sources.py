"""Scans, discovery, sinks, history and the streaming ingest on files written here."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from homestat.sources import history as H
from homestat.sources import readers as R

HEADER = ["Day of Year", "Year of Period End", "Period Begin", "Period End", "Median Sale Price Yoy",
          "Median Sale Price"]
ROWS = [["1", "2026", "12/15/2025", "1/11/2026", "0.01", "452,872.5"],
        ["8", "2026", "12/22/2025", "1/18/2026", "-0.04", "416,875"],
        ["9", "2026", "12/23/2025", "not a date", "0.0", "1"]]


def _csv_text(sep=","):
    def q(v):
        return f'"{v}"' if sep == "," and "," in v else v
    return "\n".join(sep.join(q(v) for v in r) for r in [HEADER] + ROWS) + "\n"


def test_weekly_utf8_and_utf16_detected(spark, scratch):
    utf8 = os.path.join(scratch, "median_sale_price.csv")
    with open(utf8, "w", encoding="utf-8") as f:
        f.write(_csv_text(","))
    utf16 = os.path.join(scratch, "median sale price export.csv")
    with open(utf16, "w", encoding="utf-16") as f:  # BOM + UTF-16LE
        f.write(_csv_text("\t"))
    enc = {os.path.basename(p): e for e, files in R.bom_encoding(spark, scratch).items() for p in files}
    assert enc == {"median_sale_price.csv": "UTF-8", "median sale price export.csv": "UTF-16LE"}
    for path in (utf8, utf16):
        rows = R.read_weekly_detect(spark, path, region="FL").orderBy("period_end").collect()
        assert [str(r["period_end"]) for r in rows] == ["2026-01-11", "2026-01-18"]
        assert [r["median_price"] for r in rows] == [452872.5, 416875.0]
        assert rows[0]["region"] == "FL" and rows[1]["price_yoy"] == -0.04
    assert R.rejected_weeks(spark, utf8).count() == 1


def test_county_latin1_and_cleaning(spark, scratch):
    path = os.path.join(scratch, "parcels.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write("ACCOUNT,LOCN,LOCS,LOCCITY,LOCZIP,LIVING,JUST,BEDR,EXTRA\n")
        f.write("0000007002,12.0,Peña Ave,  bayside ,34231,1500,300000,3,x\n")
        f.write("0000007003,1,Main St,VENICE,34285,1000,1,2,y\n")
    parcels = R.clean_parcels(R.read_county(spark, path), city="BAYSIDE").collect()
    assert len(parcels) == 1
    p = parcels[0]
    assert (p["account_key"], p["locs"], p["living"], p["zip"]) == ("7002", "Peña Ave", 1500.0, "34231")
    assert "homestead" not in p.asDict()


def test_wide_index_scan(spark, scratch):
    path = os.path.join(scratch, "zhvi.csv")
    with open(path, "w") as f:
        f.write('RegionID,SizeRank,RegionName,RegionType,StateName,State,Metro,StateCodeFIPS,MunicipalCodeFIPS,'
                '2025-12-31,2026-01-31\n')
        f.write('1,2,Gulf County,county,FL,FL,"North Port, FL",12,115,400000.5,401000\n')
        f.write('3,4,Other County,county,GA,GA,"X, GA",13,1,1,2\n')
    wide = R.read_index_wide(spark, path, state="FL", region_name="Gulf County")
    r = wide.first()
    assert wide.count() == 1 and r["region"] == "Gulf County" and r["2026-01-31"] == 401000.0


def test_discovery_latest_fresh_complete(spark, scratch):
    now = time.time()
    names = {"median sale price.csv": 1, "Homes_Sold.csv": 1, "new listings (2).csv": 1, "days to close.csv": 1,
             "months of supply.csv": 1, "average sale to list ratio.csv": 1, "old homes sold.csv": 10,
             "homes sold newer.csv": 0.5, "unrelated.csv": 1}
    for n, age_days in names.items():
        p = os.path.join(scratch, n)
        with open(p, "w") as f:
            f.write("a\n1\n")
        os.utime(p, (now - age_days * 86400, now - age_days * 86400))
    as_of = dt.datetime.fromtimestamp(now, dt.UTC).replace(tzinfo=None)
    found = {r["key"]: (r["name"], r["complete"]) for r in R.discover(R.list_files(spark, scratch), as_of).collect()}
    assert found["homes_sold"][0] == "homes sold newer.csv"
    assert found["weeks_of_supply"][0] == "months of supply.csv"
    assert len(found) == 6 and all(c for _, c in found.values())
    os.utime(os.path.join(scratch, "days to close.csv"), (now - 9 * 86400, now - 9 * 86400))
    again = R.discover(R.list_files(spark, scratch), as_of).collect()
    assert len(again) == 5 and not any(r["complete"] for r in again)


def test_read_or_empty(spark, scratch):
    df = R.read_or_empty(spark, os.path.join(scratch, "missing"), "a int, b string")
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_history_json_record_expire_trend(spark, scratch):
    hist = os.path.join(scratch, "history")
    os.makedirs(hist)
    for day, n in [("20260305", 229), ("20260312", 236), ("20260402", 249)]:
        with open(os.path.join(hist, f"history_{day}.json"), "w") as f:
            json.dump({"run_date": day, "metric_counts": {"flip_detector": n, "flip_summary": 0}}, f, indent=2)
    with open(os.path.join(hist, "history.json"), "w") as f:   # 'latest' copy: never read
        json.dump({"run_date": "20260402", "metric_counts": {"flip_detector": 249}}, f)
    long = H.read_history_json(spark, os.path.join(hist, "history_*.json"))
    assert long.count() == 6
    kept, expired = H.expire_history(long, dt.date(2026, 4, 3), days=28)
    assert {str(r["run_date"]) for r in expired.collect()} == {"2026-03-05"}
    assert {str(r["run_date"]) for r in kept.collect()} == {"2026-03-12", "2026-04-02"}
    files = {os.path.basename(r["path"]): str(r["run_date"]) for r in H.history_files(spark, hist).collect()}
    assert files == {"history_20260305.json": "2026-03-05", "history_20260312.json": "2026-03-12",
                     "history_20260402.json": "2026-04-02"}

    table = os.path.join(scratch, "history_table")
    H.record_run(long, table)
    again = long.where(F.col("run_date") == "2026-04-02").withColumn("n", F.col("n") + 1)
    H.record_run(again, table)  # replaces only that run's partition
    back = {(str(r["run_date"]), r["metric"]): r["n"] for r in H.read_history(spark, table).collect()}
    assert back[("2026-03-05", "flip_detector")] == 229 and back[("2026-04-02", "flip_detector")] == 250
    trend = {str(r["run_date"]): r["delta"] for r in H.metric_trend(H.read_history(spark, table))
             .where("metric = 'flip_detector'").collect()}
    assert trend == {"2026-03-05": None, "2026-03-12": 7, "2026-04-02": 14}
    assert {str(r["run_date"]) for r in H.latest_run(H.read_history(spark, table)).collect()} == {"2026-04-02"}


def test_metric_counts_counts_each_result(spark):
    results = {"a": spark.range(5), "b": spark.range(0), "summary": "text"}
    got = {r["metric"]: r["n"] for r in H.metric_counts(spark, results, dt.date(2026, 4, 2)).collect()}
    assert got == {"a": 5, "b": 0, "summary": 0}
    assert H.has_metrics(H.metric_counts(spark, results, dt.date(2026, 4, 2))).first()[0] is True


def test_source_health_degraded(spark):
    from homestat.sources.health import source_health
    empty = spark.createDataFrame([], "t timestamp_ntz")
    full = spark.createDataFrame([(dt.datetime(2026, 3, 30),)], "t timestamp_ntz")
    h = {r["source"]: r for r in source_health({"a": (empty, "t"), "b": (full, "t")}, dt.datetime(2026, 4, 1),
                                               max_age_days=7).collect()}
    assert h["a"]["status"] == "FAILED" and h["b"]["status"] == "OK" and h["b"]["age_days"] == 2
    assert not h["a"]["degraded"]
    h2 = source_health({"a": (empty, "t")}, dt.datetime(2026, 4, 1)).first()
    assert h2["degraded"]


def test_streaming_landing_ingest(spark, scratch):
    from homestat.streaming.landing import start_weekly_ingest
    landing, out, ck = (os.path.join(scratch, d) for d in ("landing", "out", "ck"))
    os.makedirs(landing)
    with open(os.path.join(landing, "week1.csv"), "w") as f:
        f.write(_csv_text(","))
    q = start_weekly_ingest(spark, landing, out, ck, HEADER, region="FL")
    q.awaitTermination(120)
    first = spark.read.parquet(out)
    assert first.count() == 2
    with open(os.path.join(landing, "week2.csv"), "w") as f:
        f.write(",".join(HEADER) + "\n1,2026,1/19/2026,1/25/2026,0.0,\"418,500\"\n")
    q = start_weekly_ingest(spark, landing, out, ck, HEADER, region="FL")
    q.awaitTermination(120)
    rows = spark.read.parquet(out).orderBy("period_end").collect()
    assert [r["median_price"] for r in rows] == [452872.5, 416875.0, 418500.0]
    assert rows[-1]["source_file"] == "week2.csv"


def test_write_table_and_archive_sections(spark, scratch):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "region string, v int")
    path = os.path.join(scratch, "clean")
    R.write_table(df, path)
    R.write_table(spark.createDataFrame([("A", 5)], "region string, v int"), path)  # replaces region A only
    back = {r["region"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert back == {"A": 5, "B": 2}
    root = os.path.join(scratch, "archive")
    R.archive_sections({"prices": df}, root, dt.date(2026, 4, 2))
    R.archive_sections({"prices": df.limit(1)}, root, dt.date(2026, 4, 9))
    runs = {str(r["run_date"]) for r in spark.read.parquet(os.path.join(root, "prices")).collect()}
    assert runs == {"2026-04-02", "2026-04-09"}


def test_utf16_big_endian_and_crlf(spark, scratch):
    rows = ["Period End\tMedian Sale Price", "1/11/2026\t452,872.5", "1/18/2026\t416,875"]
    be = os.path.join(scratch, "be.csv")
    with open(be, "wb") as f:
        f.write(("﻿" + "\n".join(rows) + "\n").encode("utf-16-be"))
    crlf = os.path.join(scratch, "crlf.csv")
    with open(crlf, "w", encoding="utf-16", newline="\r\n") as f:
        f.write("\n".join(rows) + "\n")
    for path in (be, crlf):
        got = [(str(r["period_end"]), r["median_price"]) for r in
               R.read_weekly_detect(spark, path).orderBy("period_end").collect()]
        assert got == [("2026-01-11", 452872.5), ("2026-01-18", 416875.0)], path
    plain = R.read_weekly(spark, crlf, encoding="UTF-16")  # generic name: whole-file read
    assert plain.count() == 2
    with open(os.path.join(scratch, "utf8.csv"), "w") as f:
        f.write('Period End,Median Sale Price\n1/25/2026,"418,500"\n')
    open(os.path.join(scratch, "empty.csv"), "w").close()
    both = R.read_weekly_detect(spark, os.path.join(scratch, "*.csv"))  # a folder of mixed encodings
    assert sorted(r["median_price"] for r in both.collect()) == [416875.0, 416875.0, 418500.0, 452872.5, 452872.5]


def test_drop_expired_deletes_old_runs(spark, scratch):
    rows = [(dt.date(2026, 3, 1), "m", 1), (dt.date(2026, 3, 20), "m", 2), (dt.date(2026, 4, 2), "m", 3)]
    table = os.path.join(scratch, "history_v1")
    H.record_run(spark.createDataFrame(rows, "run_date date, metric string, n long"), table)
    assert H.drop_expired(spark, table, dt.date(2026, 4, 2)) == [dt.date(2026, 3, 1)]
    assert sorted(str(r["run_date"]) for r in H.read_history(spark, table).collect()) == ["2026-03-20", "2026-04-02"]
