"""Metrics from changes, published runs, streamed files, address matching."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from homestat.functions.scalars import normalize_address
from homestat.operators import aggregates, splits
from homestat.operators.matching import match_parcels, match_rates
from homestat.plans import metrics as M
from homestat.plans import pipeline
from homestat.plans.incremental import CHANGE, ZipState, row_changes
from homestat.sources.versions import VersionStore
from homestat.streaming.landing import start_mixed_ingest
from test_pipeline import AS_OF, _land

PARCELS = "region string, account_key string, zip string, living double, just double, homestead string"
SALES = "region string, account_key string, sale_date timestamp, sale_price double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------ state

@pytest.mark.parametrize("hot", [1_000_000, 20])
def test_weighted_medians_are_those_of_the_repeated_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(splits, "HOT_ROWS", hot)
    rng = random.Random(1)
    counted = [(rng.choice("ab"), rng.choice([None, float("nan"), -1.5, 0.0, 2.0, 1e9, rng.random()]), rng.randint(1, 9)) for _ in range(200)]
    df = spark.createDataFrame(counted, "g string, v double, n long")
    plain = spark.createDataFrame([(g, v) for g, v, n in counted for _ in range(n)], "g string, v double")
    for by in (["g"], []):
        mine = aggregates.group_medians(df, by, {"m": F.col("v")}, {"n_rows": F.sum("n")}, weight="n")
        assert str(rows(mine)) == str(rows(plain.groupBy(*by).agg(F.median("v").alias("m"), F.count(F.lit(1)).alias("n_rows"))))


def _random_tables(seed):
    rng = random.Random(seed)
    parcels = [(rng.choice("AB"), rng.choice([None, *"123456789"]), rng.choice(["34201", "34202-1", "99999", None]), rng.choice([None, 0.0, 9.0]),
                rng.choice([None, -1.0, 0.0, 100.0, 250.5]), rng.choice([None, "X", " X ", "N"])) for _ in range(30)]
    sales = [(rng.choice("AB"), rng.choice([None, *"123456789"]), AS_OF - dt.timedelta(days=rng.choice([0, 1, 364, 365, 366, 729, 730, 731, 900, -3]), hours=-rng.randint(0, 23)),
              rng.choice([None, 10.0, 20.0, rng.randint(1, 99) * 1.25])) for _ in range(120)]
    return parcels, sales


def _full(spark, parcels, sales):
    p, s = spark.createDataFrame(parcels, PARCELS), spark.createDataFrame(sales, SALES)
    return {k: rows(df) for k, df in M.zip_metrics(s, p, as_of=AS_OF, by=["region"], min_sales=2, scale=2).items()}


def test_changes_alone_give_the_full_run(spark, scratch):
    parcels, sales = _random_tables(3)
    fewer, wrong = sales[:70], [(r, a, d, None if p is None else p + 1) for r, a, d, p in sales[:10]]
    make = lambda data, schema=SALES: spark.createDataFrame(data, schema)
    state = ZipState(spark, os.path.join(scratch, "state"), by="region")
    before_p = make([(r, a, z, liv, j if i % 3 else 77.0, h) for i, (r, a, z, liv, j, h) in enumerate(parcels[:25])], PARCELS)
    first = make(wrong + fewer[10:] + [("A", "1", AS_OF, 5e6)])  # wrong prices, and a sale that never was
    state.apply(dt.date(2026, 3, 5), before_p, first)
    state.apply(dt.date(2026, 3, 12), before_p)  # nothing new
    state.apply(dt.date(2026, 3, 19), before_p, row_changes(first, make(fewer)))  # corrected and withdrawn
    after_p = make(parcels, PARCELS)
    # one run with late sales and changed parcels: the stored sales are those before the run
    state.apply(dt.date(2026, 3, 26), after_p, make(sales[70:]), parcel_changes=row_changes(before_p, after_p), sales=make(fewer))
    want = _full(spark, parcels, sales)
    assert {k: rows(df) for k, df in state.metrics(AS_OF, min_sales=2).items()} == want
    assert sum(map(len, want.values())) > 8
    assert len(state.latest().parts) == 4
    state.compact(AS_OF)
    assert len(state.latest().parts) == 1 and os.listdir(os.path.join(scratch, "state", "versions")) == [state.latest().name]
    assert {k: rows(df) for k, df in state.metrics(AS_OF, min_sales=2).items()} == want
    state.apply(dt.date(2026, 4, 2), after_p, make(sales[:5]).withColumn(CHANGE, F.lit(-1).cast("bigint")))
    assert {k: rows(df) for k, df in state.metrics(AS_OF, min_sales=2).items()} == _full(spark, parcels, sales[5:])


def test_a_run_that_fails_leaves_the_state(spark, scratch):
    parcels, sales = (spark.createDataFrame(d, s) for d, s in zip(_random_tables(4), (PARCELS, SALES), strict=True))
    state = ZipState(spark, os.path.join(scratch, "state"), by="region")
    state.apply(dt.date(2026, 3, 5), parcels, sales)
    before = rows(state.statistics(AS_OF))
    with pytest.raises(Exception, match="zero"):
        state.apply(dt.date(2026, 3, 12), parcels, sales.withColumn("sale_price", F.expr("1 / cast(second(sale_date) as int)")))
    assert rows(state.statistics(AS_OF)) == before and len(state.store.published()) == 1
    with pytest.raises(ValueError, match="need the sales"):
        state.apply(dt.date(2026, 3, 12), parcels, parcel_changes=parcels)
    with pytest.raises(ValueError, match="midnight"):
        state.statistics(AS_OF + dt.timedelta(hours=1))


def test_an_empty_state_gives_empty_metrics(spark, scratch):
    state = ZipState(spark, os.path.join(scratch, "state"), by="region")
    state.apply(dt.date(2026, 3, 5), spark.createDataFrame([], PARCELS), spark.createDataFrame([], SALES))
    assert {k: df.count() for k, df in state.metrics(AS_OF).items()} == dict.fromkeys(
        ["zip_price_trends", "assessment_ratio", "buyer_value_index", "investor_activity"], 0)


def test_row_changes_count_repeated_rows(spark):
    t = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    assert rows(row_changes(t(1, 1, 2, None), t(1, 2, 2, 3))) == [(1, -1), (2, 1), (3, 1), (None, -1)]
    assert rows(row_changes(None, t(1, 1))) == [(1, 2)] and rows(row_changes(t(1, 2), t(2, 1))) == []


# ------------------------------------------------------------------ published runs

def test_versions_are_seen_when_published(spark, scratch):
    store = VersionStore(spark, os.path.join(scratch, "runs"))
    assert store.current() is None and store.published() == []
    with pytest.raises(FileNotFoundError):
        store.table("t")
    def write(name, n):
        spark.range(n).write.parquet(f"{store.folder(name)}/t")
    a = store.begin()
    write(a, 3)
    with pytest.raises(FileNotFoundError):
        store.table("t")
    store.publish(a, "2026-01-08")
    stopped, late, rerun = store.begin(), store.begin(), store.begin()
    write(stopped, 9)
    write(late, 5)
    write(rerun, 4)
    store.publish(late, "2026-01-01")  # a run of an earlier date
    assert store.table("t").count() == 3 and store.archive("t").count() == 8
    store.publish(rerun, "2026-01-08")
    assert store.table("t").count() == 4 and store.archive("t").count() == 9
    with pytest.raises(RuntimeError, match="another run"):
        store.publish(stopped, "2026-01-15")
    assert store.vacuum(("t",), keep=1) == [stopped]
    assert store.table("t").count() == 4 and not os.path.exists(store.folder(stopped)) and not os.path.exists(store.folder(a) + "/t")


def test_a_weekly_run_that_stops_midway_is_not_seen(spark, scratch, monkeypatch):
    wk, out = _land(scratch), os.path.join(scratch, "out")
    given = dict(out_dir=out, region="Gulf/Bay", parcels=os.path.join(scratch, "parcels.csv"), sales=os.path.join(scratch, "sales.csv"))
    first = pipeline.published_run(spark, as_of=AS_OF, weekly_dir=wk, city="Bayside", **given)
    store = pipeline.run_store(spark, out, "Gulf/Bay")
    seen = lambda: {t: rows(store.table(t)) for t in ("metrics/flip_detector", "metrics/price_pressure", "clean/sales", "health")} | {
        t: rows(store.archive(t)) for t in ("history", "sections/prices")}
    before = seen()
    assert first["has_metrics"] and len(before["metrics/flip_detector"]) == 2 and len(before["history"]) == 10

    def stop(*args, **kwargs):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(pipeline, "report_sections", stop)  # tables and metrics are written by then
        with pytest.raises(KeyboardInterrupt):
            pipeline.published_run(spark, as_of=AS_OF + dt.timedelta(days=7), **given)
    assert seen() == before
    left = sorted(os.listdir(os.path.join(store.root, "versions")))
    later = pipeline.published_run(spark, as_of=AS_OF + dt.timedelta(days=29), **given)
    assert later["expired_runs"] == [AS_OF.date()]
    assert {str(r[0]) for r in store.archive("history").select("run_date").collect()} == {"2026-05-01"}
    assert rows(store.archive("sections/prices")) == before["sections/prices"]
    assert left[1] not in os.listdir(os.path.join(store.root, "versions"))  # what the stopped run left is gone


# ------------------------------------------------------------------ streamed files

def test_files_of_any_encoding_are_taken_once(spark, scratch):
    land, clean, bad, ck = (os.path.join(scratch, x) for x in ("land", "clean", "bad", "ck"))
    os.makedirs(land)
    def arrive(name, text, encoding):
        with open(os.path.join(land, name), "wb") as f:
            f.write(text.encode(encoding))
        start_mixed_ingest(spark, land, clean, bad, ck, region="R").awaitTermination()
    arrive("a.csv", 'Period End\tMedian Sale Price\tMedian Sale Price Yoy\r\n1/18/2026\t"416,875"\t0.01\r\n\r\nTotal\t1\t2\r\n', "utf-16")
    arrive("b.csv", 'Note,Median Sale Price,Period End\n"a, ""b""","1,000",1/25/2026\n', "utf-8-sig")
    arrive("c.csv", "Period End,Adjusted Average Homes Sold\n2/1/2026\n2/8/2026,7", "utf-16-be")  # no mark: unreadable as UTF-8
    arrive("d.csv", "Period End,Adjusted Average Homes Sold\n2/1/2026\n2/8/2026,7", "utf-8")  # a short line, no end of line
    arrive("e.csv", "", "utf-8")
    got = spark.read.parquet(clean).select("source_file", F.col("period_end").cast("string"), "median_price", "price_yoy", "homes_sold")
    assert rows(got) == [("a.csv", "2026-01-18", 416875.0, 0.01, None), ("b.csv", "2026-01-25", 1000.0, None, None),
                         ("d.csv", "2026-02-01", None, None, None), ("d.csv", "2026-02-08", None, None, 7.0)]
    rejected = spark.read.parquet(bad)
    assert rows(rejected.where("source_file = 'a.csv'").select("region", "line")) == [("R", "Total\t1\t2")]
    assert {r.source_file for r in rejected.collect()} <= {"a.csv", "c.csv"}
    start_mixed_ingest(spark, land, clean, bad, ck, region="R").awaitTermination()  # nothing new
    assert spark.read.parquet(clean).count() == 4


# ------------------------------------------------------------------ address matching

def _edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


@pytest.mark.parametrize("max_edits", [0, 1, 2, 3])
def test_near_addresses_are_those_of_all_pairs(spark, max_edits):
    rng = random.Random(max_edits)
    def text():
        return rng.choice(["1 ", "12 ", "12", " 12 ", ""]) + "".join(rng.choice("ab ") for _ in range(rng.randint(0, 7))) + rng.choice(["", " #4", " Street", "2"])
    parcels = [(rng.choice("AB"), rng.choice([None, *range(60)]), rng.choice(["1", "2", None]), rng.choice([None, text(), text()])) for _ in range(60)]
    records = [(i, rng.choice("AB"), rng.choice([None, None, *range(0, 200, 7)]), rng.choice(["1", "2", None]), rng.choice([None, text(), text(), text()]))
               for i in range(150)]
    p = spark.createDataFrame(parcels, "region string, account_key int, zip string, address string")
    r = spark.createDataFrame(records, "id int, region string, account_key int, zip string, address string")
    normal = lambda df: [tuple(x) for x in df.withColumn("address", normalize_address("address")).collect()]
    digits = lambda a: "".join(c if c.isdigit() else " " for c in a).split()
    ps, want = normal(p), []
    for i, region, key, z, a in normal(r):
        same = [k for g, k, y, b in ps if g == region and k is not None and y == z and z is not None and a and a == b]
        near = [(e, k) for g, k, y, b in ps if g == region and k is not None and y == z and z is not None and a and b and digits(a) == digits(b)
                for e in [_edits(a, b)] if e <= max_edits]
        if key is not None and any(g == region and k == key for g, k, _, _ in ps):
            want.append((i, "account", key, 0))
        elif same:
            want.append((i, "address", min(same), 0))
        else:
            want.append((i, "near", min(near)[1], min(near)[0]) if near else (i, "none", None, None))
    out = match_parcels(r, p, by="region", max_edits=max_edits)
    got = sorted(tuple(x) for x in out.select("id", "match_kind", "match_key", "match_edits").collect())
    assert got == sorted(want)
    assert {k for _, k, _, _ in want} >= {"account", "address", "none"} | ({"near"} if max_edits else set())
    rates = {x.match_kind: (x.n, x.share) for x in match_rates(out).collect()}
    assert {k: n for k, (n, _) in rates.items()} == {k: sum(w[1] == k for w in want) for k in ("account", "address", "near", "none")}
    assert abs(sum(s for _, s in rates.values()) - 1) < 1e-9


def test_matching_plans_no_cross_join(spark):
    t = spark.createDataFrame([(1, "1", "12 Oak St")], "account_key int, zip string, address string")
    plan = match_parcels(t, t)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
