"""Region as a key: one run over all regions equals a run for each; runs share a folder; one joined base."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_pipeline import AS_OF, _land

from homestat.plans import metrics as M
from homestat.plans import proxies as P
from homestat.plans import regions as G
from homestat.plans.pipeline import weekly_run
from homestat.session import checkpoint_dir
from homestat.sources import history as H

SF = "/root/testdata/sf0.001"
ALONE = {"zip_price_trends": M.trailing_year_trend, "assessment_ratio": M.assessment_ratio,
         "buyer_value_index": M.buyer_value_index, "investor_activity": M.investor_activity}
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).select(*sorted(set(df.columns) - set(drop))).collect()))


@needs_data
def test_one_run_over_five_regions_equals_five_runs(spark):
    checkpoint_dir(spark)
    sources = {"sales": G.regional_sales(spark, SF).checkpoint(), "parcels": G.regional_parcels(spark, SF).drop("zip_pattern").checkpoint()}
    regions = G.region_table(spark, SF)
    options = dict(as_of=P.AS_OF, min_sale_price=-1e9, min_sales=2)
    together = M.run_metrics(sources, regions=regions, **options)
    together = {k: df.checkpoint() for k, df in together.items()}
    for r in regions.collect():
        own = {k: df.where(F.col("region") == r.region).drop("region") for k, df in sources.items()}
        own["parcels"] = own["parcels"].where(F.lit(r.city is None) | (F.col("loccity") == (r.city or "").strip().upper()))
        single = M.run_metrics(own, region=r.region, zip_pattern=r.zip_pattern, **options)
        assert set(single) == set(together)
        for name, df in single.items():
            mine = together[name].where(F.col("region") == r.region)
            if name == "flip_summary" and not mine.count():  # no flips: no row of the region, one that says so of a single run
                continue
            assert rows(df, "region") == rows(mine, "region"), (r.region, name)


@needs_data
def test_the_joined_base_gives_each_metric_and_reads_its_inputs_once(spark):
    sales, parcels = G.regional_sales(spark, SF), G.regional_parcels(spark, SF)
    bundle = M.zip_metrics(sales, parcels, as_of=P.AS_OF, by=G.BY, min_sales=2)
    for name, metric in ALONE.items():
        more = {"min_sales": 2} if name == "buyer_value_index" else {}
        assert rows(bundle[name]) == rows(metric(sales, parcels, as_of=P.AS_OF, by=G.BY, **more)), name
        assert "FileScan" not in bundle[name]._jdf.queryExecution().executedPlan().toString()  # the stored tables only
    base = M.sales_base(P.orders_sales(spark, SF), P.customer_parcels(spark, SF), as_of=P.AS_OF, zip_pattern=P.NUMERIC_ZIP)
    plan = base._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and "IS NOT NULL" not in plan.split("Join")[0]
    none = M.zip_metrics(sales, parcels.drop("homestead"), as_of=P.AS_OF, by=G.BY)["investor_activity"]
    assert none.count() == 0 and none.columns == ["region", "zip", "total_sales", "investor_share"]


def test_parcels_without_sales_and_repeated_accounts_in_the_base(spark):
    parcels = spark.createDataFrame([("A", "1", "34231", 10.0, 100.0, "X"), ("A", "1", "34231", 20.0, 300.0, None), ("A", None, "34231", 5.0, 500.0, None),
                                     ("B", "1", "34231", 10.0, 40.0, None), ("B", "2", "99999", 10.0, 1.0, None)],
                                    "region string, account_key string, zip string, living double, just double, homestead string")
    day = lambda n: P.AS_OF - dt.timedelta(days=n)
    sales = spark.createDataFrame([("A", "1", day(1), 50.0), ("A", "1", day(400), 30.0), ("A", "1", day(800), 9.0), ("B", "1", day(365), 80.0),
                                   ("B", "2", day(1), 7.0), ("A", None, day(1), 7.0)], "region string, account_key string, sale_date timestamp, sale_price double")
    out = M.zip_metrics(sales, parcels, as_of=P.AS_OF, by=G.BY, min_sales=1)
    assert [(r.region, r.price_now, r.sales_volume, r.price_prior) for r in out["zip_price_trends"].collect()] == [("A", 50.0, 2, 30.0)]
    assert {r.region: (r.median_sale_price, r.avg_assessed) for r in out["buyer_value_index"].collect()} == {"A": (50.0, 300.0), "B": (80.0, 40.0)}
    assert {r.region: (r.total_sales, r.investor_share) for r in out["investor_activity"].collect()} == {"A": (2, 0.5), "B": (1, 1.0)}
    assert {r.region: r.median_ratio for r in out["assessment_ratio"].collect()} == {"A": (50 / 100 + 50 / 300) / 2, "B": 2.0}


def test_a_region_whose_result_has_become_empty_is_emptied(spark, scratch):
    wk, out = _land(scratch), os.path.join(scratch, "out")
    given = dict(out_dir=out, as_of=AS_OF, weekly_dir=wk, parcels=os.path.join(scratch, "parcels.csv"), sales=os.path.join(scratch, "sales.csv"))
    assert weekly_run(spark, region="Gulf/Bay: 1", city="Bayside", **given)["results"]["assessment_ratio"].count() == 2
    again = weekly_run(spark, region="Gulf/Bay: 1", city="Nowhere", **given)
    assert again["results"]["assessment_ratio"].count() == 0
    assert spark.read.parquet(os.path.join(out, "metrics", "price_pressure")).first()["region"] == "Gulf/Bay: 1"


def test_runs_of_two_regions_share_a_folder(spark, scratch):
    wk, out = _land(scratch), os.path.join(scratch, "out")
    given = dict(out_dir=out, as_of=AS_OF, weekly_dir=wk, parcels=os.path.join(scratch, "parcels.csv"), sales=os.path.join(scratch, "sales.csv"))
    first = weekly_run(spark, region="Gulf", city="Bayside", **given)
    before = {k: rows(df) for k, df in first["results"].items()}
    weekly_run(spark, region="Bay", city="Nowhere", **given)
    for k, df in before.items():
        stored = spark.read.schema(first["results"][k].withColumn("region", F.lit("")).schema).parquet(os.path.join(out, "metrics", k))
        assert rows(stored.where("region = 'Gulf'").select(*first["results"][k].columns)) == df, k
    for name in ("clean/parcels", "clean/sales", "clean/price", "health", "sections/flips"):
        regions = {r.region for r in spark.read.parquet(os.path.join(out, name)).select("region").distinct().collect()}
        assert regions == ({"Gulf"} if name == "clean/parcels" else {"Gulf", "Bay"}), name
    history = H.read_history(spark, os.path.join(out, "history"))
    counts = {(r.region, r.metric): r.n for r in H.latest_run(history).collect()}
    assert len(counts) == 20 and counts["Gulf", "assessment_ratio"] == 2 and counts["Bay", "assessment_ratio"] == 0
    assert H.has_metrics(history.where("n = 0")).first()[0] is False and H.has_metrics(history).first()[0] is True
