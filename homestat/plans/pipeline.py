"""The weekly job end to end: landed files -> cleaned sources -> metrics ->
report sections, source health and run history.

    python -m homestat.plans.pipeline --weekly-dir … --value-index … --rent-index …
        --parcels … --sales … --out … --as-of 2026-04-02

Downloads, browser automation and e-mail are outside (files are expected to be
landed already). Every step is a Spark job; the only driver-side data are the
discovered file names and a few scalars.
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.plans import metrics as M
from homestat.plans import report as X
from homestat.sources import history as H
from homestat.sources import readers as R
from homestat.sources.health import source_health
from homestat.sources.versions import VersionStore


# The weekly inputs by discovered file.
WEEKLY_INPUTS = {"median_sale_price": "price", "homes_sold": "sold", "new_listings": "listings",
                 "days_to_close": "days_to_close", "weeks_of_supply": "supply", "avg_sale_to_list": "ratio"}


def weekly_sources(spark: SparkSession, weekly_dir: str, as_of: dt.datetime, *, region: str,
                   max_age_days: int = 7) -> tuple[dict, DataFrame]:
    """S5 + S2/S3: the newest fresh crosstab per metric -> the weekly inputs.

    The files count only as a complete set: with one missing there are no weekly sources.
    Returns (sources, path by metric)."""
    found = R.discover(R.list_files(spark, weekly_dir), as_of, max_age_days=max_age_days)
    rows = found.select("key", "path", "complete").collect()  # <= 6 file names
    paths = {r["key"]: r["path"] for r in rows if r["complete"]}
    return {WEEKLY_INPUTS[k]: R.read_weekly_detect(spark, p, region=region) for k, p in paths.items()}, paths


def report_sections(results: dict, health: DataFrame | None = None) -> dict[str, DataFrame]:
    """X1–X10 for whatever results are present."""
    builders = {"snapshot": ("market_snapshot", X.snapshot_cells), "prices": ("price_pressure", X.price_section),
                "inventory": ("inventory_absorption", X.inventory_section),
                "trend": ("trend_lines", X.trend_section), "buyer_value": ("buyer_value_index", X.buyer_value_section),
                "price_changes": ("zip_price_trends", X.price_change_section),
                "assessments": ("assessment_ratio", X.assessment_section),
                "flips": ("flip_detector", X.flip_section), "investors": ("investor_activity", X.investor_section)}
    out = {name: build(results[key]) for name, (key, build) in builders.items() if key in results}
    if health is not None:
        out["health"] = X.health_section(health)
    return out


def weekly_run(spark: SparkSession, *, out_dir: str, as_of: dt.datetime, weekly_dir: str | None = None,
               value_index: str | None = None, rent_index: str | None = None, parcels: str | None = None,
               sales: str | None = None, region: str = "ALL", state: str | None = None,
               region_name: str | None = None, city: str | None = None, zip_pattern: str = M.DEFAULT_ZIP_PATTERN,
               retention_days: int = 28, materialize: bool = True) -> dict:
    """Run every metric from the landed files and write tables, sections and history.

    What is not there is tolerated: a source that was expected (its path was given) and
    not found is reported FAILED in the health table, and its metrics are skipped. With
    `materialize` the cleaned tables and the metrics are written under `out_dir`, each as the
    partition of `region`, and read back, so that each is computed once; runs of other
    regions into the same folder leave it as it is, in the tables, sections and history. Runs older than `retention_days` leave the
    history. Returns {"results", "health", "rejected" (rows whose week did not parse, by
    source), "expired_runs" (their dates), "has_metrics"}."""
    run_date = as_of.date()

    def kept(df: DataFrame, name: str) -> DataFrame:
        """The table written as the region's partition, and read back."""
        if not materialize:
            return df
        R.write_partition(df, f"{out_dir}/{name}", {"region": region})
        own = df if "region" in df.columns else df.withColumn("region", F.lit(region))
        back = spark.read.schema(own.schema).parquet(f"{out_dir}/{name}").where(F.col("region") == region)
        return back.select(*df.columns)

    sources: dict = {}
    health_in: dict = {}
    rejected = None
    if weekly_dir:
        weekly, paths = weekly_sources(spark, weekly_dir, as_of, region=region)
        sources.update({k: kept(df, f"clean/{k}") for k, df in weekly.items()})
        for k in WEEKLY_INPUTS.values():
            health_in[f"weekly:{k}"] = (sources[k], "period_end") if k in sources else None
        bad = [R.rejected_weeks(spark, p).agg(F.count(F.lit(1)).alias("rejected")).select(F.lit(k).alias("source"), "rejected")
               for k, p in paths.items()]
        rejected = reduce(DataFrame.unionByName, bad) if bad else None
    for key, path in (("value_index", value_index), ("rent_index", rent_index)):
        if path:
            df = R.or_none(lambda path=path: R.read_index_wide(spark, path, state=state, region_name=region_name))
            if df is not None and region_name is not None:  # one selected region takes the run's region label
                df = df.withColumn("region", F.lit(region))
            if df is not None:
                sources[key.replace("_index", "_wide")] = df
            health_in[key] = None if df is None else (df, None)
    if parcels:
        raw = R.or_none(lambda: R.read_county(spark, parcels))
        if raw is not None:
            sources["parcels"] = kept(R.clean_parcels(raw, city=city), "clean/parcels")
        health_in["parcels"] = (sources["parcels"], None) if raw is not None else None
    if sales:
        raw = R.or_none(lambda: R.read_county(spark, sales))
        if raw is not None:
            sources["sales"] = kept(R.clean_sales(raw), "clean/sales")
        health_in["sales"] = (sources["sales"], "sale_date") if raw is not None else None
    results = M.run_metrics(sources, as_of=as_of, region=region, zip_pattern=zip_pattern, city=city or "")
    results = {k: kept(df, f"metrics/{k}") for k, df in results.items()}
    health = kept(source_health(health_in, as_of, spark=spark), "health") if health_in else None
    R.archive_sections(report_sections(results, health), f"{out_dir}/sections", run_date, region)
    H.record_run(H.run_counts(spark, results, run_date), f"{out_dir}/history", region)
    expired = H.drop_expired(spark, f"{out_dir}/history", run_date, days=retention_days)
    return {"results": results, "health": health, "rejected": rejected, "expired_runs": expired, "has_metrics": bool(results)}


# The tables of a published run that only its successors' readers need; sections and history stay.
RUN_TABLES = ("clean", "metrics", "health")


def run_store(spark: SparkSession, out_dir: str, region: str = "ALL") -> VersionStore:
    """The published runs of a region."""
    return VersionStore(spark, f"{out_dir}/{quote(region, safe=' ')}")


def published_run(spark: SparkSession, *, out_dir: str, as_of: dt.datetime, region: str = "ALL", retention_days: int = 28,
                  keep: int = 2, **given) -> dict:
    """:func:`weekly_run` that is seen whole or not at all.

    Everything is written into a version of its own and published by one marker at the end; a
    run that stops midway is not seen, and the next one deletes what it left. `run_store(…)`
    reads: `table("metrics/flip_detector")` of the newest run date, `archive("sections/prices")`
    and `archive("history")` over all dates (the last run of each). Tables of older runs go,
    but for the `keep` newest; their sections stay, and their history for `retention_days`.
    The result adds `version`.
    """
    store = run_store(spark, out_dir, region)
    name = store.begin()
    result = weekly_run(spark, out_dir=store.folder(name), as_of=as_of, region=region, retention_days=retention_days, **given)
    version = store.publish(name, as_of.date().isoformat())
    store.vacuum(RUN_TABLES, keep=keep)
    expired = [v for v in store.published() if (as_of.date() - dt.date.fromisoformat(v.label)).days > retention_days]
    for v in expired:
        store.remove(v.name, "history")
    return result | {"version": version, "expired_runs": sorted({dt.date.fromisoformat(v.label) for v in expired})}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="weekly housing-market run")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", required=True, help="YYYY-MM-DD")
    for opt in ("weekly-dir", "value-index", "rent-index", "parcels", "sales", "state", "region-name", "city"):
        ap.add_argument(f"--{opt}")
    ap.add_argument("--region", default="ALL")
    ap.add_argument("--publish", action="store_true", help="write a version of its own, seen whole or not at all")
    a = ap.parse_args(argv)
    from homestat.session import build_session
    spark = build_session()
    res = (published_run if a.publish else weekly_run)(
                     spark, out_dir=a.out, as_of=dt.datetime.fromisoformat(a.as_of), weekly_dir=a.weekly_dir,
                     value_index=a.value_index, rent_index=a.rent_index, parcels=a.parcels, sales=a.sales,
                     region=a.region, state=a.state, region_name=a.region_name, city=a.city)
    if not res["has_metrics"]:  # L16
        return 1
    return int(res["health"].where("degraded").limit(1).count() > 0)


if __name__ == "__main__":
    raise SystemExit(main())
