"""The zip metrics (M6, M7, M8, M10) kept up to date from changes alone.

The state is the joined base of sales and parcels with its rows counted: so many equal
sales of one zip, day, price and assessed value, so many equal parcels of one zip and
assessed value. Counts add up, so a run writes only what it adds and takes away: a new
sale counts +1, a withdrawn one -1, a corrected one both; a changed parcel takes its
sales' old rows away and adds them anew. The metrics of any day are then those of the
full run, whatever order the changes came in.

Each run's part is a version (`homestat.sources.versions`), ordered by the day of sale: a
run that stops midway leaves the state as it was, and a scan skips the row groups before
the two years that the metrics need.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.functions.scalars import strip_ws
from homestat.operators.aggregates import group_medians
from homestat.plans import metrics as M
from homestat.sources.versions import Version, VersionStore

CHANGE = "change"  # +1 for a row that is new, -1 for one that is no more


def _as_list(x) -> list:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


def row_changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """What turns one extract into the next: different rows with a `change`, the number of times
    each is there more (or less) often. Equal rows cancel; one aggregation, no join."""
    rows = after.withColumn(CHANGE, F.lit(1).cast("bigint"))
    if before is not None:
        rows = rows.unionByName(before.select(*after.columns).withColumn(CHANGE, F.lit(-1).cast("bigint")))
    return rows.groupBy(*[F.col(f"`{c}`") for c in after.columns]).agg(F.sum(CHANGE).alias(CHANGE)).where(F.col(CHANGE) != 0)


class ZipState:
    """The stored state of the zip metrics under `root`, keyed by `by` and zip.

    Sales need `account_key`, `sale_date` and `sale_price`, parcels `account_key`, `zip`,
    `living`, `just` and, optionally, `homestead` and `zip_pattern` (see
    `homestat.plans.metrics`), both the columns `by`. Null account keys match nothing.
    """

    def __init__(self, spark: SparkSession, root: str, *, by=(), zip_pattern: str = M.DEFAULT_ZIP_PATTERN):
        self.spark, self.by, self.zip_pattern = spark, _as_list(by), zip_pattern
        self.store = VersionStore(spark, root)

    def latest(self) -> Version | None:
        done = self.store.published()
        return done[-1] if done else None

    # ------------------------------------------------------------ changes

    def _homes(self, parcels: DataFrame) -> DataFrame:
        """Parcels of the zips that count, as the state sees them."""
        cols = ["living", "just", *([c for c in ("homestead", CHANGE) if c in parcels.columns])]
        p = M._zip_parcels(parcels, self.zip_pattern, *cols, by=self.by)
        mark = F.col("homestead") if "homestead" in parcels.columns else F.lit(None).cast("string")
        valued = F.coalesce(F.col("just") > 0, F.lit(False))
        return p.select(*self.by, "account_key", "zip", F.coalesce(F.col("living") > 0, F.lit(False)).alias("home"),
                        F.when(valued, F.col("just")).cast("double").alias("just"),
                        F.coalesce(strip_ws(mark) != F.lit("X"), F.lit(True)).alias("investor"),
                        F.col(CHANGE).cast("bigint").alias("_p") if CHANGE in parcels.columns else F.lit(1).cast("bigint").alias("_p"))

    def _sold(self, sales: DataFrame) -> DataFrame:
        change = F.col(CHANGE).cast("bigint") if CHANGE in sales.columns else F.lit(1).cast("bigint")
        return sales.select(*self.by, "account_key", F.to_date("sale_date").alias("day"), F.col("sale_price").cast("double").alias("price"),
                            change.alias("_s")).where(F.col("account_key").isNotNull() & F.col("day").isNotNull())

    def _counted(self, sales: DataFrame, homes: DataFrame) -> DataFrame:
        j = sales.join(homes, [*self.by, "account_key"])
        return j.select(*self.by, "zip", "day", "home", "investor", "price", "just", (F.col("_s") * F.col("_p")).alias("n"))

    def _sum(self, rows: DataFrame) -> DataFrame:
        keys = [c for c in rows.columns if c != "n"]
        return rows.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") != 0)

    def apply(self, run_date: dt.date, parcels: DataFrame, sale_changes: DataFrame | None = None, *,
              parcel_changes: DataFrame | None = None, sales: DataFrame | None = None) -> Version:
        """Add a run's changes and publish the state.

        `sale_changes` are rows of sales with a `change` (without that column all are new),
        `parcels` the parcels as they are after the run. `parcel_changes` are rows of parcels
        with a `change`; they need `sales`, the sales as they were before the run, of which
        only those of changed accounts are joined. Without them the stored sales are not read.
        """
        if parcel_changes is not None and sales is None and self.latest() is not None:
            raise ValueError("changed parcels need the sales that the state was made of")
        parts = []
        if sale_changes is not None:
            parts.append(self._counted(self._sold(sale_changes), self._homes(parcels)))
        if parcel_changes is not None and sales is not None:
            parts.append(self._counted(self._sold(sales), self._homes(parcel_changes)))
        before, name = self.latest(), self.store.begin()
        for part in parts[1:]:
            parts[0] = parts[0].unionByName(part)
        if parts:
            self._write(self._sum(parts[0]), name)
        if parcel_changes is not None:
            self._write_assessments(self._homes(parcel_changes), name)
        elif before is None:
            self._write_assessments(self._homes(parcels), name)
        return self.store.publish(name, run_date.isoformat(), (*(before.parts if before else ()), name))

    def _write(self, rows: DataFrame, name: str) -> None:
        ordered = rows.repartitionByRange("day", "price").sortWithinPartitions("day")
        ordered.write.parquet(f"{self.store.folder(name)}/sales")

    def _write_assessments(self, homes: DataFrame, name: str) -> None:
        valued = homes.where(F.col("home") & F.col("just").isNotNull())
        self._sum(valued.select(*self.by, "zip", "just", F.col("_p").alias("n"))).write.parquet(f"{self.store.folder(name)}/parcels")

    def compact(self, as_of: dt.datetime, *, drop: bool = True) -> Version:
        """One part in place of all, without the days that no metric from `as_of` on reads.

        Readers that began before may still read the old parts, unless `drop`, which deletes them."""
        before = self.latest()
        name = self.store.begin()
        self._write(self._sum(self._sales(as_of)), name)
        self._sum(self._table("parcels")).write.parquet(f"{self.store.folder(name)}/parcels")
        out = self.store.publish(name, before.label, (name,))
        for part in before.parts if drop else ():
            self.store.remove(part)
        return out

    # ------------------------------------------------------------ results

    def _table(self, table: str) -> DataFrame:
        return self.store.table(table, self.latest())

    def _sales(self, as_of: dt.datetime) -> DataFrame:
        """The counted sales of the two years before `as_of` and later, before equal rows are added up."""
        oldest = (as_of - dt.timedelta(days=730)).date()
        return self._table("sales").where(F.col("day") >= F.lit(oldest.isoformat()).cast("date"))

    def statistics(self, as_of: dt.datetime) -> DataFrame:
        """What :func:`homestat.plans.metrics.zip_statistics` gives, of the state. `as_of` is a midnight, as everywhere."""
        if as_of.time() != dt.time():
            raise ValueError("as_of must be a midnight: the state counts sales by day")
        year = F.lit((as_of - dt.timedelta(days=365)).date().isoformat()).cast("date")
        rows = self._sum(self._sales(as_of))
        now, home, valued = F.col("day") >= year, F.col("home"), F.col("just").isNotNull()
        price = F.col("price")
        of = {"trend_now": now & home, "trend_prior": ~now & home, "ratio": now & valued, "value": now & home & valued}
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0).cast("bigint"))
        medians = {f"med_{k}": F.when(c, price / F.col("just") if k == "ratio" else price) for k, c in of.items()}
        counts: dict[str, Column] = {f"has_{k}": total(c) for k, c in of.items()}
        counts |= {f"n_{k}": total(c & price.isNotNull()) for k, c in of.items()}
        counts |= {"n_sales": total(now), "n_investors": total(now & F.col("investor"))}
        return group_medians(rows, [*self.by, "zip"], medians, counts, weight="n")

    def assessments(self, scale: int = 2) -> DataFrame:
        """Mean assessed value of each zip's residential parcels, summed in whole units of 10 ** -scale."""
        units = F.round(F.col("just") * F.lit(float(10 ** scale))).cast("bigint")
        sums = self._table("parcels").groupBy(*self.by, "zip").agg(F.sum("n").alias("_n"), F.sum(units * F.col("n")).alias("_u"))
        mean = F.col("_u").cast("double") / (F.col("_n").cast("double") * F.lit(float(10 ** scale)))
        return sums.where(F.col("_n") > 0).select(*self.by, "zip", mean.alias("avg_assessed"))

    def metrics(self, as_of: dt.datetime, *, low_volume_limit: int = 20, yoy_limit: float = 0.40, min_sales: int = 20,
                scale: int = 2, median_decimals: int | None = None) -> dict[str, DataFrame]:
        """M6, M7, M8 and M10 as :func:`homestat.plans.metrics.zip_metrics` gives them, of the state."""
        stats, by = self.statistics(as_of), self.by
        return {"zip_price_trends": M.trend_of(stats, by=by, low_volume_limit=low_volume_limit, yoy_limit=yoy_limit, median_decimals=median_decimals),
                "assessment_ratio": M.ratio_of(stats, by=by, median_decimals=median_decimals),
                "buyer_value_index": M.value_of(stats, self.assessments(scale), by=by, min_sales=min_sales, median_decimals=median_decimals),
                "investor_activity": M.investors_of(stats, by=by)}
