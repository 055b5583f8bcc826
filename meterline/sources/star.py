"""Adapters: driver tables -> the usage/cost star schema.

``applications``: one row per supplier (the monitored application).
``usage_fact``: lineitem x part aggregated to (day, app, capability, tier).
``event_usage``: the events table seen as daily-ish usage (forecast input).
All rules are plain column expressions, so they run inside whole-stage
codegen and the same definitions can be written in portable SQL.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.functions.timeutil import add_months, as_date, month_start, since, ts_lit
from meterline.session import cut_lineage
from meterline.sources import seeds
from meterline.sources.tables import read

# --- fixed values: as_of dates for the driver data --------------------------
LINEITEM_AS_OF = dt.date(2001, 11, 5)
EVENTS_AS_OF = dt.date(2024, 1, 31)
# capability of an event type: position in this list (1-based)
EVENT_CAPABILITY_ORDER = ("click", "error", "purchase", "signup", "view")
# ---------------------------------------------------------------------------


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("s_suppkey")
    monitored = (k % 10) != 9
    in_cmdb = ~(k % 10).isin(7, 8)
    hcode_class = k % 8
    app_name = F.when(monitored, F.col("s_name"))
    return (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
             .join(r, n.n_regionkey == r.r_regionkey, "inner")
             .select(
                 (k + 1).alias("app_id"),
                 F.when(monitored, F.concat(F.lit("m-"), k.cast("string"))).alias("monitoring_id"),
                 app_name.alias("app_name"),
                 F.when((k % 17) != 0, F.col("r_name")).alias("controller"),
                 F.when(in_cmdb, F.concat(F.lit("c-"), k.cast("string"))).alias("cmdb_id"),
                 F.when(in_cmdb, F.col("s_name")).alias("cmdb_name"),
                 F.when(hcode_class == 0, F.lit("H-PLATFORM"))
                  .when(hcode_class == 1, F.lit("H-GLOBAL_IT"))
                  .when(hcode_class == 2, F.lit("H-SHARED_SVC"))
                  .when(hcode_class == 3, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("H"), F.col("n_nationkey").cast("string")))
                  .alias("h_code"),
                 F.when((k % 11) != 0, (F.col("n_nationkey") % 7 + 1).cast("int")).alias("sector_id"),
                 F.when((k % 13) != 0, (k % 3 + 1).cast("int")).alias("owner_id"),
                 (k % 5 + 1).cast("int").alias("architecture_id"),
                 rules.license_tier(app_name, F.lit(None).cast("string")).alias("license_tier"),
                 F.when(in_cmdb, F.col("n_name")).alias("support_group"),
             ))


# first ids of the rows that the reconciliation's dimension has besides the applications
RECORD_IDS, COPY_IDS, STALE_IDS = 1_000_000_000, 2_000_000_000, 3_000_000_000


def recon_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application dimension before reconciliation: applications, and what else the feeds know of them.

    Besides ``applications``: a CMDB-only record, its name in another case or with blanks around it, of
    each supplier that the dimension has unlinked; a second, unlinked monitored copy of every fourth
    supplier; and a stale CMDB-only row of some whose CMDB id an application holds already.
    """
    app = applications(spark, sf_dir)
    s = read(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).alias("app_id"), F.col("s_suppkey").alias("k"), "s_name")
    own = app.join(s, "app_id")
    k, null = F.col("k"), F.lit(None).cast("string")
    unlinked = own.where((k % 10).isin(7, 8)).withColumns({
        "app_id": k + RECORD_IDS, "cmdb_id": F.concat(F.lit("d-"), k.cast("string")),
        "cmdb_name": F.when(k % 10 == 7, F.upper("s_name")).otherwise(F.concat(F.lit(" "), F.lower("s_name"), F.lit("  "))),
        "monitoring_id": null, "app_name": null, "controller": null, "h_code": F.concat(F.lit("HD"), k.cast("string")),
        "owner_id": (k % 2 + 1).cast("int"), "architecture_id": F.lit(1), "support_group": F.lit("CMDB")})
    copies = own.where((k % 4 == 0) & F.col("app_name").isNotNull()).withColumns({
        "app_id": k + COPY_IDS, "monitoring_id": F.concat(F.lit("m2-"), k.cast("string")), "cmdb_id": null, "cmdb_name": null,
        "support_group": null})
    stale = own.where(k % 10 == 6).withColumns({
        "app_id": k + STALE_IDS, "monitoring_id": null, "app_name": null, "controller": null, "h_code": null})
    out = app
    for more in (unlinked, copies, stale):
        out = out.unionAll(more.select(*app.columns))
    return out


def recon_cost(cost: DataFrame) -> DataFrame:
    """The cost fact while the CMDB-only records are apart: their applications' second capability is posted to both."""
    k = F.col("app_id") - 1
    return cost.unionAll(cost.where((k % 10).isin(7, 8) & (F.col("capability_id") == 2)).withColumn("app_id", k + RECORD_IDS))


def usage_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, app_id, capability_id, tier) -> units_consumed, nodes_count."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    tier = (F.when(F.col("l_returnflag") == "A", F.lit("Peak"))
             .when(F.col("l_returnflag") == "R", F.lit("Pro")))
    return (li.join(p, li.l_partkey == p.p_partkey, "inner")
              .groupBy(F.col("l_shipdate").alias("ts"),
                       (F.col("l_suppkey") + 1).alias("app_id"),
                       (F.col("p_size") % 5 + 1).cast("int").alias("capability_id"),
                       tier.alias("tier"))
              .agg(F.sum(F.col("l_quantity").cast("decimal(12,2)"))
                    .cast("decimal(12,2)").alias("units_consumed"),
                   F.count(F.lit(1)).cast("int").alias("nodes_count")))


def account_count(spark: SparkSession, sf_dir: str):
    """Apps that the events belong to, a tenth of all (10 at least), as a scalar subquery: they grow with the data."""
    s = read(spark, sf_dir, "supplier")
    return s.agg(F.greatest(F.lit(10), F.floor(F.count(F.lit(1)) / 10)).alias("n")).scalar()


def event_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> usage rows (ts keeps its time of day)."""
    ev = read(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    cap = F.array_position(F.array(*[F.lit(x) for x in EVENT_CAPABILITY_ORDER]),
                           F.col("event_type")).cast("int")
    return ev.select(
        "ts",
        (F.col("user_id") % account_count(spark, sf_dir) + 1).alias("app_id"),
        F.when(cap > 0, cap).alias("capability_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("Peak")).otherwise(F.lit("Pro")).alias("tier"),
        F.col("value").cast("decimal(12,2)").alias("units_consumed"),
        F.lit(1).alias("nodes_count"),
    )


@dataclass
class Star:
    """The star schema of one data directory, built lazily."""

    spark: SparkSession
    sf_dir: str
    as_of: dt.date = LINEITEM_AS_OF
    source: str = "lineitem"   # or "events": the events table as usage (forecast input)

    @classmethod
    def events(cls, spark: SparkSession, sf_dir: str, as_of: dt.date = EVENTS_AS_OF) -> "Star":
        return cls(spark, sf_dir, as_of, "events")

    @cached_property
    def app(self) -> DataFrame:
        return applications(self.spark, self.sf_dir)

    @cached_property
    def usage(self) -> DataFrame:
        if self.source == "events":
            return event_usage(self.spark, self.sf_dir)
        return usage_fact(self.spark, self.sf_dir)

    @cached_property
    def forecast(self) -> DataFrame:
        from meterline.operators.forecast import ensemble_forecast
        return ensemble_forecast(self.usage, self.price, self.as_of)

    @cached_property
    def price(self) -> DataFrame:
        return seeds.prices(self.spark)

    @cached_property
    def cost(self) -> DataFrame:
        from meterline.operators.cost import calculate_costs
        return calculate_costs(self.usage, self.price)

    @cached_property
    def chargeback(self) -> DataFrame:
        from meterline.operators.chargeback import direct_chargeback
        return direct_chargeback(self.cost, self.app)

    @cached_property
    def sectors(self) -> DataFrame:
        return seeds.sectors(self.spark)

    @cached_property
    def owners(self) -> DataFrame:
        return seeds.owners(self.spark)

    @cached_property
    def architectures(self) -> DataFrame:
        return seeds.architectures(self.spark)

    @cached_property
    def capabilities(self) -> DataFrame:
        return seeds.capabilities(self.spark)

    @cached_property
    def event_usage(self) -> DataFrame:
        return event_usage(self.spark, self.sf_dir)

    @cached_property
    def chargeback_all(self) -> DataFrame:
        """Direct chargeback plus posted shared-cost allocations."""
        from meterline.operators.allocation import allocate_shared_costs
        alloc = allocate_shared_costs(self.cost, self.usage, self.app, self.sectors,
                                      seeds.allocation_rules(self.spark), months=None)
        return self.chargeback.unionByName(alloc)

    # reporting views (V1-V8) at this star's as_of
    @cached_property
    def v1(self):
        from meterline.operators import views as V
        return V.v1_daily_cost_by_controller(self.cost, self.app, self.as_of)

    @cached_property
    def v2(self):
        from meterline.operators import views as V
        return V.v2_daily_usage_by_capability(self.usage, self.app, self.capabilities, self.as_of)

    @cached_property
    def v3(self):
        from meterline.operators import views as V
        return V.v3_cost_by_sector_controller(self.cost, self.app, self.sectors, self.as_of)

    @cached_property
    def v4(self):
        from meterline.operators import views as V
        return V.v4_cost_by_owner_controller(self.cost, self.app, self.owners, self.as_of)

    @cached_property
    def v5(self):
        from meterline.operators import views as V
        return V.v5_architecture_metrics(self.usage, self.cost, self.app, self.architectures,
                                         self.capabilities, self.as_of)

    @cached_property
    def v6(self):
        from meterline.operators import views as V
        return V.v6_app_cost_rankings_monthly(self.cost, self.app, self.sectors, self.owners, self.as_of)

    @cached_property
    def v7(self):
        from meterline.operators import views as V
        months = 24
        return V.v7_monthly_chargeback_summary(self.chargeback_from(month_start(add_months(as_date(self.as_of), -months))),
                                               self.app, self.sectors, self.as_of, months)

    def chargeback_from(self, month, until=None) -> DataFrame:
        """Direct chargeback of the months from ``month`` to before ``until`` (first days); the bounds reach
        the fact scan as ``ts`` literals."""
        from meterline.operators.chargeback import direct_chargeback
        return direct_chargeback(self._between(self.cost, month, until), self.app)

    def chargeback_all_from(self, month, until=None) -> DataFrame:
        """``chargeback_all`` of those months, from one reading of the facts."""
        from meterline.operators.allocation import allocate_shared_costs
        from meterline.operators.chargeback import direct_chargeback
        sums = self.monthly(month, until)
        cost = sums.where(F.col("usd_cost").isNotNull())
        alloc = allocate_shared_costs(cost, sums, self.app, self.sectors, seeds.allocation_rules(self.spark))
        return direct_chargeback(cost, self.app).unionByName(alloc)

    def monthly(self, month, until=None) -> DataFrame:
        """(ts, app_id, units_consumed, usd_cost): sums by month (ts is its first day) and application, kept.

        What is posted by the month needs no more than these sums; they are written once to the shared
        checkpoint folder, so that the reports below read the facts once.
        """
        from meterline.operators.cost import priced_usage
        rows = priced_usage(self._between(self.usage, month, until), self.price)
        return cut_lineage(rows.groupBy(F.trunc("ts", "MM").alias("m"), "app_id")
                               .agg(F.sum("units_consumed").alias("units_consumed"), F.sum("usd_cost").alias("usd_cost"))
                               .select(F.col("m").cast("timestamp_ntz").alias("ts"), "app_id", "units_consumed", "usd_cost"))

    def recent_chargeback(self) -> tuple[DataFrame, DataFrame]:
        """(monthly costs, direct chargeback) of the V7 window (24 months), from one reading of the facts."""
        from meterline.operators.chargeback import direct_chargeback
        sums = self.monthly(month_start(add_months(as_date(self.as_of), -24)))
        cost = sums.where(F.col("usd_cost").isNotNull())
        return cost, direct_chargeback(cost, self.app)

    def newest_chargeback(self) -> DataFrame:
        """Direct chargeback of the newest month of that window."""
        _, charged = self.recent_chargeback()
        return charged.where(F.col("month_start") == charged.select(F.max("month_start")).scalar())

    @staticmethod
    def _between(fact: DataFrame, month, until) -> DataFrame:
        fact = since(fact, dt.datetime(month.year, month.month, 1))
        return fact if until is None else fact.where(F.col("ts") < ts_lit(dt.datetime(until.year, until.month, 1)))

    @cached_property
    def v8(self):
        from meterline.operators import views as V
        return V.v8_peak_pro_comparison(self.cost, self.app, self.as_of)
