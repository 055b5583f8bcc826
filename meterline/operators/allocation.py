"""Shared-service cost allocation (C04-C09), set-based over all apps and months.

Every step is a join/aggregate; the only fan-out is shared app-month x
sector, bounded by the sector dimension. Rounding is half-even to the cent
on the exact rational amount (see ``meterline.functions.money``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.timeutil import add_months, as_date, since, ts_lit
from meterline.functions.money import cents, from_cents, round_half_even_ratio
from meterline.sources.seeds import SHARED_HCODE_MARKERS, SHARED_SECTOR_NAMES
from meterline.session import bounded_broadcast

# --- fixed values --------------------------------------------------------------
CYCLE_BY_METHOD = {
    "proportional_usage": "allocated_shared_service",
    "equal_split": "allocated_equal_split",
    "custom_formula": "allocated_custom_formula",
}
CUSTOM_PROPORTIONAL_TENTHS = 4   # 40 % proportional
CUSTOM_EQUAL_TENTHS = 6          # 60 % equal split
ALLOCATION_OWNER_ID = 1
# ---------------------------------------------------------------------------------


def shared_services(app: DataFrame, sectors: DataFrame) -> DataFrame:
    """Apps in a shared sector, or whose h_code mentions PLATFORM/SHARED/GLOBAL."""
    s = bounded_broadcast(sectors.select("sector_id", "sector_name"), sectors)
    h = F.coalesce(F.col("h_code"), F.lit(""))
    marked = F.lit(False)
    for m in SHARED_HCODE_MARKERS:
        marked = marked | h.ilike(f"%{m}%")
    return (app.join(s, "sector_id", "inner")
               .where(F.col("sector_name").isin(*SHARED_SECTOR_NAMES) | marked)
               .select("app_id", F.coalesce(F.col("app_name"), F.col("cmdb_name")).alias("app_name"),
                       "h_code", "sector_id", "sector_name"))


def select_rules(shared: DataFrame, rules: DataFrame) -> DataFrame:
    """First active rule (by rule_id) whose code is a case-sensitive substring of h_code."""
    # the rules, hand-written configuration, are one sorted array; no join, no shuffle
    active = rules.where(F.col("is_active") & F.col("shared_service_code").isNotNull()).agg(
        F.array_sort(F.collect_list(F.struct("rule_id", "distribution_method", "shared_service_code")))).scalar()
    fits = F.filter("_rules", lambda r: F.contains(F.col("h_code"), r["shared_service_code"]))
    return (shared.where(F.col("h_code").isNotNull()).withColumn("_rules", active)
                  .withColumn("r", F.get(fits, 0)).where(F.col("r").isNotNull())
                  .select("app_id", F.col("sector_id").alias("own_sector_id"),
                          F.col("r.rule_id").alias("rule_id"), F.col("r.distribution_method").alias("distribution_method")))


def _in_months(fact: DataFrame, months) -> DataFrame:
    """Rows of the given months (first days); their span bounds the scan by ``ts`` literals."""
    first, last = min(map(as_date, months)), add_months(max(map(as_date, months)), 1)
    fact = since(fact, dt.datetime(first.year, first.month, 1))
    return fact.where((F.col("ts") < ts_lit(dt.datetime(last.year, last.month, 1))) & F.trunc("ts", "MM").isin(*months))


def _app_month_cost(cost: DataFrame, selected: DataFrame, months) -> DataFrame:
    c = cost
    if months is not None:
        c = _in_months(c, months)
    c = (c.join(selected.select("app_id"), "app_id", "left_semi")
          .groupBy(F.trunc("ts", "MM").alias("month_start"), "app_id")
          .agg(F.sum("usd_cost").alias("total_cost")))
    return c.join(selected, "app_id").where(F.col("total_cost") != 0)


def _month_sectors(usage: DataFrame, app: DataFrame, months) -> DataFrame:
    """One row per month: the sectors with usage, as an array (target_sector_id, sector_usage) bounded by their number."""
    u = usage
    if months is not None:
        u = _in_months(u, months)
    pre = u.groupBy(F.trunc("ts", "MM").alias("month_start"), "app_id").agg(F.sum("units_consumed").alias("_u"))
    by_sector = (pre.join(app.select("app_id", "sector_id").where(F.col("sector_id").isNotNull()), "app_id")
                    .groupBy("month_start", F.col("sector_id").alias("target_sector_id"))
                    .agg(F.sum("_u").cast("decimal(38,2)").alias("sector_usage")))
    return by_sector.groupBy("month_start").agg(
        F.collect_list(F.struct("target_sector_id", "sector_usage")).alias("sectors"))


def _post(df: DataFrame, amount_cents: str, method: str) -> DataFrame:
    return df.select("month_start", "app_id", F.lit(None).cast("string").alias("h_code"),
                     F.col("target_sector_id").alias("sector_id"),
                     F.lit(ALLOCATION_OWNER_ID).alias("owner_id"),
                     from_cents(F.col(amount_cents)).alias("usd_amount"),
                     F.lit(CYCLE_BY_METHOD[method]).alias("chargeback_cycle"))


def allocate_shared_costs(cost: DataFrame, usage: DataFrame, app: DataFrame, sectors: DataFrame,
                          rules: DataFrame, months=None, methods=None) -> DataFrame:
    """Allocation rows for every shared app-month (``months=None``: all months).

    Output has the chargeback schema; one row per (month, shared app, other sector).
    ``methods`` restricts the result to some distribution methods (default: all three);
    the other branches are then not built at all.
    """
    methods = set(methods or CYCLE_BY_METHOD)
    selected = select_rules(shared_services(app, sectors), rules)
    amc = _app_month_cost(cost, selected, months)
    # usage-based methods: sectors (other than own) with usage that month.  The months' sectors are one
    # small row each, so totals come from that row and the fan-out is never shuffled.
    others = F.filter("sectors", lambda x: x["target_sector_id"] != F.col("own_sector_id"))
    by_usage = (amc.where(F.col("distribution_method").isin("proportional_usage", "custom_formula"))
                   .join(_month_sectors(usage, app, months), "month_start")
                   .withColumn("sectors", others)
                   .withColumn("total_usage", F.aggregate("sectors", F.lit(0).cast("decimal(38,2)"), lambda a, x: (
                       a + F.coalesce(x["sector_usage"], F.lit(0))).cast("decimal(38,2)")))
                   .withColumn("n_sectors", F.size("sectors").cast("long"))
                   .select("*", F.inline("sectors")).drop("sectors"))
    C, u, U, n = cents(F.col("total_cost")), cents(F.col("sector_usage")), cents(F.col("total_usage")), F.col("n_sectors")

    prop = by_usage.where((F.col("distribution_method") == "proportional_usage") & (F.col("total_usage") != 0))
    prop = prop.withColumn("_amt", round_half_even_ratio(C * u, U))

    cust = by_usage.where(F.col("distribution_method") == "custom_formula")
    p, e = CUSTOM_PROPORTIONAL_TENTHS, CUSTOM_EQUAL_TENTHS
    num = F.when(U != 0, C * u * n * p + C * U * e).otherwise(C * e)
    den = F.when(U != 0, U * n * 10).otherwise(n * 10)
    cust = cust.withColumn("_amt", round_half_even_ratio(num, den))

    parts = []
    if "proportional_usage" in methods:
        parts.append(_post(prop, "_amt", "proportional_usage"))
    if "equal_split" in methods:
        # equal split: every distinct sector of the app dimension other than own (one array, bounded by their number)
        known = app.agg(F.array_sort(F.collect_set("sector_id")).alias("s")).scalar()
        eq = (amc.where(F.col("distribution_method") == "equal_split").withColumn("_known", known)
                 .withColumn("_known", F.filter("_known", lambda x: x != F.col("own_sector_id")))
                 .withColumn("n_sectors", F.size("_known").cast("long"))
                 .withColumn("target_sector_id", F.explode("_known"))
                 .withColumn("_amt", round_half_even_ratio(cents(F.col("total_cost")), F.col("n_sectors"))))
        parts.append(_post(eq, "_amt", "equal_split"))
    if "custom_formula" in methods:
        parts.append(_post(cust, "_amt", "custom_formula"))
    if not parts:
        raise ValueError(f"unknown distribution methods: {sorted(methods)}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def allocation_residuals(cost: DataFrame, allocations: DataFrame) -> DataFrame:
    """Per shared app-month, cost minus what was allocated (rounding residue)."""
    a = allocations.groupBy("month_start", "app_id").agg(F.sum("usd_amount").alias("allocated"))
    c = (cost.join(a.select("app_id").distinct(), "app_id", "left_semi")
             .groupBy(F.trunc("ts", "MM").alias("month_start"), "app_id").agg(F.sum("usd_cost").alias("cost")))
    return (c.join(a, ["month_start", "app_id"])
             .select("month_start", "app_id", F.col("cost").cast("double").alias("cost"),
                     F.col("allocated").cast("double").alias("allocated"),
                     (F.col("cost") - F.col("allocated")).cast("double").alias("residual")))


def unallocated_shared(app: DataFrame, sectors: DataFrame, rules: DataFrame) -> DataFrame:
    """Shared services that no active rule covers."""
    shared = shared_services(app, sectors)
    sel = select_rules(shared, rules).select("app_id")
    return shared.join(sel, "app_id", "left_anti")


def allocation_summary(chargeback_all: DataFrame, sectors: DataFrame, month) -> DataFrame:
    """Q12: allocated / direct / total per sector for one month."""
    s = bounded_broadcast(sectors.select("sector_id", "sector_name"), sectors)
    alloc = F.col("chargeback_cycle").like("allocated%")
    return (chargeback_all.where(F.col("month_start") == F.lit(month))
            .join(s, "sector_id")
            .groupBy("sector_name")
            .agg(F.sum(F.when(alloc, F.col("usd_amount")).otherwise(F.lit(0))).cast("double").alias("allocated_costs"),
                 F.sum(F.when(~alloc, F.col("usd_amount")).otherwise(F.lit(0))).cast("double").alias("direct_costs"),
                 F.sum("usd_amount").cast("double").alias("total_costs")))
