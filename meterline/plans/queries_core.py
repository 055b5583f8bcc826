"""Registered queries: cost, chargeback, allocation, panels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterline.functions.timeutil import add_months, month_start, sql_date
from meterline.operators import allocation as AL
from meterline.operators import chargeback as CB
from meterline.operators import cost as CO
from meterline.plans import oracle as O
from meterline.plans import forecast_sql, panel_sql
from meterline.plans.panels import PANELS, PanelParams
from meterline.plans.registry import ORACLE, register, star
from meterline.sources import seeds
from meterline.sources.star import Star

AS_OF = O.AS_OF


def _money(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


@register("uncosted_usage", O.build(
    "SELECT u.ts, u.app_id, u.capability_id, u.tier FROM usage u "
    "WHERE NOT EXISTS (SELECT 1 FROM cost c WHERE c.ts = u.ts AND c.app_id = u.app_id "
    "AND c.capability_id = u.capability_id AND c.tier = u.tier)", "usage", "cost"))
def q_uncosted(spark, sf_dir):
    """J03 against the cost fact: usage rows left unpriced (no price for capability/tier)."""
    s = star(spark, sf_dir)
    return CO.uncosted_usage(s.usage, s.cost).select(*CO.USAGE_KEY)


@register("chargeback_direct", O.build(
    "SELECT month_start, app_id, h_code, sector_id, owner_id, CAST(usd_amount AS DOUBLE) AS usd_amount, "
    "chargeback_cycle FROM chargeback", "chargeback"))
def q_chargeback(spark, sf_dir):
    s = star(spark, sf_dir)
    return _money(s.chargeback, "usd_amount")


@register("chargeback_enriched_only", O.build("""
SELECT CAST(date_trunc('month', lc.ts) AS DATE) AS month_start, lc.app_id, a.h_code, a.sector_id, a.owner_id,
  CAST(SUM(lc.usd_cost) AS DOUBLE) AS usd_amount, 'direct' AS chargeback_cycle
FROM cost lc JOIN app a ON a.app_id = lc.app_id
WHERE a.monitoring_id IS NOT NULL
  AND EXISTS (SELECT 1 FROM app e WHERE e.monitoring_id IS NOT NULL AND e.cmdb_id IS NOT NULL)
GROUP BY 1, 2, a.h_code, a.sector_id, a.owner_id""", "cost", "app"))
def q_chargeback_enriched(spark, sf_dir):
    s = star(spark, sf_dir)
    return _money(CB.direct_chargeback_enriched(s.cost, s.app), "usd_amount")


@register("shared_services", O.build("SELECT * FROM shared", "shared"))
def q_shared(spark, sf_dir):
    s = star(spark, sf_dir)
    return AL.shared_services(s.app, s.sectors)


@register("rule_selection", O.build("SELECT * FROM rule_sel", "rule_sel"))
def q_rules(spark, sf_dir):
    s = star(spark, sf_dir)
    return AL.select_rules(AL.shared_services(s.app, s.sectors), seeds.allocation_rules(spark))


def _alloc(spark, sf_dir, cycle):
    s = star(spark, sf_dir)
    method = {v: k for k, v in AL.CYCLE_BY_METHOD.items()}[cycle]
    a = AL.allocate_shared_costs(s.cost, s.usage, s.app, s.sectors, seeds.allocation_rules(spark),
                                 methods=[method])
    return _money(a.where(F.col("chargeback_cycle") == cycle), "usd_amount")


def _alloc_sql(cycle):
    return O.build("SELECT month_start, app_id, h_code, sector_id, owner_id, CAST(usd_amount AS DOUBLE) AS usd_amount, "
                   f"chargeback_cycle FROM allocations WHERE chargeback_cycle = '{cycle}'", "allocations")


@register("alloc_proportional", _alloc_sql("allocated_shared_service"))
def q_alloc_prop(spark, sf_dir):
    return _alloc(spark, sf_dir, "allocated_shared_service")


@register("alloc_equal", _alloc_sql("allocated_equal_split"))
def q_alloc_equal(spark, sf_dir):
    return _alloc(spark, sf_dir, "allocated_equal_split")


@register("alloc_custom", _alloc_sql("allocated_custom_formula"))
def q_alloc_custom(spark, sf_dir):
    return _alloc(spark, sf_dir, "allocated_custom_formula")


_SUMMARY_MONTH = month_start(AS_OF)


@register("alloc_summary", O.build(f"""
SELECT s.sector_name,
  CAST(SUM(CASE WHEN chargeback_cycle LIKE 'allocated%' THEN usd_amount ELSE 0 END) AS DOUBLE) AS allocated_costs,
  CAST(SUM(CASE WHEN chargeback_cycle NOT LIKE 'allocated%' THEN usd_amount ELSE 0 END) AS DOUBLE) AS direct_costs,
  CAST(SUM(usd_amount) AS DOUBLE) AS total_costs
FROM chargeback_all c JOIN sectors s ON s.sector_id = c.sector_id
WHERE month_start = {sql_date(_SUMMARY_MONTH)} GROUP BY s.sector_name""", "chargeback_all", "sectors"))
def q_alloc_summary(spark, sf_dir):
    s = star(spark, sf_dir)
    bounded = s.chargeback_all_from(_SUMMARY_MONTH, add_months(_SUMMARY_MONTH, 1))
    return AL.allocation_summary(bounded, s.sectors, _SUMMARY_MONTH)


@register("alloc_residual", O.build("""
SELECT a.month_start, a.app_id, CAST(c.cost AS DOUBLE) AS cost, CAST(a.allocated AS DOUBLE) AS allocated,
  CAST(c.cost - a.allocated AS DOUBLE) AS residual
FROM (SELECT month_start, app_id, SUM(usd_amount) AS allocated FROM allocations GROUP BY 1, 2) a
JOIN (SELECT CAST(date_trunc('month', ts) AS DATE) AS month_start, app_id, SUM(usd_cost) AS cost FROM cost GROUP BY 1, 2) c
  ON a.month_start = c.month_start AND a.app_id = c.app_id""", "allocations", "cost"))
def q_alloc_residual(spark, sf_dir):
    s = star(spark, sf_dir)
    a = AL.allocate_shared_costs(s.cost, s.usage, s.app, s.sectors, seeds.allocation_rules(spark))
    return AL.allocation_residuals(s.cost, a)


@register("unallocated_shared", O.build(
    "SELECT * FROM shared WHERE app_id NOT IN (SELECT app_id FROM rule_sel)", "shared", "rule_sel"))
def q_unallocated(spark, sf_dir):
    s = star(spark, sf_dir)
    return AL.unallocated_shared(s.app, s.sectors, seeds.allocation_rules(spark))


# --- panels -----------------------------------------------------------------------
_EVENT_PANELS = ("d46_forecast_vs_actual", "d47_forecast_by_method", "d48_forecast_bands",
                 "d49_seasonal_pattern", "d50_capacity_planning")


def _panel_query(name):
    def run(spark, sf_dir):
        s = Star.events(spark, sf_dir) if name in _EVENT_PANELS else star(spark, sf_dir)
        return PANELS[name](s, PanelParams(as_of=s.as_of))
    run.__name__ = f"q_{name}"
    return run


for _name in PANELS:
    _sql = forecast_sql.SQL.get(_name) if _name in _EVENT_PANELS else panel_sql.SQL.get(_name)
    register(_name, _sql)(_panel_query(_name))


# Q12 of the survey is the allocation summary; registered under its quality key as well.
register("q12_allocation_summary", ORACLE["alloc_summary"])(q_alloc_summary)


# --- J01 with a price list that is no small literal ------------------------------------------
def weekly_prices(spark, sf_dir):
    """A price row for each capability, tier and week in which there are orders: the listed rate plus a weekly surcharge."""
    from meterline.sources.tables import read
    weeks = read(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("week", "o_orderdate")).alias("w")).distinct()
    listed = star(spark, sf_dir).price
    days = F.datediff("w", F.lit("1990-01-01").cast("date"))
    return (weeks.join(listed, F.col("w").between(F.col("start_date"), F.coalesce("end_date", "w")))
                 .select((F.col("price_id") * 100000 + days).cast("int").alias("price_id"), "capability_id", "tier",
                         (F.col("unit_rate") + (days % 5).cast("decimal(10,4)") / 100).cast("decimal(10,4)").alias("unit_rate"),
                         F.col("w").alias("start_date"), F.date_add("w", 6).alias("end_date")))


O.cte("weekly_price", """
SELECT CAST(price_id * 100000 + date_diff('day', DATE '1990-01-01', w) AS INTEGER) AS price_id, capability_id, tier,
  CAST(unit_rate + CAST(date_diff('day', DATE '1990-01-01', w) % 5 AS DECIMAL(10,4)) / 100 AS DECIMAL(10,4)) AS unit_rate,
  w AS start_date, w + 6 AS end_date
FROM (SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS w FROM orders) o
JOIN price ON w BETWEEN start_date AND COALESCE(end_date, w)""", "price")


@register("cost_fact_weekly_prices", O.build("""
SELECT u.ts, u.app_id, u.capability_id, u.tier, CAST(ROUND(u.units_consumed * p.unit_rate, 2) AS DOUBLE) AS usd_cost, p.price_id
FROM usage u JOIN weekly_price p USING (capability_id, tier) WHERE CAST(u.ts AS DATE) BETWEEN p.start_date AND p.end_date""",
    "usage", "weekly_price"))
def q_weekly_cost(spark, sf_dir):
    """J01 / C01 by day keys: some thousand price windows."""
    from meterline.operators.cost import calculate_costs
    c = calculate_costs(star(spark, sf_dir).usage, weekly_prices(spark, sf_dir))
    return c.withColumn("usd_cost", F.col("usd_cost").cast("double"))


@register("a02_monthly_apps", O.build(f"""
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, COUNT(DISTINCT app_id) AS apps, TRUE AS estimate_holds
FROM cost SEMI JOIN app USING (app_id) WHERE ts >= {O.T180} GROUP BY ALL""", "cost", "app"))
def q_monthly_apps(spark, sf_dir):
    """Applications with costs in each month, exactly, and whether V1's merged sketches tell them within three standard errors."""
    from meterline.operators import views as V
    from meterline.functions.timeutil import days_before, since
    s = star(spark, sf_dir)
    view = V.v1_daily_cost_by_controller(s.cost, s.app, s.as_of, sketches=True)
    estimate = V.apps_of(view, F.trunc("cost_date", "MM").alias("month")).withColumnRenamed("apps", "estimate")
    exact = (since(s.cost, days_before(s.as_of, 180)).join(s.app.select("app_id"), "app_id", "left_semi")
             .groupBy(F.trunc("ts", "MM").alias("month")).agg(F.countDistinct("app_id").alias("apps")))
    held = F.abs(F.col("estimate") - F.col("apps")) <= F.greatest(F.lit(1.0), 3 * V.SKETCH_ERROR * F.col("apps"))
    return exact.join(estimate, "month").select("month", "apps", held.alias("estimate_holds"))
