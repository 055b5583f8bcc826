"""Registered data-quality queries (Q01-Q15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.timeutil import add_months, days_before, month_start, sql_date, sql_ts
from meterline.operators import reconcile as R
from meterline.plans import oracle as O
from meterline.plans import quality as Q
from meterline.plans.registry import register, star
from meterline.sources.star import EVENTS_AS_OF, LINEITEM_AS_OF, Star, recon_applications
from meterline.sources.tables import read

AS = LINEITEM_AS_OF


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append-only job run log derived from orders: a start event per order and an end
    event for finished ('F' -> success) or failed ('P') ones; 'O' stays running."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                             "o_orderpriority")
    base = [F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("job_name"),
            F.col("o_orderdate").alias("started_at")]
    rows = F.round("o_totalprice").cast("long")
    start = o.select(*base, F.lit("running").alias("status"), F.lit(None).cast("timestamp_ntz").alias("finished_at"),
                     F.lit(None).cast("long").alias("rows_ingested"), F.lit(None).cast("string").alias("error_message"),
                     F.col("o_orderdate").alias("event_time"))
    done = F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")
    end = (o.where(F.col("o_orderstatus").isin("F", "P"))
            .select(*base, F.when(F.col("o_orderstatus") == "F", F.lit("success")).otherwise(F.lit("failed")).alias("status"),
                    done.alias("finished_at"), rows.alias("rows_ingested"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("partial load")).alias("error_message"),
                    done.alias("event_time")))
    return start.unionByName(end)


O.cte("runs", """
SELECT o_orderkey AS run_id, o_orderpriority AS job_name, o_orderdate AS started_at,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
  CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL 1 HOUR END AS finished_at,
  CASE WHEN o_orderstatus IN ('F', 'P') THEN CAST(ROUND(o_totalprice) AS BIGINT) END AS rows_ingested,
  CASE WHEN o_orderstatus = 'P' THEN 'partial load' END AS error_message
FROM orders""")


@register("q02_match_rates", O.build("""
SELECT matched, monitoring_apps, cmdb_records, ROUND(matched * 100.0 / NULLIF(monitoring_apps, 0), 6) AS app_match_rate,
  ROUND(matched * 100.0 / NULLIF(cmdb_records, 0), 6) AS cmdb_match_rate,
  COALESCE(matched * 100.0 / NULLIF(monitoring_apps, 0) >= 80, FALSE) AS ok
FROM (SELECT COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL AND cmdb_id IS NOT NULL) AS matched,
             COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL) AS monitoring_apps,
             COUNT(*) FILTER (WHERE cmdb_id IS NOT NULL) AS cmdb_records FROM app) t""", "app"))
def q02(spark, sf_dir):
    return Q.match_rates(star(spark, sf_dir).app)


@register("q03_freshness", O.build("""
SELECT job_name, MAX(started_at) AS last_run, MAX(CASE WHEN status = 'success' THEN finished_at END) AS last_success,
  MAX(CASE WHEN status = 'failed' THEN finished_at END) AS last_failure FROM runs GROUP BY job_name""", "runs"))
def q03(spark, sf_dir):
    return Q.freshness(Q.run_state(run_events(spark, sf_dir)))


@register("q10_run_state", O.build("SELECT * FROM runs", "runs"))
def q10(spark, sf_dir):
    return Q.run_state(run_events(spark, sf_dir))


@register("q04_orphan_usage", O.build(f"""
SELECT COUNT(*) AS orphan_rows, COUNT(*) <= 100 AS ok FROM usage u
WHERE u.ts >= {sql_ts(days_before(AS, 90))} AND NOT EXISTS (
  SELECT 1 FROM cost c WHERE c.ts = u.ts AND c.app_id = u.app_id AND c.capability_id = u.capability_id)""",
    "usage", "cost"))
def q04(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.orphan_usage(s.usage, s.cost, s.as_of)


@register("q05_forecast_coverage", O.build(f"""
WITH f AS (SELECT COUNT(DISTINCT app_id) AS forecast_apps FROM ev_forecast),
a AS (SELECT COUNT(DISTINCT app_id) AS active_apps FROM ev_usage WHERE ts >= {sql_ts(days_before(EVENTS_AS_OF, 30))})
SELECT forecast_apps, active_apps, ROUND(forecast_apps * 100.0 / NULLIF(active_apps, 0), 6) AS coverage_pct,
  COALESCE(forecast_apps * 100.0 / NULLIF(active_apps, 0) >= 70, FALSE) AS ok FROM f, a""", "ev_forecast", "ev_usage"))
def q05(spark, sf_dir):
    s = Star.events(spark, sf_dir)
    return Q.forecast_coverage(s.usage, s.forecast, s.as_of)


@register("q06_recon_status", O.build("""
SELECT COUNT(*) FILTER (WHERE place = 1 AND holder IS NULL) AS auto_matched, CAST(0 AS BIGINT) AS needs_review,
  COUNT(*) FILTER (WHERE place > 1 OR holder IS NOT NULL) AS conflict, COUNT(*) AS total,
  ROUND(COUNT(*) FILTER (WHERE place = 1 AND holder IS NULL) * 100.0 / NULLIF(COUNT(*), 0), 6) AS auto_match_rate
FROM recon_pairs""", "recon_pairs"))
def q06(spark, sf_dir):
    log, _ = R.reconcile(recon_applications(spark, sf_dir))
    return Q.reconciliation_status(log)


@register("q07_cost_variance", O.build(f"""
WITH j AS (SELECT u.units_consumed * p.unit_rate AS expected, c.usd_cost AS actual
           FROM usage u JOIN cost c ON c.ts = u.ts AND c.app_id = u.app_id AND c.capability_id = u.capability_id
             AND c.tier = u.tier
           JOIN price p ON u.capability_id = p.capability_id AND u.tier = p.tier
             AND CAST(u.ts AS DATE) BETWEEN p.start_date AND COALESCE(p.end_date, CAST(u.ts AS DATE))
           WHERE u.ts >= {sql_ts(days_before(AS, 30))} AND c.ts >= {sql_ts(days_before(AS, 30))}),
g AS (SELECT SUM(expected) AS e, SUM(actual) AS a FROM j)
SELECT CAST(e AS DOUBLE) AS expected_cost, CAST(a AS DOUBLE) AS actual_cost,
  ROUND(CAST(ABS(a - e) AS DOUBLE) * 100 / CAST(e AS DOUBLE), 6) AS variance_pct,
  COALESCE(ROUND(CAST(ABS(a - e) AS DOUBLE) * 100 / CAST(e AS DOUBLE), 6) < 1, FALSE) AS ok FROM g""",
    "usage", "cost", "price"))
def q07(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.cost_variance(s.usage, s.cost, s.price, s.as_of)


@register("q08_reference_data", O.build(f"""
WITH active AS (FROM price WHERE {sql_date(AS)} BETWEEN start_date AND COALESCE(end_date, {sql_date(AS)}))
SELECT 'capabilities' AS "check", COUNT(*) AS n, COUNT(*) FILTER (capability_id IN (SELECT capability_id FROM usage)) AS used,
  COUNT(*) >= 2 AS ok FROM capabilities
UNION ALL SELECT 'active_prices', COUNT(*), (SELECT COUNT(*) FROM active SEMI JOIN usage USING (capability_id, tier)), COUNT(*) >= 2 FROM active
UNION ALL SELECT 'sectors', COUNT(*), COUNT(*) FILTER (sector_id IN (SELECT sector_id FROM app WHERE sector_id IS NOT NULL)), COUNT(*) > 0
  FROM sectors""", "capabilities", "price", "sectors", "usage", "app"))
def q08(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.reference_completeness(s.capabilities, s.price, s.sectors, s.as_of, s.usage, s.app)


@register("q11_chargeback_summary", O.build("""
WITH cur AS (SELECT c.*, s.sector_name FROM chargeback c JOIN sectors s ON s.sector_id = c.sector_id
             WHERE c.month_start = (SELECT MAX(month_start) FROM chargeback) AND c.chargeback_cycle = 'direct')
SELECT sector_name, COUNT(DISTINCT app_id) AS apps, CAST(SUM(usd_amount) AS DOUBLE) AS total_amount FROM cur
GROUP BY sector_name
UNION ALL
SELECT 'TOTAL', COUNT(DISTINCT app_id), CAST(SUM(usd_amount) AS DOUBLE) FROM cur""", "chargeback", "sectors"))
def q11(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.chargeback_summary(s.newest_chargeback(), s.sectors)
