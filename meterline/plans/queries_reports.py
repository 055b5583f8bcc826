"""Registered reports (Q01, Q09, Q13-Q15, L03, J04), published views (V9) and panels with a filter set."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from meterline.functions.timeutil import add_months, days_before, month_start, sql_date, sql_ts
from meterline.operators import reconcile as R
from meterline.plans import oracle as O
from meterline.plans import panel_sql as P
from meterline.plans import quality as Q
from meterline.plans import refresh as RF
from meterline.plans.panels import PANELS, PanelParams
from meterline.plans.queries_extra import _matched, cmdb_relations, cmdb_servers
from meterline.plans.queries_ingest import overrides
from meterline.plans.queries_quality import run_events
from meterline.plans.registry import register, star
from meterline.session import checkpoint_dir, cut_lineage
from meterline.sources import ingest as IG
from meterline.sources import sinks as SK
from meterline.sources.star import LINEITEM_AS_OF, Star, recon_applications

AS = LINEITEM_AS_OF
RUNS_AS_OF = dt.date(2001, 8, 1)       # fixed value: last day of the run log derived from orders
LAST_MONTH = month_start(add_months(AS, -1))


def _runs(spark, sf_dir):
    return Q.run_state(run_events(spark, sf_dir))


def _servers(spark, sf_dir):
    """Shuffled once more as they are made: a plan that counts the servers and joins edges to them makes them once.

    They are distributed by id already, so that Spark would take out a plain ``repartition``.
    """
    out = IG.servers_for_matched_apps(cmdb_relations(spark, sf_dir), cmdb_servers(spark, sf_dir), _matched(spark, sf_dir))
    return out.hint("rebalance", "sys_id")


def _edges(spark, sf_dir, app, servers):
    return IG.app_server_edges(cmdb_relations(spark, sf_dir), app, servers)


O.cte("edges", """
SELECT DISTINCT app_id, child AS server_sys_id
FROM s06_rel JOIN app ON cmdb_id = parent JOIN s06_servers ON sys_id = child
WHERE type = 'Depends on::Used by'""", "s06_rel", "s06_servers", "app")
O.cte("ev_charged", """
SELECT DISTINCT date_trunc('month', ts) AS month_start, app_id FROM ev_cost SEMI JOIN app USING (app_id)""", "ev_cost", "app")

_COUNTED = {"applications": "app", "servers": "s06_servers", "app_server_mapping": "edges", "license_usage": "usage",
            "license_cost": "cost", "chargeback": "chargeback", "forecast": "ev_forecast",
            "reconciliation_log": "recon_pairs", "run_log": "runs"}


@register("q01_row_counts", O.build(
    "SELECT *, row_count > 0 OR table_name NOT IN ('applications', 'run_log') AS ok FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {t}" for n, t in _COUNTED.items())
    + ") c", *_COUNTED.values()))
def q01(spark, sf_dir):
    s = star(spark, sf_dir)
    servers = _servers(spark, sf_dir)
    return Q.row_counts({
        "applications": s.app, "servers": servers, "app_server_mapping": _edges(spark, sf_dir, s.app, servers),
        "license_usage": s.usage, "license_cost": s.cost, "chargeback": s.chargeback,
        "forecast": Star.events(spark, sf_dir).forecast, "reconciliation_log": R.reconcile(recon_applications(spark, sf_dir))[0],
        "run_log": _runs(spark, sf_dir)})


@register("q09_chargeback_coverage", O.build(f"""
WITH costed AS (SELECT DISTINCT app_id, CAST(date_trunc('month', ts) AS DATE) AS month_start FROM cost
                WHERE ts >= {sql_ts(dt.datetime.combine(LAST_MONTH, dt.time()))}),
newest AS (SELECT h_code FROM chargeback WHERE chargeback_cycle = 'direct'
           AND month_start = (SELECT MAX(month_start) FROM chargeback)),
facts AS (SELECT (SELECT COUNT(DISTINCT app_id) FROM costed) AS apps_with_costs,
  (SELECT COUNT(DISTINCT app_id) FROM costed SEMI JOIN chargeback USING (app_id, month_start)) AS apps_with_chargeback,
  (SELECT COUNT(*) FROM newest) AS records, (SELECT COUNT(*) FROM newest WHERE h_code <> 'Unknown') AS with_h_code)
SELECT *, apps_with_costs - apps_with_chargeback AS missing, records - with_h_code AS without_h_code,
  ROUND(with_h_code * 100.0 / NULLIF(records, 0), 6) AS h_code_coverage,
  COALESCE(with_h_code * 100.0 / NULLIF(records, 0) >= 80, FALSE) AS ok FROM facts""", "cost", "chargeback"))
def q09(spark, sf_dir):
    s = star(spark, sf_dir)
    cost, charged = s.recent_chargeback()
    return Q.chargeback_coverage(cost, charged, s.as_of)


@register("q09_sector_distribution", O.build("""
SELECT COALESCE(sector_name, 'Unknown') AS sector_name, COUNT(*) AS record_count
FROM chargeback LEFT JOIN sectors USING (sector_id)
WHERE chargeback_cycle = 'direct' AND month_start = (SELECT MAX(month_start) FROM chargeback) GROUP BY 1""",
    "chargeback", "sectors"))
def q09_sectors(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.chargeback_sector_distribution(s.newest_chargeback(), s.sectors)


@register("q13_pipeline_summary", O.build(f"""
WITH w AS (SELECT * FROM
  (SELECT COUNT(*) AS apps, COUNT(monitoring_id) AS monitored_apps, COUNT(cmdb_id) AS cmdb_apps,
          COUNT(*) FILTER (monitoring_id IS NOT NULL AND cmdb_id IS NOT NULL) AS matched_apps,
          COUNT(h_code) FILTER (monitoring_id IS NOT NULL) AS monitored_with_h_code FROM app),
  (SELECT COUNT(*) AS usage_rows FROM usage),
  (SELECT COUNT(*) AS cost_rows, CAST(SUM(usd_cost) AS DOUBLE) AS total_cost,
          CAST(date_trunc('month', MIN(ts)) AS DATE) AS first_month, CAST(date_trunc('month', MAX(ts)) AS DATE) AS last_month FROM cost),
  (SELECT COUNT(*) AS chargeback_rows FROM chargeback), (SELECT COUNT(*) AS forecast_rows FROM ev_forecast),
  (SELECT string_agg(job_name || ' ' || status, ', ' ORDER BY finished_at DESC NULLS FIRST, run_id DESC) AS last_runs FROM
    (FROM runs WHERE started_at > {sql_ts(days_before(RUNS_AS_OF, 1))} ORDER BY finished_at DESC NULLS FIRST, run_id DESC LIMIT 5)))
SELECT *, ROUND(monitored_with_h_code * 100.0 / NULLIF(monitored_apps, 0), 6) AS h_code_coverage,
  COALESCE(monitored_with_h_code * 100.0 / NULLIF(monitored_apps, 0) >= 90, FALSE) AS ready FROM w""",
    "app", "usage", "cost", "chargeback", "ev_forecast", "runs"))
def q13(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.pipeline_summary(s.app, s.usage, s.cost, s.chargeback, Star.events(spark, sf_dir).forecast,
                              Q.latest_runs(_runs(spark, sf_dir), RUNS_AS_OF))


@register("q14_dataset_summary", O.build("""
WITH w AS (SELECT * FROM
  (SELECT COUNT(*) AS apps, COUNT(h_code) AS apps_with_h_code, COUNT(cmdb_id) AS matched_apps FROM app),
  (SELECT COUNT(*) AS servers FROM s06_servers), (SELECT COUNT(*) AS app_server_edges FROM edges),
  (SELECT COUNT(*) AS usage_rows, MIN(ts) AS first_usage, MAX(ts) AS last_usage FROM ev_usage),
  (SELECT COUNT(*) AS cost_rows, CAST(SUM(usd_cost) AS DOUBLE) AS total_cost FROM ev_cost),
  (SELECT COUNT(*) AS chargeback_rows FROM ev_charged),
  (SELECT COUNT(*) AS forecast_rows, MIN(month_start) AS first_forecast, MAX(month_start) AS last_forecast FROM ev_forecast),
  (SELECT COUNT(*) AS reconciliation_rows FROM recon_pairs))
SELECT *, ROUND(apps_with_h_code * 100.0 / NULLIF(apps, 0), 6) AS h_code_coverage,
  ROUND(matched_apps * 100.0 / NULLIF(apps, 0), 6) AS match_rate FROM w""",
    "app", "s06_servers", "edges", "ev_usage", "ev_cost", "ev_charged", "ev_forecast", "recon_pairs"))
def q14(spark, sf_dir):
    s = Star.events(spark, sf_dir)
    servers = _servers(spark, sf_dir)
    return Q.dataset_summary(s.app, servers, _edges(spark, sf_dir, s.app, servers), s.usage, s.cost, s.chargeback,
                             s.forecast, R.reconcile(recon_applications(spark, sf_dir))[0])


#: the oracle's name of each checked table
_CHECKED = {"app": "app", "servers": "s06_servers", "edges": "edges", "usage": "usage", "cost": "cost",
            "chargeback": "chargeback", "forecast": "ev_forecast", "price": "price", "runs": "runs", "overrides": "override_rows",
            "sectors": "sectors", "owners": "owners", "capabilities": "capabilities"}
O.cte("override_rows", """
SELECT s_suppkey + 1 AS app_id, UNNEST(['h_code', 'h_code', 'sector']) AS field_name FROM supplier""")


def _check_sql():
    out = []
    for table, rule in Q.CONSTRAINTS.items():
        t = _CHECKED[table]

        def check(name, condition):
            out.append(f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {t} WHERE {condition}")
        for c in rule.get("required", []):
            check(f"{table}_{c}_not_null", f"{c} IS NULL")
        for c, allowed in rule.get("values", {}).items():
            check(f"{table}_{c}_values", f"{c} NOT IN {allowed}")
        for c, other, key in rule.get("refs", []):
            check(f"{table}_{c}_fk", f"{c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM {_CHECKED[other]})")
        for keys in rule.get("keys", []):
            full = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            out.append(f"SELECT '{table}_{'_'.join(keys)}_unique', (SELECT COUNT(*) FROM {t} WHERE {full}) - "
                       f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {t} WHERE {full}))")
    out.append("SELECT 'price_windows_overlap', COUNT(*) FROM price a JOIN price b USING (capability_id, tier) "
               "WHERE a.price_id < b.price_id AND a.start_date <= COALESCE(b.end_date, DATE '9999-12-31') "
               "AND b.start_date <= COALESCE(a.end_date, DATE '9999-12-31')")
    return "SELECT *, violations = 0 AS ok FROM (" + " UNION ALL ".join(out) + ") t"


@register("q15_constraints", O.build(_check_sql(), *_CHECKED.values()))
def q15(spark, sf_dir):
    s = star(spark, sf_dir)
    servers = _servers(spark, sf_dir)
    return Q.constraint_checks({
        "app": s.app, "servers": servers, "edges": _edges(spark, sf_dir, s.app, servers), "usage": s.usage, "cost": s.cost,
        "chargeback": s.chargeback, "forecast": Star.events(spark, sf_dir).forecast, "price": s.price,
        "runs": _runs(spark, sf_dir), "overrides": overrides(spark, sf_dir), "sectors": s.sectors, "owners": s.owners,
        "capabilities": s.capabilities})


@register("l03_latest_runs", O.build(f"""
SELECT run_id, job_name, status, finished_at FROM runs
WHERE started_at > {sql_ts(days_before(RUNS_AS_OF, 1))} ORDER BY finished_at DESC NULLS FIRST, run_id DESC LIMIT 5""", "runs"))
def q_latest_runs(spark, sf_dir):
    """Of the runs started within a day, the five that finished last (running ones first)."""
    return Q.latest_runs(_runs(spark, sf_dir), RUNS_AS_OF)


@register("j04_idle_apps", O.build(f"""
SELECT app_id, app_name, controller FROM app ANTI JOIN
  (SELECT app_id FROM usage WHERE ts >= {sql_ts(days_before(AS, 7))}) USING (app_id)""", "app", "usage"))
def q_idle(spark, sf_dir):
    s = star(spark, sf_dir)
    return Q.idle_apps(s.app, s.usage, s.as_of)


# --- V9: published views and a panel that reads them ------------------------------------
def _publish(spark, sf_dir, names, times=1):
    s = star(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/meterline-views/{uuid.uuid4().hex}"
    for _ in range(times):
        status = SK.publish_views(spark, {v: (lambda v=v: getattr(s, v)) for v in names}, root)
    return s, root, status


_V = [f"v{i}" for i in range(1, 9)]


@register("v9_publish_status", O.build(" UNION ALL ".join(
    f"SELECT '{v}' AS \"view\", 'success' AS status, CAST(0 AS BIGINT) AS rows_before, COUNT(*) AS \"rows\" FROM {v}" for v in _V), *_V))
def q_publish(spark, sf_dir):
    return _publish(spark, sf_dir, _V)[2].select("view", "status", "rows_before", "rows")


@register("v9_panel_d06", P.SQL["d06_top5_sector_trend"])
def q_published_panel(spark, sf_dir):
    """D06 off the current version of the published V7."""
    s, root, _ = _publish(spark, sf_dir, ["v7"])
    s.__dict__.update(SK.published(spark, root))
    return PANELS["d06_top5_sector_trend"](s, PanelParams(as_of=s.as_of))


@register("v9_incremental", O.view("v7"))
def q_incremental_view(spark, sf_dir):
    """V9: V7 published without one of its months, then brought up to date from that month's partition alone."""
    s = star(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/meterline-views/{uuid.uuid4().hex}"
    facts = RF.Facts(s, root)
    late = F.col("month_start") == F.lit(add_months(month_start(AS), -3))
    charged = cut_lineage(s.chargeback)
    for some, mode in ((~late, "full"), (late, "incremental")):
        facts.tables["chargeback"].append(charged.where(some))
        done = RF.refresh_views(facts, ["v7"]).first()
        if (done.status, done.mode) != ("success", mode):
            raise RuntimeError(str(done))
    return RF.published(spark, root)["v7"]


# --- panels with a filter set ------------------------------------------------------------
ONE, SOME = "ASIA", ("AMERICA", "EUROPE")          # controllers of the star are region names
_PICKED = f"cost_date BETWEEN {sql_date(days_before(AS, 90))} AND {sql_date(AS)}"
_FILTERED = {
    "d01_last_month_total": O.build(f"""
SELECT ROUND(SUM(total_amount), 2) AS total_chargeback FROM v7
WHERE controller = '{ONE}' AND month_start = (SELECT MAX(month_start) FROM v7)""", "v7"),
    "d20_total_cost": O.build(f"""
SELECT ROUND(COALESCE(SUM(total_cost), 0), 2) AS total_cost FROM v1 WHERE controller = '{ONE}' AND {_PICKED}""", "v1"),
    "d24_cost_trend_by_sector": O.build(f"""
SELECT cost_date AS time, sector_name AS metric, ROUND(SUM(total_cost), 2) AS value FROM v3
WHERE controller = '{ONE}' AND {_PICKED} GROUP BY ALL""", "v3"),
    "d29_monthly_spend": O.build(f"""
SELECT ROUND(COALESCE(CAST(SUM(usd_amount) AS DOUBLE), 0), 2) AS monthly_spend
FROM chargeback SEMI JOIN (SELECT app_id FROM app WHERE controller = '{ONE}') USING (app_id)
WHERE month_start >= {P.MLO} AND month_start < {P.MHI}""", "chargeback", "app"),
    "d43_cost_trend_24m": O.build(f"""
SELECT cost_date AS time, ROUND(SUM(total_cost), 2) AS total_cost FROM v1
WHERE controller IN {SOME} AND cost_date >= {P.D24M} GROUP BY cost_date""", "v1"),
    "d45_usage_by_type_24m": O.build(f"""
SELECT usage_date AS time, capability_code AS metric, ROUND(SUM(total_units), 2) AS value FROM v2
WHERE controller IN {SOME} AND usage_date >= {P.D24M} GROUP BY ALL""", "v2"),
}


def _filtered(name):
    def run(spark, sf_dir):
        s = star(spark, sf_dir)
        return PANELS[name](s, PanelParams(as_of=s.as_of, controller=ONE, controllers=list(SOME)))
    return run


for _name, _sql in _FILTERED.items():
    register(f"{_name}_filtered", _sql)(_filtered(_name))
