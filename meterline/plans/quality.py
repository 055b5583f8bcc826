"""Data-quality and reporting checks (Q01-Q15) as DataFrames.

Each check is one or a few aggregates over the facts; the outputs are tiny
(one row per check / table / job). Thresholds are parameters.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.timeutil import since, add_months, as_date, date_lit, days_before, month_start, ts_lit
from meterline.session import bounded_broadcast
from meterline.sources.runlog import STATUSES

# --- fixed values: pass thresholds ----------------------------------------------
MIN_APP_MATCH_RATE = 80.0
MAX_ORPHAN_ROWS = 100
MIN_FORECAST_COVERAGE = 70.0
MAX_COST_VARIANCE_PCT = 1.0
MIN_CAPABILITIES = 2
MIN_ACTIVE_PRICES = 2
MIN_HCODE_COVERAGE = 80.0
CRITICAL_TABLES = ("applications", "run_log")     # must not be empty
READY_HCODE_COVERAGE = 90.0
# -----------------------------------------------------------------------------------


def row_counts(tables: dict[str, DataFrame], critical: tuple[str, ...] = CRITICAL_TABLES) -> DataFrame:
    """Q01: row count per table; the critical ones must not be empty."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "ok", (F.col("row_count") > 0) | ~F.col("table_name").isin(*critical))


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row frames side by side, without a join."""
    columns = [c for p in parts for c in p.columns]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).agg(*[F.max(c).alias(c) for c in columns])


def idle_apps(app: DataFrame, usage: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Applications without usage in the last ``days`` days."""
    recent = since(usage, days_before(as_of, days)).select("app_id")
    return app.join(recent, "app_id", "left_anti").select("app_id", "app_name", "controller")


def match_rates(app: DataFrame) -> DataFrame:
    """Q02: application-side and CMDB-side match rates, with the >= 80 % rule."""
    mon, cm = F.col("monitoring_id").isNotNull(), F.col("cmdb_id").isNotNull()
    g = app.agg(F.count_if(mon & cm).alias("matched"), F.count_if(mon).alias("monitoring_apps"),
                F.count_if(cm).alias("cmdb_records"))
    rate = F.round(F.try_divide(F.col("matched") * 100.0, F.col("monitoring_apps")), 6)
    return g.select("*", rate.alias("app_match_rate"),
                    F.round(F.try_divide(F.col("matched") * 100.0, F.col("cmdb_records")), 6).alias("cmdb_match_rate"),
                    F.coalesce(rate >= MIN_APP_MATCH_RATE, F.lit(False)).alias("ok"))


def run_state(run_events: DataFrame) -> DataFrame:
    """Q10: current state of each run from an append-only event log (latest event wins)."""
    return (run_events.groupBy("run_id")
            .agg(F.max_by(F.struct("job_name", "status", "started_at", "finished_at", "rows_ingested",
                                   "error_message"), F.col("event_time")).alias("s"))
            .select("run_id", "s.*"))


def freshness(runs: DataFrame) -> DataFrame:
    """Q03: per job, last run start, last success and last failure."""
    return runs.groupBy("job_name").agg(
        F.max("started_at").alias("last_run"),
        F.max(F.when(F.col("status") == "success", F.col("finished_at"))).alias("last_success"),
        F.max(F.when(F.col("status") == "failed", F.col("finished_at"))).alias("last_failure"))


def orphan_usage(usage: DataFrame, cost: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Q04: usage rows in the window with no cost row on (ts, app, capability)."""
    u = since(usage, days_before(as_of, days))
    c = since(cost, days_before(as_of, days)).select("ts", "app_id", "capability_id")
    n = u.join(c, ["ts", "app_id", "capability_id"], "left_anti").agg(F.count(F.lit(1)).alias("orphan_rows"))
    return n.withColumn("ok", F.col("orphan_rows") <= MAX_ORPHAN_ROWS)


def forecast_coverage(usage: DataFrame, forecast: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Q05: apps with a forecast / apps with usage in the last 30 days (>= 70 %)."""
    active = (since(usage, days_before(as_of, days)).select("app_id").distinct()
                   .agg(F.count(F.lit(1)).alias("active_apps")))
    fc = forecast.select("app_id").distinct().agg(F.count(F.lit(1)).alias("forecast_apps"))
    # combine two one-row aggregates without a join
    j = fc.unionByName(active, allowMissingColumns=True) \
          .agg(F.max("forecast_apps").alias("forecast_apps"), F.max("active_apps").alias("active_apps"))
    cov = F.round(F.try_divide(F.col("forecast_apps") * 100.0, F.col("active_apps")), 6)
    return j.select("forecast_apps", "active_apps", cov.alias("coverage_pct"),
                    F.coalesce(cov >= MIN_FORECAST_COVERAGE, F.lit(False)).alias("ok"))


def reconciliation_status(log: DataFrame) -> DataFrame:
    """Q06: counts per match status and the auto-match rate."""
    g = log.agg(F.count_if(F.col("match_status") == "auto_matched").alias("auto_matched"),
                F.count_if(F.col("match_status") == "needs_review").alias("needs_review"),
                F.count_if(F.col("match_status") == "conflict").alias("conflict"),
                F.count(F.lit(1)).alias("total"))
    return g.withColumn("auto_match_rate", F.round(F.try_divide(F.col("auto_matched") * 100.0, F.col("total")), 6))


def cost_variance(usage: DataFrame, cost: DataFrame, prices: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Q07: sum(units x effective rate) vs sum(stored cost) over the window (< 1 %)."""
    from meterline.operators.cost import price_window_join
    u = since(usage, days_before(as_of, days)).select("ts", "app_id", "capability_id", "tier", "units_consumed")
    c = since(cost, days_before(as_of, days)).select("ts", "app_id", "capability_id", "tier", "usd_cost")
    priced = price_window_join(u.join(c, ["ts", "app_id", "capability_id", "tier"]), prices)
    g = priced.agg(F.sum(F.col("units_consumed") * F.col("unit_rate")).alias("_exp"),
                   F.sum("usd_cost").alias("_act"))
    var = F.round(F.abs(F.col("_act") - F.col("_exp")).cast("double") * 100 / F.col("_exp").cast("double"), 6)
    return g.select(F.col("_exp").cast("double").alias("expected_cost"), F.col("_act").cast("double").alias("actual_cost"),
                    var.alias("variance_pct"), F.coalesce(var < MAX_COST_VARIANCE_PCT, F.lit(False)).alias("ok"))


def reference_completeness(capabilities: DataFrame, prices: DataFrame, sectors: DataFrame, as_of, usage: DataFrame,
                           app: DataFrame) -> DataFrame:
    """Q08: enough capabilities, active prices and sectors; ``used`` is how many of them usage and applications refer to."""
    d = date_lit(as_of)
    active = prices.where((F.col("start_date") <= d) & (d <= F.coalesce(F.col("end_date"), d)))
    metered = usage.select("capability_id", "tier").distinct()
    billed = app.select("sector_id").distinct()
    parts = []
    for name, rows, least, facts, keys in (("capabilities", capabilities, MIN_CAPABILITIES, metered, ["capability_id"]),
                                           ("active_prices", active, MIN_ACTIVE_PRICES, metered, ["capability_id", "tier"]),
                                           ("sectors", sectors, 1, billed, ["sector_id"])):
        hit = facts.select(*keys).distinct().withColumn("_hit", F.lit(True))
        parts.append(rows.join(hit, keys, "left").agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("used"))
                         .select(F.lit(name).alias("check"), "n", "used", (F.col("n") >= least).alias("ok")))
    return reduce(DataFrame.unionByName, parts)


def chargeback_coverage(cost: DataFrame, chargeback: DataFrame, as_of) -> DataFrame:
    """Q09: apps with costs since last month and those charged in the same month; h-code share of the
    direct records of the newest month."""
    lo = month_start(add_months(as_date(as_of), -1))
    costed = since(cost, dt.datetime.combine(lo, dt.time())).select(
        "app_id", F.trunc("ts", "MM").alias("month_start")).distinct()
    charged = (chargeback.where(F.col("month_start") >= F.lit(lo)).select("app_id", "month_start").distinct()
                         .withColumn("hit", F.lit(True)))
    apps = (costed.join(charged, ["app_id", "month_start"], "left").groupBy("app_id").agg(F.max("hit").alias("hit"))
                  .agg(F.count(F.lit(1)).alias("apps_with_costs"), F.count("hit").alias("apps_with_chargeback")))
    known = F.col("h_code") != "Unknown"
    records = _newest_direct(chargeback).agg(F.count(F.lit(1)).alias("records"), F.count_if(known).alias("with_h_code"))
    share = F.round(F.try_divide(F.col("with_h_code") * 100.0, F.col("records")), 6)
    return one_row(apps, records).select(
        "apps_with_costs", "apps_with_chargeback", (F.col("apps_with_costs") - F.col("apps_with_chargeback")).alias("missing"),
        "records", "with_h_code", (F.col("records") - F.col("with_h_code")).alias("without_h_code"),
        share.alias("h_code_coverage"), F.coalesce(share >= MIN_HCODE_COVERAGE, F.lit(False)).alias("ok"))


def _newest_direct(chargeback: DataFrame) -> DataFrame:
    newest = chargeback.select(F.max("month_start")).scalar()
    return chargeback.where((F.col("month_start") == newest) & (F.col("chargeback_cycle") == "direct"))


def chargeback_sector_distribution(chargeback: DataFrame, sectors: DataFrame) -> DataFrame:
    """Q09 (sector part): direct records of the newest month by sector."""
    s = bounded_broadcast(sectors.select("sector_id", "sector_name"), sectors)
    return (_newest_direct(chargeback).join(s, "sector_id", "left")
            .groupBy(F.coalesce(F.col("sector_name"), F.lit("Unknown")).alias("sector_name"))
            .agg(F.count(F.lit(1)).alias("record_count")))


def chargeback_summary(chargeback: DataFrame, sectors: DataFrame) -> DataFrame:
    """Q11: direct chargeback of the latest month by sector, plus a TOTAL row."""
    s = bounded_broadcast(sectors.select("sector_id", "sector_name"), sectors)
    cur = _newest_direct(chargeback).join(s, "sector_id")
    by = cur.groupBy("sector_name").agg(F.countDistinct("app_id").alias("apps"),
                                        F.sum("usd_amount").cast("double").alias("total_amount"))
    tot = cur.agg(F.countDistinct("app_id").alias("apps"), F.sum("usd_amount").cast("double").alias("total_amount")) \
             .select(F.lit("TOTAL").alias("sector_name"), "apps", "total_amount")
    return by.unionByName(tot)


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def latest_runs(runs: DataFrame, as_of, days: int = 1, n: int = 5) -> DataFrame:
    """Of the runs started within ``days``, the ``n`` that finished last (running ones first)."""
    return (runs.where(F.col("started_at") > ts_lit(days_before(as_of, days)))
                .select("run_id", "job_name", "status", "finished_at")
                .orderBy(F.col("finished_at").desc_nulls_first(), F.col("run_id").desc()).limit(n))


def pipeline_summary(app: DataFrame, usage: DataFrame, cost: DataFrame, chargeback: DataFrame,
                     forecast: DataFrame, last_runs: DataFrame) -> DataFrame:
    """Q13: applications, volumes, cost total and range, h-code share of the monitored applications, and the
    ``last_runs`` (a few rows) with their states, newest first."""
    mon, cm, h = (F.col(c).isNotNull() for c in ("monitoring_id", "cmdb_id", "h_code"))
    a = app.agg(F.count(F.lit(1)).alias("apps"), F.count_if(mon).alias("monitored_apps"), F.count_if(cm).alias("cmdb_apps"),
                F.count_if(mon & cm).alias("matched_apps"), F.count_if(mon & h).alias("monitored_with_h_code"))
    c = cost.agg(F.count(F.lit(1)).alias("cost_rows"), F.sum("usd_cost").cast("double").alias("total_cost"),
                 F.min(F.trunc("ts", "MM")).alias("first_month"), F.max(F.trunc("ts", "MM")).alias("last_month"))
    share = F.round(F.try_divide(F.col("monitored_with_h_code") * 100.0, F.col("monitored_apps")), 6)
    newest = F.sort_array(F.collect_list(F.struct(
        F.col("finished_at").isNull().alias("on"), "finished_at", "run_id",
        F.concat_ws(" ", "job_name", "status").alias("text"))), asc=False)
    runs = last_runs.agg(F.array_join(F.transform(newest, lambda r: r["text"]), ", ").alias("last_runs"))
    runs = runs.select(F.nullif("last_runs", F.lit("")).alias("last_runs"))
    return (one_row(a, _rows(usage, "usage_rows"), c, _rows(chargeback, "chargeback_rows"), _rows(forecast, "forecast_rows"), runs)
            .withColumn("h_code_coverage", share)
            .withColumn("ready", F.coalesce(share >= READY_HCODE_COVERAGE, F.lit(False))))


def dataset_summary(app, servers, edges, usage, cost, chargeback, forecast, log) -> DataFrame:
    """Q14: rows of every table, ranges of usage and forecast, h-code and match share of all applications, total cost."""
    a = app.agg(F.count(F.lit(1)).alias("apps"), F.count("h_code").alias("apps_with_h_code"), F.count("cmdb_id").alias("matched_apps"))
    u = usage.agg(F.count(F.lit(1)).alias("usage_rows"), F.min("ts").alias("first_usage"), F.max("ts").alias("last_usage"))
    c = cost.agg(F.count(F.lit(1)).alias("cost_rows"), F.sum("usd_cost").cast("double").alias("total_cost"))
    f = forecast.agg(F.count(F.lit(1)).alias("forecast_rows"), F.min("month_start").alias("first_forecast"),
                     F.max("month_start").alias("last_forecast"))
    wide = one_row(a, _rows(servers, "servers"), _rows(edges, "app_server_edges"), u, c, _rows(chargeback, "chargeback_rows"),
                   f, _rows(log, "reconciliation_rows"))
    for name, part in (("h_code_coverage", "apps_with_h_code"), ("match_rate", "matched_apps")):
        wide = wide.withColumn(name, F.round(F.try_divide(F.col(part) * 100.0, F.col("apps")), 6))
    return wide


#: Q15: table -> unique keys, foreign keys (column, table, its column), value sets, columns that must not be null
CONSTRAINTS = {
    "app": dict(keys=[("monitoring_id", "controller"), ("cmdb_id",)],
                refs=[("sector_id", "sectors", "sector_id"), ("owner_id", "owners", "owner_id")],
                values={"license_tier": ("Peak", "Pro", "Unknown")}, required=["app_id"]),
    "servers": dict(keys=[("sys_id",)], required=["sys_id"]),
    "edges": dict(keys=[("app_id", "server_sys_id")], refs=[("app_id", "app", "app_id"), ("server_sys_id", "servers", "sys_id")],
                  required=["app_id", "server_sys_id"]),
    "usage": dict(keys=[("ts", "app_id", "capability_id", "tier")],
                  refs=[("app_id", "app", "app_id"), ("capability_id", "capabilities", "capability_id")],
                  values={"tier": ("Peak", "Pro")}, required=["ts"]),
    "cost": dict(keys=[("ts", "app_id", "capability_id", "tier")],
                 refs=[("app_id", "app", "app_id"), ("price_id", "price", "price_id")], values={"tier": ("Peak", "Pro")},
                 required=["ts"]),
    "chargeback": dict(keys=[("month_start", "app_id", "sector_id")],
                       refs=[("app_id", "app", "app_id"), ("sector_id", "sectors", "sector_id"), ("owner_id", "owners", "owner_id")],
                       required=["month_start"]),
    "forecast": dict(keys=[("month_start", "app_id", "capability_id", "tier")],
                     refs=[("app_id", "app", "app_id"), ("capability_id", "capabilities", "capability_id")],
                     required=["month_start"]),
    "price": dict(keys=[("capability_id", "tier", "start_date")], refs=[("capability_id", "capabilities", "capability_id")],
                  required=["tier", "unit_rate", "start_date"]),
    "runs": dict(keys=[("run_id",)], values={"status": STATUSES}, required=["job_name", "started_at", "status"]),
    "overrides": dict(refs=[("app_id", "app", "app_id")], required=["app_id", "field_name"]),
}


def constraint_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Q15: unique keys, foreign keys, value sets and not-null columns the DDL declares (Spark enforces none).

    Of each table all checks but the keys take one pass; a referenced key column, unique itself, is
    joined as a flag.  Every key takes one grouping.  Tables left out of ``tables`` are not checked.
    """
    from meterline.operators.cost import price_overlaps
    parts = []
    for table, df in tables.items():
        rule = CONSTRAINTS.get(table)
        if rule is None:
            continue
        checks = {f"{table}_{c}_not_null": F.col(c).isNull() for c in rule.get("required", [])}
        checks |= {f"{table}_{c}_values": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in rule.get("values", {}).items()}
        flagged = df
        for col, other, key in rule.get("refs", []):
            if other in tables:
                ref = tables[other].select(F.col(key).alias(f"_k_{col}"), F.lit(True).alias(f"_has_{col}"))
                ref = bounded_broadcast(ref, tables[other])
                flagged = flagged.join(ref, F.col(col) == F.col(f"_k_{col}"), "left")
                checks[f"{table}_{col}_fk"] = F.col(col).isNotNull() & F.col(f"_has_{col}").isNull()
        sums = flagged.agg(*[F.count_if(e).alias(n) for n, e in checks.items()])
        parts.append(sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations"))
                                                    for n in checks]))))
        for keys in rule.get("keys", []):
            full = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
            parts.append(df.where(full).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                           .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations"))
                           .select(F.lit(f"{table}_{'_'.join(keys)}_unique").alias("check_name"), "violations"))
    if "price" in tables:
        parts.append(price_overlaps(tables["price"]).agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit("price_windows_overlap").alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("violations") == 0)
