"""Independent SQL oracle (DuckDB dialect, also mostly valid Spark SQL).

Written from the definitions: reporting views are groupings of wide row sets
(joins first, no pre-aggregation), ranks and running values count or join
what they stand for, so they check the Spark plans, which pre-aggregate and
reshape, rather than mirroring them.
Each query is ``WITH <needed CTEs> <body>``; CTEs are resolved from ``CTES``.
"""

from __future__ import annotations

from meterline.functions.timeutil import (add_months, days_before, month_start, months_before,  # noqa: F401
                                          sql_date, sql_ts)
from meterline.sources import seeds
from meterline.sources.star import EVENTS_AS_OF, LINEITEM_AS_OF

AS_OF = LINEITEM_AS_OF


def _values(rows, cols, types):
    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if t.startswith("DECIMAL"):
            return f"CAST({v} AS {t})"
        if t == "DATE":
            return f"DATE '{v}'"
        if t == "BOOLEAN":
            return "TRUE" if v else "FALSE"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v} AS {t})"
    body = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name, sql, *deps):
    CTES[name] = (sql, deps)


cte("sectors", _values(seeds.SECTORS, ["sector_id", "sector_name", "description"], ["INTEGER", "VARCHAR", "VARCHAR"]))
cte("owners", _values(seeds.OWNERS, ["owner_id", "owner_name", "email", "department"],
                      ["INTEGER", "VARCHAR", "VARCHAR", "VARCHAR"]))
cte("architectures", _values(seeds.ARCHITECTURES, ["architecture_id", "pattern_name", "description"],
                             ["INTEGER", "VARCHAR", "VARCHAR"]))
cte("capabilities", _values(seeds.CAPABILITIES, ["capability_id", "capability_code", "capability_name", "description"],
                            ["INTEGER", "VARCHAR", "VARCHAR", "VARCHAR"]))
cte("price", _values(seeds.PRICES, ["price_id", "capability_id", "tier", "unit_rate", "start_date", "end_date"],
                     ["INTEGER", "INTEGER", "VARCHAR", "DECIMAL(10,4)", "DATE", "DATE"]))
cte("rules", _values(seeds.ALLOCATION_RULES,
                     ["rule_id", "rule_name", "distribution_method", "shared_service_code",
                      "applies_to_sector_id", "is_active"],
                     ["INTEGER", "VARCHAR", "VARCHAR", "VARCHAR", "INTEGER", "BOOLEAN"]))

cte("app", """
SELECT s.s_suppkey + 1 AS app_id,
  CASE WHEN s.s_suppkey % 10 = 9 THEN NULL ELSE 'm-' || CAST(s.s_suppkey AS VARCHAR) END AS monitoring_id,
  CASE WHEN s.s_suppkey % 10 = 9 THEN NULL ELSE s.s_name END AS app_name,
  CASE WHEN s.s_suppkey % 17 = 0 THEN NULL ELSE r.r_name END AS controller,
  CASE WHEN s.s_suppkey % 10 IN (7, 8) THEN NULL ELSE 'c-' || CAST(s.s_suppkey AS VARCHAR) END AS cmdb_id,
  CASE WHEN s.s_suppkey % 10 IN (7, 8) THEN NULL ELSE s.s_name END AS cmdb_name,
  CASE s.s_suppkey % 8 WHEN 0 THEN 'H-PLATFORM' WHEN 1 THEN 'H-GLOBAL_IT' WHEN 2 THEN 'H-SHARED_SVC'
       WHEN 3 THEN NULL ELSE 'H' || CAST(n.n_nationkey AS VARCHAR) END AS h_code,
  CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE CAST(n.n_nationkey % 7 + 1 AS INTEGER) END AS sector_id,
  CASE WHEN s.s_suppkey % 13 = 0 THEN NULL ELSE CAST(s.s_suppkey % 3 + 1 AS INTEGER) END AS owner_id,
  CAST(s.s_suppkey % 5 + 1 AS INTEGER) AS architecture_id,
  CASE WHEN regexp_matches(lower(CASE WHEN s.s_suppkey % 10 = 9 THEN '' ELSE s.s_name END),
                           'prod|critical|enterprise|premium') THEN 'Peak' ELSE 'Pro' END AS license_tier,
  CASE WHEN s.s_suppkey % 10 IN (7, 8) THEN NULL ELSE n.n_name END AS support_group
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("usage", """
SELECT l.l_shipdate AS ts, l.l_suppkey + 1 AS app_id, CAST(p.p_size % 5 + 1 AS INTEGER) AS capability_id,
  CASE l.l_returnflag WHEN 'A' THEN 'Peak' WHEN 'R' THEN 'Pro' END AS tier,
  CAST(SUM(CAST(l.l_quantity AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS units_consumed,
  CAST(COUNT(*) AS INTEGER) AS nodes_count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2, 3, 4""")

cte("cost", """
SELECT u.ts, u.app_id, u.capability_id, u.tier,
  CAST(ROUND(u.units_consumed * p.unit_rate, 2) AS DECIMAL(12,2)) AS usd_cost, p.price_id
FROM usage u JOIN price p ON u.capability_id = p.capability_id AND u.tier = p.tier
  AND CAST(u.ts AS DATE) BETWEEN p.start_date AND COALESCE(p.end_date, CAST(u.ts AS DATE))""", "usage", "price")

cte("chargeback", """
SELECT CAST(date_trunc('month', lc.ts) AS DATE) AS month_start, lc.app_id,
  COALESCE(a.h_code, 'Unknown') AS h_code, COALESCE(a.sector_id, 1) AS sector_id,
  COALESCE(a.owner_id, 1) AS owner_id, CAST(SUM(lc.usd_cost) AS DECIMAL(12,2)) AS usd_amount,
  'direct' AS chargeback_cycle
FROM cost lc JOIN app a ON lc.app_id = a.app_id
GROUP BY 1, 2, a.h_code, a.sector_id, a.owner_id""", "cost", "app")

T180 = sql_ts(days_before(AS_OF, 180))
T90 = sql_ts(days_before(AS_OF, 90))
T13M = sql_ts(months_before(AS_OF, 13))
M24 = sql_date(month_start(add_months(AS_OF, -24)))

# --- reporting views -----------------------------------------------------------------
# Defined as groupings of wide row sets: a fact row with everything its application says.
# ``report`` groups such rows by their raw keys (NULL and a literal 'Unknown' stay apart) and
# labels the missing names afterwards.
cte("app_wide", """
SELECT app.* EXCLUDE (sector_id, owner_id), sectors.sector_id, sector_name, owners.owner_id, owner_name
FROM app LEFT JOIN sectors USING (sector_id) LEFT JOIN owners USING (owner_id)""", "app", "sectors", "owners")
cte("cost_wide", """
SELECT cost.*, CAST(ts AS DATE) AS cost_date, CAST(date_trunc('month', ts) AS DATE) AS month_start,
  app_wide.* EXCLUDE (app_id)
FROM cost JOIN app_wide USING (app_id)""", "cost", "app_wide")
cte("usage_wide", """
SELECT usage.*, CAST(ts AS DATE) AS usage_date, capability_code, capability_name, app_wide.* EXCLUDE (app_id)
FROM usage JOIN app_wide USING (app_id) JOIN capabilities USING (capability_id)""",
    "usage", "app_wide", "capabilities")
cte("ledger_wide", """
SELECT chargeback.* EXCLUDE (sector_id), sectors.sector_id, sector_name, controller
FROM chargeback LEFT JOIN sectors USING (sector_id) JOIN (SELECT app_id, controller FROM app) USING (app_id)""",
    "chargeback", "sectors", "app")

NAMED = {"controller", "sector_name", "owner_name", "h_code", "architecture_name"}


def total(c: str, kind: str = "DOUBLE") -> str:
    return f"CAST(SUM({c}) AS {kind})"


def mean(c: str) -> str:
    return f"{total(c)} / COUNT({c})"


def report_sql(rows: str, keys: str, measures: dict[str, str], where: str = "TRUE", extra: str = "") -> str:
    """Rows of ``rows`` grouped by ``keys``; ``extra`` holds columns computed from the measures."""
    names = [k.split(" AS ")[-1] for k in keys.split(", ")]
    label = ", ".join(f"COALESCE({k}, 'Unknown') AS {k}" for k in names if k in NAMED)
    made = ", ".join(f"{e} AS {n}" for n, e in measures.items())
    shown = f"* REPLACE ({label})" if label else "*"
    return (f"\nSELECT {shown}{', ' + extra if extra else ''}\n"
            f"FROM (SELECT {keys}, {made}\n      FROM {rows} WHERE {where} GROUP BY ALL) g")


COST = {"total_cost": total("usd_cost"), "avg_cost": mean("usd_cost"),
        "record_count": "COUNT(*)", "app_count": "COUNT(DISTINCT app_id)"}
cte("v1", report_sql("cost_wide", "cost_date, controller, tier", COST, f"ts >= {T180}"), "cost_wide")
cte("v2", report_sql("usage_wide", "usage_date, capability_code, capability_name, controller, tier", {
    "total_units": total("units_consumed"), "avg_units": mean("units_consumed"),
    "total_nodes": total("nodes_count", "BIGINT"), "avg_nodes": mean("nodes_count"),
    "app_count": "COUNT(DISTINCT app_id)", "record_count": "COUNT(*)"}, f"ts >= {T180}"), "usage_wide")
cte("v3", report_sql("cost_wide", "cost_date, sector_name, sector_id, controller, tier", COST, f"ts >= {T180}"), "cost_wide")
cte("v4", report_sql("cost_wide", "cost_date, owner_name, owner_id, controller, tier", COST, f"ts >= {T180}"), "cost_wide")


def _v5(same: str) -> str:
    """Usage rows, each with every cost row that ``same`` calls its own (or none), by architecture."""
    pairs = f"""(
  SELECT u.app_id, u.capability_id, c.tier, u.units_consumed, u.nodes_count, c.usd_cost
  FROM (SELECT * FROM usage WHERE ts >= {T90}) u LEFT JOIN (SELECT * FROM cost WHERE ts >= {T90}) c ON {same})
  JOIN (SELECT app_id, controller, architecture_id FROM app) USING (app_id)
  LEFT JOIN (SELECT architecture_id, pattern_name AS architecture_name FROM architectures) USING (architecture_id)
  LEFT JOIN capabilities USING (capability_id)"""
    return report_sql(pairs, "architecture_name, architecture_id, controller, capability_code, capability_name, tier", {
        "app_count": "COUNT(DISTINCT app_id)",
        "total_units": total("units_consumed"), "avg_units_per_day": mean("units_consumed"),
        "total_nodes": total("nodes_count", "BIGINT"), "avg_nodes": mean("nodes_count"),
        "total_cost": total("usd_cost"), "avg_cost_per_day": f"{total('usd_cost')} / NULLIF(COUNT(usd_cost), 0)"},
        extra="IF(avg_nodes > 0, total_units / avg_nodes, 0) AS units_per_node, "
              "IF(avg_nodes > 0, total_cost / avg_nodes, 0) AS cost_per_node")


_V5_NEEDS = ("app", "architectures", "usage", "cost", "capabilities")
cte("v5", _v5("u.app_id = c.app_id AND CAST(u.ts AS DATE) = CAST(c.ts AS DATE)"), *_V5_NEEDS)
cte("v5_exact", _v5("(u.ts, u.app_id, u.capability_id, u.tier) = (c.ts, c.app_id, c.capability_id, c.tier)"), *_V5_NEEDS)

# the rank by its definition: one more than the number of greater sums of that month and controller
cte("v6_sums", """
SELECT month_start, app_id, app_name, monitoring_id, controller, sector_name, owner_name, license_tier,
  tier AS cost_tier, SUM(usd_cost) AS spent, COUNT(usd_cost) AS n_costs, COUNT(*) AS days_active
FROM cost_wide WHERE ts >= """ + T13M + """ AND app_name IS NOT NULL GROUP BY ALL""", "cost_wide")
cte("v6", """
SELECT a.* EXCLUDE (spent, n_costs) REPLACE (COALESCE(a.controller, 'Unknown') AS controller,
    COALESCE(a.sector_name, 'Unknown') AS sector_name, COALESCE(a.owner_name, 'Unknown') AS owner_name),
  CAST(a.spent AS DOUBLE) AS total_cost, CAST(a.spent AS DOUBLE) / a.n_costs AS avg_daily_cost,
  1 + COALESCE(b.above, 0) AS cost_rank
FROM v6_sums a LEFT JOIN (
  SELECT x.month_start, x.controller, x.spent, COUNT(*) AS above
  FROM (SELECT DISTINCT month_start, controller, spent FROM v6_sums) x
  JOIN v6_sums y ON y.month_start = x.month_start AND y.controller IS NOT DISTINCT FROM x.controller AND y.spent > x.spent
  GROUP BY ALL) b
ON b.month_start = a.month_start AND b.controller IS NOT DISTINCT FROM a.controller AND b.spent = a.spent""", "v6_sums")

cte("v7", report_sql("ledger_wide", "month_start, controller, sector_name, sector_id, h_code", {
    "total_amount": total("usd_amount"), "avg_amount": mean("usd_amount"),
    "app_count": "COUNT(DISTINCT app_id)", "chargeback_records": "COUNT(*)"}, f"month_start >= {M24}"), "ledger_wide")
# a third of the peak cost could be saved (33 of 100)
cte("v8", f"""
SELECT cost_date, app_id, app_name, controller, CAST(peak AS DOUBLE) AS peak_cost, CAST(pro AS DOUBLE) AS pro_cost,
  CAST(peak + pro AS DOUBLE) AS total_cost, CAST(greatest(peak, 0) * 0.33 AS DOUBLE) AS potential_savings
FROM (SELECT cost_date, app_id, app_name, controller,
        COALESCE(SUM(usd_cost) FILTER (tier = 'Peak'), 0) AS peak, COALESCE(SUM(usd_cost) FILTER (tier = 'Pro'), 0) AS pro
      FROM cost_wide WHERE ts >= {T90} AND tier IN ('Peak', 'Pro') GROUP BY ALL) d""", "cost_wide")


def build(body: str, *needs: str) -> str:
    """``WITH`` the transitive closure of ``needs`` (dependency order) + body."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        sql, deps = CTES[n]
        for d in deps:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return f"WITH {parts},\n{b[4:].lstrip()}"
    return f"WITH {parts}\n{body}"


def view(name: str) -> str:
    return build(f"SELECT * FROM {name}", name)


# --- allocation ------------------------------------------------------------------
def half_even(num: str, den: str) -> str:
    """Exact round-half-even(num/den) on integers (HUGEINT), mirroring the rule in prose."""
    a, b = f"abs(CAST({num} AS HUGEINT))", f"abs(CAST({den} AS HUGEINT))"
    q = f"({a} // {b})"
    r = f"({a} - {q} * {b})"
    mag = f"({q} + CASE WHEN 2 * {r} > {b} OR (2 * {r} = {b} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END * {mag})"


def half_up(num: str, den: str) -> str:
    """Exact round-half-away-from-zero(num/den) on integers."""
    a, b = f"abs(CAST({num} AS HUGEINT))", f"abs(CAST({den} AS HUGEINT))"
    q = f"({a} // {b})"
    r = f"({a} - {q} * {b})"
    return f"(CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END * ({q} + CASE WHEN 2 * {r} >= {b} THEN 1 ELSE 0 END))"


def cents_sql(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


cte("shared", """
SELECT app_id, COALESCE(app_name, cmdb_name) AS app_name, h_code, sector_id, sector_name FROM app_wide
WHERE sector_name IS NOT NULL AND (list_contains(['Corporate/Shared Services', 'Global IT'], sector_name)
  OR COALESCE(regexp_matches(h_code, 'platform|shared|global', 'i'), FALSE))""", "app_wide")
cte("rule_sel", """
SELECT app_id, own_sector_id, rule_id, distribution_method FROM (
  SELECT sh.app_id, sh.sector_id AS own_sector_id, r.rule_id, r.distribution_method,
         ROW_NUMBER() OVER (PARTITION BY sh.app_id ORDER BY r.rule_id) AS rn
  FROM shared sh JOIN rules r ON r.is_active AND sh.h_code IS NOT NULL
   AND strpos(sh.h_code, r.shared_service_code) > 0) x
WHERE rn = 1""", "shared", "rules")
cte("amc", """
SELECT CAST(date_trunc('month', c.ts) AS DATE) AS month_start, c.app_id, SUM(c.usd_cost) AS total_cost,
  rs.own_sector_id, rs.distribution_method
FROM cost c JOIN rule_sel rs ON c.app_id = rs.app_id
GROUP BY 1, 2, rs.own_sector_id, rs.distribution_method HAVING SUM(c.usd_cost) <> 0""", "cost", "rule_sel")
cte("smu", """
SELECT CAST(date_trunc('month', u.ts) AS DATE) AS month_start, a.sector_id AS target_sector_id,
  SUM(u.units_consumed) AS sector_usage
FROM usage u JOIN app a ON a.app_id = u.app_id WHERE a.sector_id IS NOT NULL GROUP BY 1, 2""", "usage", "app")
cte("alloc_usage_rows", """
SELECT m.month_start, m.app_id, m.distribution_method, m.total_cost, g.target_sector_id, g.sector_usage,
  SUM(g.sector_usage) OVER (PARTITION BY m.month_start, m.app_id) AS total_usage,
  COUNT(*) OVER (PARTITION BY m.month_start, m.app_id) AS n_sectors
FROM amc m JOIN smu g ON g.month_start = m.month_start AND g.target_sector_id <> m.own_sector_id
WHERE m.distribution_method IN ('proportional_usage', 'custom_formula')""", "amc", "smu")
_C, _u, _U = cents_sql("total_cost"), cents_sql("sector_usage"), cents_sql("total_usage")
cte("alloc_prop", f"""
SELECT month_start, app_id, target_sector_id AS sector_id, {half_even(f"{_C} * {_u}", _U)} AS amount_cents,
  'allocated_shared_service' AS chargeback_cycle
FROM alloc_usage_rows WHERE distribution_method = 'proportional_usage' AND total_usage <> 0""", "alloc_usage_rows")
cte("alloc_custom", f"""
SELECT month_start, app_id, target_sector_id AS sector_id,
  CASE WHEN total_usage <> 0
       THEN {half_even(f"{_C} * {_u} * n_sectors * 4 + {_C} * {_U} * 6", f"{_U} * n_sectors * 10")}
       ELSE {half_even(f"{_C} * 6", "n_sectors * 10")} END AS amount_cents,
  'allocated_custom_formula' AS chargeback_cycle
FROM alloc_usage_rows WHERE distribution_method = 'custom_formula'""", "alloc_usage_rows")
cte("alloc_equal", f"""
SELECT month_start, app_id, sector_id, {half_even(_C, "n_sectors")} AS amount_cents,
  'allocated_equal_split' AS chargeback_cycle
FROM (SELECT m.month_start, m.app_id, m.total_cost, s.sector_id,
             COUNT(*) OVER (PARTITION BY m.month_start, m.app_id) AS n_sectors
      FROM amc m JOIN (SELECT DISTINCT sector_id FROM app WHERE sector_id IS NOT NULL) s
        ON s.sector_id <> m.own_sector_id
      WHERE m.distribution_method = 'equal_split') x""", "amc", "app")
cte("allocations", """
SELECT month_start, app_id, CAST(NULL AS VARCHAR) AS h_code, sector_id, 1 AS owner_id,
  CAST(CAST(amount_cents AS DOUBLE) / 100 AS DECIMAL(12,2)) AS usd_amount, chargeback_cycle
FROM (SELECT * FROM alloc_prop UNION ALL SELECT * FROM alloc_equal UNION ALL SELECT * FROM alloc_custom) x""",
    "alloc_prop", "alloc_equal", "alloc_custom")
cte("chargeback_all", """
SELECT month_start, app_id, h_code, sector_id, owner_id, usd_amount, chargeback_cycle FROM chargeback
UNION ALL
SELECT month_start, app_id, h_code, sector_id, owner_id, usd_amount, chargeback_cycle FROM allocations""",
    "chargeback", "allocations")
