"""Registered ingest / rule queries over the driver tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.functions.timeutil import days_before, sql_date, ts_lit
from meterline.operators import cost as CO
from meterline.plans import oracle as O
from meterline.plans.registry import ORACLE, register, star
from meterline.session import scratch_path
from meterline.sources import ingest as IG
from meterline.sources import seeds
from meterline.sources.star import LINEITEM_AS_OF, account_count
from meterline.sources.tables import read
from meterline.sources.versions import Table, load_new_files

# --- fixed values: how driver events are packed into usage payload documents ------
EVENT_USAGE_TYPE = {"click": "APM_APP_AGENT", "error": "MACHINE_AGENT", "purchase": "ANALYTICS_AGENT",
                    "signup": "BROWSER_RUM_AGENT", "view": "SYNTHETIC_AGENT"}
POINTS_PER_DOCUMENT = 50
# ---------------------------------------------------------------------------------------


def usage_payloads(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Events re-packed as nested usage documents (<= 50 points each, so no group is unbounded)."""
    ev = read(spark, sf_dir, "events").where(where).select("event_id", "ts", "user_id", "event_type", "value")
    m = F.create_map(*[x for k, v in EVENT_USAGE_TYPE.items() for x in (F.lit(k), F.lit(v))])
    p = ev.select((F.col("user_id") % account_count(spark, sf_dir) + 1).alias("account"),
                  F.floor(F.col("event_id") / POINTS_PER_DOCUMENT).alias("doc"),
                  F.when(F.col("user_id") % 2 == 0, F.lit("APM_PEAK")).otherwise(F.lit("APM_PRO")).alias("package"),
                  F.element_at(m, F.col("event_type")).alias("usage_type"),
                  F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                           F.struct(F.col("value").alias("avg"), F.col("value").alias("max"),
                                    F.col("value").alias("min")).alias("used")).alias("pt"))
    l1 = (p.groupBy("account", "doc", "package", "usage_type")
           .agg(F.collect_list("pt").alias("data")))
    l2 = (l1.groupBy("account", "doc", "package")
            .agg(F.collect_list(F.struct(F.col("usage_type").alias("usageType"),
                                         F.lit(1440).alias("granularityInMinutes"), "data")).alias("unitUsages")))
    l3 = (l2.groupBy("account", "doc")
            .agg(F.collect_list(F.struct(F.col("package").alias("name"), "unitUsages")).alias("packages")))
    return l3.select(F.to_json(F.struct(F.col("account").alias("accountId"), "packages")).alias("payload"))


@register("usage_flatten", O.build("""
SELECT user_id % (SELECT greatest(10, COUNT(*) // 10) FROM supplier) + 1 AS account_id, date_trunc('day', ts) AS ts,
  CASE event_type WHEN 'click' THEN 'APM' WHEN 'error' THEN 'INFRA' WHEN 'purchase' THEN 'ANALYTICS'
                  WHEN 'signup' THEN 'MRUM' END AS capability_code,
  CASE WHEN user_id % 2 = 0 THEN 'Peak' ELSE 'Pro' END AS tier, value AS units
FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup') AND COALESCE(value, 0) <> 0"""))
def q_flatten(spark, sf_dir):
    good, _ = IG.flatten_usage_payload(usage_payloads(spark, sf_dir), seeds.capabilities(spark))
    return good


#: days of the feed that each load finds in new files; the last day of one load is delivered again with the next
LOADS = ("ts < DATE '2024-01-11'", "ts >= DATE '2024-01-10' AND ts < DATE '2024-01-21'", "ts >= DATE '2024-01-20'")


@register("usage_incremental_load", O.build(f"""
SELECT account_id, ts, capability_code, tier, SUM(units) AS units,
  CASE WHEN ts < DATE '2024-01-11' THEN 1 WHEN ts < DATE '2024-01-21' THEN 2 ELSE 3 END AS load
FROM ({ORACLE["usage_flatten"]}) f GROUP BY account_id, ts, capability_code, tier"""))
def q_incremental(spark, sf_dir):
    """S01 + S07a: usage files that come in three deliveries; each load reads the new files only, the last finds none."""
    root = scratch_path(spark, f"usage-feed-{uuid.uuid4().hex}")
    table = Table(spark, f"{root}/usage", "month")
    keys = ["account_id", "ts", "capability_code", "tier"]

    def parse(paths, load):
        good, _ = IG.flatten_usage_payload(spark.read.text(paths).withColumnRenamed("value", "payload"), seeds.capabilities(spark))
        return (good.groupBy(*keys).agg(F.sum("units").alias("units"))
                    .withColumn("load", F.lit(load)).withColumn("month", F.trunc("ts", "MM")))

    for load, days in enumerate([*LOADS, None], 1):
        if days:
            usage_payloads(spark, sf_dir, days).write.mode("append").text(f"{root}/feed")
        load_new_files(table, f"{root}/feed", lambda paths, load=load: parse(paths, load), keys, "*.txt")
    return table.read().drop("month")


@register("usage_flatten_rejects", O.build("""
SELECT user_id % (SELECT greatest(10, COUNT(*) // 10) FROM supplier) + 1 AS account_id, 'SYNTHETIC_AGENT' AS usage_type, date_trunc('day', ts) AS ts,
  COALESCE(value, 0) AS units, 'unmapped_usage_type' AS reason
FROM events WHERE event_type = 'view'
UNION ALL
SELECT user_id % (SELECT greatest(10, COUNT(*) // 10) FROM supplier) + 1, CASE event_type WHEN 'click' THEN 'APM_APP_AGENT' WHEN 'error' THEN 'MACHINE_AGENT'
  WHEN 'purchase' THEN 'ANALYTICS_AGENT' WHEN 'signup' THEN 'BROWSER_RUM_AGENT' END, date_trunc('day', ts),
  0.0, 'zero_usage'
FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup') AND COALESCE(value, 0) = 0"""))
def q_flatten_rejects(spark, sf_dir):
    _, rej = IG.flatten_usage_payload(usage_payloads(spark, sf_dir), seeds.capabilities(spark))
    return rej.drop("payload")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per monitored application: tier count (distinct capabilities) and node count (parts / 50)."""
    li = read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    inv = (li.join(p, li.l_partkey == p.p_partkey)
             .groupBy((F.col("l_suppkey") + 1).alias("app_id"))
             .agg(F.countDistinct(F.col("p_size") % 5 + 1).alias("tier_count"),
                  F.floor(F.countDistinct("l_partkey") / 50).alias("node_count")))
    app = star(spark, sf_dir).app.where(F.col("monitoring_id").isNotNull()).select("app_id", "license_tier")
    return inv.join(app, "app_id")


O.cte("inventory", """
SELECT i.app_id, i.tier_count, i.node_count, a.license_tier
FROM (SELECT l.l_suppkey + 1 AS app_id, COUNT(DISTINCT p.p_size % 5 + 1) AS tier_count,
             CAST(floor(COUNT(DISTINCT l.l_partkey) / 50) AS BIGINT) AS node_count
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1) i
JOIN app a ON a.app_id = i.app_id WHERE a.monitoring_id IS NOT NULL""", "app")


@register("architecture_rule", O.build("""
SELECT app_id, tier_count, node_count,
  CASE WHEN tier_count >= 4 OR (tier_count >= 2 AND node_count >= 10) THEN 'Microservices' ELSE 'Monolithic' END
    AS architecture
FROM inventory""", "inventory"))
def q_arch_rule(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return inv.select("app_id", "tier_count", "node_count",
                      rules.architecture_name("tier_count", "node_count").alias("architecture"))


_EST_END = LINEITEM_AS_OF
_EST_START = _EST_END - dt.timedelta(days=IG.ESTIMATE_DAYS)


@register("usage_estimate", O.build(f"""
WITH days AS (SELECT CAST(d AS DATE) AS d FROM generate_series({sql_date(_EST_START)}, {sql_date(_EST_END)},
                                                               INTERVAL 1 DAY) t(d))
SELECT CAST(d AS TIMESTAMP) AS ts, app_id, 1 AS capability_id, license_tier AS tier,
  ROUND(node_count * CAST(1.5 AS DOUBLE) * (CAST(0.9 AS DOUBLE) + CAST(0.2 AS DOUBLE) * CAST(day(d) % 7 AS DOUBLE) / 7), 2)
    AS units_consumed, node_count AS nodes_count
FROM inventory JOIN days ON TRUE
UNION ALL
SELECT CAST(d AS TIMESTAMP), app_id, 2, license_tier,
  ROUND(tier_count * CAST(100 AS DOUBLE) * (CAST(0.8 AS DOUBLE) + CAST(0.4 AS DOUBLE) * CAST(day(d) % 7 AS DOUBLE) / 7), 2),
  tier_count
FROM inventory JOIN days ON TRUE""", "inventory"))
def q_estimate(spark, sf_dir):
    return IG.usage_estimate(inventory(spark, sf_dir), _EST_END, seeds.capabilities(spark))


@register("calendar", O.build("""
WITH b AS (SELECT CAST(MIN(l_shipdate) AS DATE) AS lo, CAST(MAX(l_shipdate) AS DATE) AS hi FROM lineitem),
d AS (SELECT CAST(x AS DATE) AS date_value FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(x))
SELECT date_value, CAST(year(date_value) AS INTEGER) AS year, CAST(quarter(date_value) AS INTEGER) AS quarter,
  CAST(month(date_value) AS INTEGER) AS month, monthname(date_value) AS month_name,
  CAST(weekofyear(date_value) AS INTEGER) AS week, CAST(day(date_value) AS INTEGER) AS day_of_month,
  CAST(isodow(date_value) AS INTEGER) AS day_of_week, dayname(date_value) AS day_name,
  isodow(date_value) >= 6 AS is_weekend, FALSE AS is_holiday, CAST(year(date_value) AS INTEGER) AS fiscal_year,
  CAST(quarter(date_value) AS INTEGER) AS fiscal_quarter, CAST(month(date_value) AS INTEGER) AS fiscal_period
FROM d"""))
def q_calendar(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    dates = li.agg(F.min("d").alias("lo"), F.max("d").alias("hi")) \
              .select(F.explode(F.sequence("lo", "hi")).alias("date_value"))
    return IG.calendar_of(dates)


@register("tier_rule", O.build("""
SELECT doc_id, source,
  CASE WHEN regexp_matches(lower(concat_ws(chr(10), source, text)), 'prod|critical|enterprise|premium')
       THEN 'Peak' ELSE 'Pro' END AS license_tier
FROM documents"""))
def q_tier_rule(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return d.select("doc_id", "source", rules.license_tier("source", "text").alias("license_tier"))


def supplier_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    k = F.col("s_suppkey")

    def tag(name, value):
        return F.struct(name.alias("name"), value.cast("string").alias("value"))

    tags = F.array(
        tag(F.lit("h_code"), F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("HC"), F.col("s_nationkey")))),
        tag(F.lit("hcode"), F.concat(F.lit("X"), F.col("n_regionkey").cast("string"))),
        tag(F.lit(""), F.lit("junk")),
        tag(F.lit("h-code"), F.when(k % 3 == 0, F.concat(F.lit("H-"), k.cast("string")))),
        tag(F.when(k % 5 == 0, F.lit("h-code")), F.concat(F.lit("H5-"), k.cast("string"))))
    return s.join(n, s.s_nationkey == n.n_nationkey).select((k + 1).alias("app_id"), tags.alias("tags"))


@register("hcode_rule", O.build("""
SELECT s.s_suppkey + 1 AS app_id,
  COALESCE(NULLIF(CASE WHEN s.s_suppkey % 5 = 0 THEN 'H5-' || CAST(s.s_suppkey AS VARCHAR)
                       WHEN s.s_suppkey % 3 = 0 THEN 'H-' || CAST(s.s_suppkey AS VARCHAR) END, ''),
           NULLIF(CASE WHEN s.s_suppkey % 4 = 0 THEN '' ELSE 'HC' || CAST(s.s_nationkey AS VARCHAR) END, ''),
           NULLIF('X' || CAST(n.n_regionkey AS VARCHAR), '')) AS h_code,
  CAST(3 AS INTEGER) AS tag_count
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""))
def q_hcode(spark, sf_dir):
    t = supplier_tags(spark, sf_dir).select("app_id", IG.tags_to_map(F.col("tags")).alias("m"))
    return t.select("app_id", rules.hcode_from_tags("m").alias("h_code"), F.size("m").alias("tag_count"))


@register("account_usage_by_nodes", O.build(f"""
WITH acct AS (
  SELECT user_id % (SELECT greatest(10, COUNT(*) // 10) FROM supplier) + 1 AS account_id, date_trunc('day', ts) AS ts,
    CASE event_type WHEN 'click' THEN 'APM' WHEN 'error' THEN 'INFRA' WHEN 'purchase' THEN 'ANALYTICS'
                    WHEN 'signup' THEN 'MRUM' END AS capability_code,
    CASE WHEN user_id % 2 = 0 THEN 'Peak' ELSE 'Pro' END AS tier, SUM(CAST(value AS DECIMAL(12,2))) AS units
  FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup') AND COALESCE(value, 0) <> 0
  GROUP BY 1, 2, 3, 4),
nodes AS (SELECT (app_id - 1) % (SELECT greatest(10, COUNT(*) // 10) FROM supplier) + 1 AS account_id, app_id, node_count FROM inventory),
tot AS (SELECT account_id, SUM(node_count) AS total FROM nodes GROUP BY 1 HAVING SUM(node_count) > 0)
SELECT a.ts, n.app_id, a.capability_code, a.tier,
  CAST({O.half_up(O.cents_sql("a.units") + " * n.node_count", "t.total")} AS DOUBLE) / 100 AS units_consumed,
  CAST(n.node_count AS INTEGER) AS nodes_count
FROM acct a JOIN nodes n ON a.account_id = n.account_id JOIN tot t ON t.account_id = n.account_id""", "inventory"))
def q_account_usage(spark, sf_dir):
    good, _ = IG.flatten_usage_payload(usage_payloads(spark, sf_dir), seeds.capabilities(spark))
    acct = (good.groupBy("account_id", "ts", "capability_code", "tier")
                .agg(F.sum(F.col("units").cast("decimal(12,2)")).alias("units")))
    nodes = inventory(spark, sf_dir).select(((F.col("app_id") - 1) % account_count(spark, sf_dir) + 1).alias("account_id"),
                                            "app_id", "node_count")
    out = CO.distribute_account_usage(acct, nodes)
    return out.withColumn("units_consumed", F.col("units_consumed").cast("double"))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual overrides derived from supplier balances (active / expired / superseded cases)."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    k, bal = F.col("s_suppkey"), F.col("s_acctbal")
    t0 = ts_lit(dt.datetime(2001, 1, 1))
    t1 = ts_lit(dt.datetime(2001, 6, 1))
    far = ts_lit(dt.datetime(2030, 1, 1))
    a = s.select((k + 1).alias("app_id"), F.lit("h_code").alias("field_name"),
                 F.concat(F.lit("OV-"), F.col("s_nationkey").cast("string")).alias("override_value"),
                 (bal > 0).alias("is_active"),
                 F.when(bal > 5000, F.lit(None).cast("timestamp_ntz")).otherwise(t1).alias("expires_at"),
                 t0.alias("created_at"))
    b = s.select((k + 1).alias("app_id"), F.lit("h_code").alias("field_name"),
                 F.concat(F.lit("OV2-"), k.cast("string")).alias("override_value"),
                 (bal > 8000).alias("is_active"), far.alias("expires_at"), t1.alias("created_at"))
    c = s.select((k + 1).alias("app_id"), F.lit("sector").alias("field_name"),
                 (F.col("s_nationkey") % 7 + 1).cast("string").alias("override_value"),
                 (bal < 0).alias("is_active"), F.lit(None).cast("timestamp_ntz").alias("expires_at"),
                 t0.alias("created_at"))
    return a.unionByName(b).unionByName(c)


@register("overrides_applied", O.build(f"""
WITH ov AS (
  SELECT s_suppkey + 1 AS app_id, 'h_code' AS field_name, 'OV-' || CAST(s_nationkey AS VARCHAR) AS override_value,
    s_acctbal > 0 AS is_active, CASE WHEN s_acctbal > 5000 THEN NULL ELSE TIMESTAMP '2001-06-01' END AS expires_at,
    TIMESTAMP '2001-01-01' AS created_at FROM supplier
  UNION ALL
  SELECT s_suppkey + 1, 'h_code', 'OV2-' || CAST(s_suppkey AS VARCHAR), s_acctbal > 8000, TIMESTAMP '2030-01-01',
    TIMESTAMP '2001-06-01' FROM supplier
  UNION ALL
  SELECT s_suppkey + 1, 'sector', CAST(s_nationkey % 7 + 1 AS VARCHAR), s_acctbal < 0, NULL, TIMESTAMP '2001-01-01'
  FROM supplier),
live AS (SELECT * FROM ov WHERE is_active AND (expires_at IS NULL OR expires_at > {O.sql_ts(days_before(LINEITEM_AS_OF, 0))})),
newest AS (SELECT app_id, arg_max(override_value, created_at) FILTER (WHERE field_name = 'h_code') AS h,
                  arg_max(override_value, created_at) FILTER (WHERE field_name = 'sector') AS s
           FROM live GROUP BY app_id)
SELECT a.app_id, COALESCE(n.h, a.h_code) AS h_code, COALESCE(TRY_CAST(n.s AS INTEGER), a.sector_id) AS sector_id,
  a.owner_id, a.architecture_id
FROM app a LEFT JOIN newest n ON a.app_id = n.app_id""", "app"))
def q_overrides(spark, sf_dir):
    app = star(spark, sf_dir).app
    out = CO.apply_overrides(app, overrides(spark, sf_dir), LINEITEM_AS_OF)
    return out.select("app_id", "h_code", "sector_id", "owner_id", "architecture_id")
