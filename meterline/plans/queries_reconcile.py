"""Registered reconciliation queries (app dimension of the lineitem star)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.timeutil import PARTITION_COL
from meterline.operators import reconcile as R
from meterline.operators.cost import USAGE_KEY
from meterline.plans import oracle as O
from meterline.plans.registry import register, star
from meterline.session import cut_lineage, scratch_path
from meterline.sources.star import COPY_IDS, RECORD_IDS, STALE_IDS, recon_applications, recon_cost
from meterline.sources.tables import read
from meterline.sources.versions import Table


def cmdb_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMDB service feed: an upper-cased record per supplier in the CMDB, plus a later
    lower-cased duplicate of every supplier name (exercises case-insensitivity and last-wins)."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    k = F.col("s_suppkey")
    first = j.where(~(k % 10).isin(7, 8)).select(
        F.concat(F.lit("c-"), k.cast("string")).alias("sys_id"), F.upper("s_name").alias("name"),
        F.col("n_name").alias("support_group"))
    dup = j.select(F.concat(F.lit("d-"), k.cast("string")).alias("sys_id"), F.lower("s_name").alias("name"),
                   F.col("n_name").alias("support_group"))
    return first.unionByName(dup)


O.cte("cmdb_services", """
SELECT 'c-' || CAST(s.s_suppkey AS VARCHAR) AS sys_id, upper(s.s_name) AS name, n.n_name AS support_group
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE s.s_suppkey % 10 NOT IN (7, 8)
UNION ALL
SELECT 'd-' || CAST(s.s_suppkey AS VARCHAR), lower(s.s_name), n.n_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")


@register("exact_match", O.build("""
WITH dedup AS (SELECT lower(name) AS k, max(sys_id) AS sys_id FROM cmdb_services WHERE name IS NOT NULL GROUP BY 1),
rec AS (SELECT d.k, c.sys_id, c.name, c.support_group FROM dedup d JOIN cmdb_services c ON c.sys_id = d.sys_id),
j AS (SELECT a.app_id, a.app_name, r.sys_id, r.name, r.support_group FROM app a JOIN rec r ON lower(a.app_name) = r.k
      WHERE a.monitoring_id IS NOT NULL AND a.app_name IS NOT NULL)
SELECT app_id, app_name, sys_id AS cmdb_id, name AS cmdb_name, support_group, CAST(100.0 AS DOUBLE) AS confidence_score FROM j
WHERE app_id = (SELECT MIN(j2.app_id) FROM j j2 WHERE j2.sys_id = j.sys_id)""", "cmdb_services", "app"))
def q_exact(spark, sf_dir):
    return R.exact_match(star(spark, sf_dir).app, cmdb_services(spark, sf_dir))


@register("recon_report", O.build("""
SELECT COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL AND cmdb_id IS NOT NULL) AS matched,
  COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL AND cmdb_id IS NULL) AS monitoring_only,
  COUNT(*) FILTER (WHERE monitoring_id IS NULL AND cmdb_id IS NOT NULL) AS cmdb_only,
  COUNT(*) AS total,
  ROUND(COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL AND cmdb_id IS NOT NULL) * 100.0
        / NULLIF(COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL), 0), 6) AS monitoring_match_rate,
  ROUND(COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL AND cmdb_id IS NOT NULL) * 100.0
        / NULLIF(COUNT(*) FILTER (WHERE cmdb_id IS NOT NULL), 0), 6) AS cmdb_match_rate,
  ROUND(COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL AND cmdb_id IS NOT NULL) * 100.0
        / NULLIF(COUNT(*), 0), 6) AS overall_match_rate
FROM app""", "app"))
def q_report(spark, sf_dir):
    return R.reconciliation_report(star(spark, sf_dir).app)


# the dimension before reconciliation: every supplier's further rows beside its application
O.cte("recon_app", f"""
SELECT app_id, monitoring_id, app_name, controller, cmdb_id, cmdb_name, h_code, sector_id, owner_id, architecture_id FROM app
UNION ALL
SELECT s_suppkey + {RECORD_IDS}, NULL, NULL, NULL, 'd-' || CAST(s_suppkey AS VARCHAR),
  CASE s_suppkey % 10 WHEN 7 THEN upper(s_name) ELSE ' ' || lower(s_name) || '  ' END,
  'HD' || CAST(s_suppkey AS VARCHAR), sector_id, CAST(s_suppkey % 2 + 1 AS INTEGER), 1
FROM supplier JOIN app ON app_id = s_suppkey + 1 WHERE s_suppkey % 10 IN (7, 8)
UNION ALL
SELECT s_suppkey + {COPY_IDS}, 'm2-' || CAST(s_suppkey AS VARCHAR), s_name, controller, NULL, NULL, h_code, sector_id, owner_id, architecture_id
FROM supplier JOIN app ON app_id = s_suppkey + 1 WHERE s_suppkey % 4 = 0 AND s_suppkey % 10 <> 9
UNION ALL
SELECT s_suppkey + {STALE_IDS}, NULL, NULL, NULL, 'c-' || CAST(s_suppkey AS VARCHAR), s_name, NULL, sector_id, owner_id, architecture_id
FROM supplier JOIN app ON app_id = s_suppkey + 1 WHERE s_suppkey % 10 = 6""", "app")
O.cte("recon_cost", f"""
SELECT * FROM cost UNION ALL
SELECT * REPLACE (app_id - 1 + {RECORD_IDS} AS app_id) FROM cost WHERE (app_id - 1) % 10 IN (7, 8) AND capability_id = 2""", "cost")

# R-M4/R-M5: of each name the lowest CMDB-only record against the unlinked applications of that name
O.cte("recon_pairs", """
SELECT x.app_id AS a_id, x.app_name AS a_name, r.app_id AS b_id, r.cmdb_name AS b_name,
  (SELECT min(h.app_id) FROM recon_app h WHERE h.monitoring_id IS NOT NULL AND h.cmdb_id = r.cmdb_id) AS holder,
  row_number() OVER (PARTITION BY r.app_id ORDER BY x.app_id) AS place
FROM recon_app x
JOIN recon_app r ON lower(trim(r.cmdb_name)) = lower(trim(x.app_name))
WHERE x.cmdb_id IS NULL AND r.monitoring_id IS NULL
  AND NOT EXISTS (SELECT 1 FROM recon_app s WHERE s.monitoring_id IS NULL AND s.app_id < r.app_id
    AND lower(trim(s.cmdb_name)) = lower(trim(r.cmdb_name)))""", "recon_app")


@register("recon_match_log", O.build("""
SELECT 'monitoring' AS source_a, 'cmdb' AS source_b, p.a_name AS match_key_a, p.b_name AS match_key_b,
  CAST(100 AS DOUBLE) AS confidence_score,
  CASE WHEN p.place = 1 AND p.holder IS NULL THEN 'auto_matched' ELSE 'conflict' END AS match_status,
  CASE WHEN p.place = 1 AND p.holder IS NULL THEN p.a_id END AS resolved_app_id,
  CASE WHEN p.place > 1 OR p.holder IS NOT NULL THEN 'CMDB record already matched to ' ||
    COALESCE((SELECT h.app_name FROM recon_app h WHERE h.app_id = p.holder),
             (SELECT f.a_name FROM recon_pairs f WHERE f.b_id = p.b_id AND f.place = 1), '?') END AS notes
FROM recon_pairs p""", "recon_app", "recon_pairs"))
def q_log(spark, sf_dir):
    """R-M5: the reconciliation log of the matching by equal names."""
    log, _ = R.reconcile(recon_applications(spark, sf_dir))
    return log.withColumn("confidence_score", F.col("confidence_score").cast("double"))


@register("recon_merged_apps", O.build("""
SELECT x.app_id, x.monitoring_id, x.app_name, x.controller,
  CASE WHEN p.b_id IS NULL THEN x.cmdb_id ELSE r.cmdb_id END AS cmdb_id,
  CASE WHEN p.b_id IS NULL THEN x.cmdb_name ELSE r.cmdb_name END AS cmdb_name,
  CASE WHEN p.b_id IS NULL THEN x.owner_id ELSE r.owner_id END AS owner_id,
  CASE WHEN p.b_id IS NULL THEN x.sector_id ELSE r.sector_id END AS sector_id,
  CASE WHEN p.b_id IS NULL THEN x.architecture_id ELSE r.architecture_id END AS architecture_id,
  CASE WHEN p.b_id IS NULL THEN x.h_code ELSE r.h_code END AS h_code
FROM recon_app x
LEFT JOIN (SELECT a_id, b_id FROM recon_pairs WHERE place = 1 AND holder IS NULL) p ON p.a_id = x.app_id
LEFT JOIN recon_app r ON r.app_id = p.b_id
WHERE x.app_id NOT IN (SELECT b_id FROM recon_pairs WHERE place = 1 AND holder IS NULL)""", "recon_app", "recon_pairs"))
def q_merged(spark, sf_dir):
    """R-M4: application dimension after merging matched CMDB records."""
    app = recon_applications(spark, sf_dir)
    _, id_map = R.reconcile(app)
    return R.merge_matches(app, id_map).select("app_id", "monitoring_id", "app_name", "controller", "cmdb_id", "cmdb_name",
                                               "owner_id", "sector_id", "architecture_id", "h_code")


@register("recon_stored_cost", O.build("""
SELECT c.ts, COALESCE(p.a_id, c.app_id) AS app_id, c.capability_id, c.tier, CAST(SUM(c.usd_cost) AS DOUBLE) AS usd_cost,
  MIN(c.price_id) AS price_id
FROM recon_cost c LEFT JOIN recon_pairs p ON p.b_id = c.app_id AND p.place = 1 AND p.holder IS NULL
GROUP BY 1, 2, 3, 4""", "recon_cost", "recon_pairs"))
def q_stored(spark, sf_dir):
    """R-M4 on a stored table: the months with merged records are rewritten, colliding keys add up."""
    table = Table(spark, scratch_path(spark, f"recon-cost-{uuid.uuid4().hex}"), PARTITION_COL, ["app_id"])
    table.append(recon_cost(star(spark, sf_dir).cost).withColumn(PARTITION_COL, F.trunc("ts", "MM")))
    _, id_map = R.reconcile(recon_applications(spark, sf_dir))
    R.repoint_table(table, id_map, [PARTITION_COL, *USAGE_KEY], ["usd_cost"])
    return table.read().select(*USAGE_KEY, F.col("usd_cost").cast("double").alias("usd_cost"), "price_id")


@register("enrichment_log", O.build("""
WITH dedup AS (SELECT lower(name) AS k, max(sys_id) AS sys_id FROM cmdb_services GROUP BY 1),
m AS (SELECT a.app_id, a.app_name, c.name, row_number() OVER (PARTITION BY c.sys_id ORDER BY a.app_id) AS place
      FROM app a JOIN dedup d ON lower(a.app_name) = d.k JOIN cmdb_services c USING (sys_id) WHERE a.monitoring_id IS NOT NULL)
SELECT app_name AS match_key_a, name AS match_key_b, app_id AS resolved_app_id,
  CASE WHEN (app_id - 1) % 4 = 0 THEN 2 ELSE 1 END AS entries FROM m WHERE place = 1""", "app", "cmdb_services"))
def q_enrichment_log(spark, sf_dir):
    """R-M7: the log after three runs; every fourth application gets another support group before the second."""
    app, feed = star(spark, sf_dir).app, cmdb_services(spark, sf_dir)
    other = feed.withColumn("support_group", F.when(F.substring("sys_id", 3, 20).cast("long") % 4 == 0, F.lit("moved"))
                            .otherwise(F.col("support_group")))
    log = None
    for run, services in enumerate((feed, other, other)):
        app, entries, _ = R.enrich(app, services, log)
        app, entries = cut_lineage(app), cut_lineage(entries.withColumn("logged_at", F.lit(run)))
        log = entries if log is None else log.unionAll(entries)
    return (log.groupBy("resolved_app_id").agg(F.min("match_key_a").alias("match_key_a"), F.min("match_key_b").alias("match_key_b"),
                                               F.count("*").cast("int").alias("entries"))
               .select("match_key_a", "match_key_b", "resolved_app_id", "entries"))


@register("enrichment_rate", O.build("""
WITH dedup AS (SELECT lower(name) AS k, max(sys_id) AS sys_id FROM cmdb_services GROUP BY 1),
m AS (SELECT MIN(a.app_id) AS app_id FROM app a JOIN dedup d ON lower(a.app_name) = d.k WHERE a.monitoring_id IS NOT NULL GROUP BY d.sys_id)
SELECT COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL) AS applications, COUNT(m.app_id) AS enriched,
  ROUND(COUNT(m.app_id) * 100.0 / NULLIF(COUNT(*) FILTER (WHERE monitoring_id IS NOT NULL), 0), 6) AS match_rate
FROM app LEFT JOIN m ON m.app_id = app.app_id""", "app", "cmdb_services"))
def q_enrichment_rate(spark, sf_dir):
    """R-M7: applications, enriched ones and the match rate."""
    return R.enrich(star(spark, sf_dir).app, cmdb_services(spark, sf_dir))[2]
