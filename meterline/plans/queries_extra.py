"""Registered queries: CMDB servers and edges (S05-S06b), latest runs (L03),
active tool list (A12), numeric id suffix (P14), metadata merge (P12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.plans import oracle as O
from meterline.plans import quality as Q
from meterline.plans.queries_quality import run_events
from meterline.plans.registry import ORACLE, register, star
from meterline.sources import ingest as IG
from meterline.sources.tables import read


def cmdb_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relation records: each (supplier, part) pair of lineitem is an app -> server relation.
    Fields alternate between plain strings and {value, link} objects (S05)."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    as_obj = F.col("l_partkey") % 2 == 0

    def field(prefix, key, is_obj):     # {"value": ..., "link": "rel"}; ids need no escapes, and a null id leaves no value
        sid, head = F.concat(F.lit(prefix), F.col(key).cast("string")), F.lit('{"value":"')
        text = F.when(is_obj, F.concat(head, sid, F.lit('","link":"rel"}'))).otherwise(sid)
        return F.when(F.col(key).isNotNull(), F.coalesce(text, F.lit(""))).when(is_obj, F.lit('{"link":"rel"}'))
    return li.select(
        field("c-", "l_suppkey", as_obj).alias("parent"),
        field("s-", "l_partkey", ~as_obj).alias("child"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit("Runs on::Hosts")).otherwise(F.lit(IG.CMDB_RELATION_TYPE))
         .alias("type"))


def cmdb_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    sid = F.concat(F.lit("s-"), F.col("p_partkey").cast("string"))
    virt = (F.when(F.col("p_size") % 4 == 0, F.lit("true")).when(F.col("p_size") % 4 == 1, F.lit("yes"))
             .when(F.col("p_size") % 4 == 2, F.lit("0")).otherwise(F.lit("False")))
    return p.select(
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('{"sys_id":"'), sid, F.lit('"}'))).otherwise(sid).alias("sys_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("10.0."), (F.col("p_partkey") % 250).cast("string"), F.lit("."),
                 F.col("p_size").cast("string")).alias("ip_address"),
        F.col("p_brand").alias("os"), virt.alias("virtual"))


def _matched(spark, sf_dir):
    return star(spark, sf_dir).app.where(F.col("monitoring_id").isNotNull() & F.col("cmdb_id").isNotNull())


O.cte("s06_rel", """
SELECT DISTINCT 'c-' || CAST(l_suppkey AS VARCHAR) AS parent, 's-' || CAST(l_partkey AS VARCHAR) AS child,
  CASE WHEN l_partkey % 7 = 0 THEN 'Runs on::Hosts' ELSE 'Depends on::Used by' END AS type
FROM lineitem""")
O.cte("s06_servers", """
SELECT DISTINCT 's-' || CAST(p.p_partkey AS VARCHAR) AS sys_id, p.p_name AS server_name,
  '10.0.' || CAST(p.p_partkey % 250 AS VARCHAR) || '.' || CAST(p.p_size AS VARCHAR) AS ip_address,
  p.p_brand AS os, p.p_size % 4 IN (0, 1) AS is_virtual
FROM part p
WHERE 's-' || CAST(p.p_partkey AS VARCHAR) IN (
  SELECT r.child FROM s06_rel r JOIN app a ON a.cmdb_id = r.parent
  WHERE r.type = 'Depends on::Used by' AND a.monitoring_id IS NOT NULL)""", "app", "s06_rel")


@register("cmdb_servers", O.build("SELECT * FROM s06_servers", "s06_servers"))
def q_servers(spark, sf_dir):
    return IG.servers_for_matched_apps(cmdb_relations(spark, sf_dir), cmdb_servers(spark, sf_dir),
                                       _matched(spark, sf_dir))


@register("app_server_edges", O.build("""
SELECT DISTINCT a.app_id, r.child AS server_sys_id, COALESCE(r.type, 'Unknown') AS relationship_type
FROM s06_rel r JOIN app a ON a.cmdb_id = r.parent
WHERE r.type = 'Depends on::Used by' AND r.child IN (SELECT sys_id FROM s06_servers)""", "app", "s06_servers", "s06_rel"))
def q_edges(spark, sf_dir):
    servers = IG.servers_for_matched_apps(cmdb_relations(spark, sf_dir), cmdb_servers(spark, sf_dir),
                                          _matched(spark, sf_dir))
    return IG.app_server_edges(cmdb_relations(spark, sf_dir), star(spark, sf_dir).app, servers)


O.cte("runs_state", """
SELECT o_orderkey AS run_id, o_orderpriority AS job_name, o_orderdate AS started_at,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status
FROM orders""")


@register("a12_active_tools", O.build("""
SELECT string_agg(r.r_name, ', ' ORDER BY r.r_name) AS active_tools, COUNT(*) AS active_count
FROM region r WHERE EXISTS (SELECT 1 FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey
                            WHERE n.n_regionkey = r.r_regionkey)"""))
def q_active_tools(spark, sf_dir):
    """A12 over a tool-configuration table: each region is a monitoring tool (controller),
    active when it monitors at least one application. The list comes from a configuration
    table, so the collected group is bounded by the number of tools."""
    r = read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("tool_name"))
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    s = read(spark, sf_dir, "supplier").select("s_nationkey")
    monitored = n.join(s, n.n_nationkey == s.s_nationkey, "left_semi").select(F.col("n_regionkey").alias("r_regionkey"))
    a = r.join(monitored, "r_regionkey", "left_semi")
    return a.agg(F.concat_ws(", ", F.sort_array(F.collect_list("tool_name"))).alias("active_tools"),
                 F.count(F.lit(1)).alias("active_count"))


@register("p14_id_suffix", O.build("""
SELECT MAX(TRY_CAST(substring(s_name, 10) AS INTEGER)) AS max_suffix,
  COUNT(TRY_CAST(substring(s_name, 10) AS INTEGER)) AS numeric_ids FROM supplier"""))
def q_suffix(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(rules.id_suffix_number("s_name", 10).alias("n"))
    return s.agg(F.max("n").alias("max_suffix"), F.count("n").alias("numeric_ids"))


@register("p12_metadata_merge", O.build("""
SELECT s.s_suppkey + 1 AS app_id, COALESCE(n.n_name, 'supplier') AS description,
  COALESCE(CAST(NULL AS INTEGER), CAST(s.s_nationkey % 5 AS INTEGER)) AS tier_count,
  CAST(s.s_suppkey % 9 AS INTEGER) AS node_count
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""))
def q_metadata(spark, sf_dir):
    """The stored metadata (description 'supplier', tiers, nodes) merged with a newer
    partial record (nation as description, nodes) -- new fields win, missing ones keep the old value."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    old = F.struct(F.lit("supplier").alias("description"), (F.col("s_nationkey") % 5).cast("int").alias("tier_count"),
                   F.lit(0).alias("node_count"))
    new = F.struct(F.col("n_name").alias("description"), F.lit(None).cast("int").alias("tier_count"),
                   (F.col("s_suppkey") % 9).cast("int").alias("node_count"))
    m = j.select((F.col("s_suppkey") + 1).alias("app_id"), rules.merge_metadata_struct(old, new).alias("m"))
    return m.select("app_id", "m.description", "m.tier_count", "m.node_count")


def inventory_sources(spark: SparkSession, sf_dir: str):
    """Application inventory payload pieces from the driver tables: one app per supplier with
    its nation as description, the set of capabilities it serves as tiers and supplier tags;
    one node per (supplier, line number) seen in lineitem."""
    from meterline.plans.queries_ingest import supplier_tags
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    tiers = (li.join(p, li.l_partkey == p.p_partkey)
               .groupBy(F.col("l_suppkey").alias("s_suppkey"))
               .agg(F.array_sort(F.collect_set((F.col("p_size") % 5 + 1).cast("string"))).alias("tiers")))
    tags = supplier_tags(spark, sf_dir).select((F.col("app_id") - 1).alias("s_suppkey"), "tags")
    apps = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .join(tiers, "s_suppkey", "left").join(tags, "s_suppkey", "left")
             .select(F.col("s_suppkey").alias("app_key"), F.col("r_name").alias("controller"),
                     F.col("s_name").alias("name"), F.col("n_name").alias("description"), "tiers", "tags"))
    nodes = li.select(F.col("l_suppkey").alias("app_key"), "l_linenumber").distinct()
    return apps, nodes


@register("app_inventory", O.build("""
WITH t AS (SELECT l.l_suppkey, COUNT(DISTINCT p.p_size % 5 + 1) AS tier_count
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1),
nd AS (SELECT l_suppkey, COUNT(DISTINCT l_linenumber) AS node_count FROM lineitem GROUP BY 1)
SELECT CAST(s.s_suppkey AS VARCHAR) AS monitoring_id, r.r_name AS controller, s.s_name AS app_name,
  CAST(COALESCE(t.tier_count, 0) AS INTEGER) AS tier_count, COALESCE(nd.node_count, 0) AS node_count,
  CASE WHEN COALESCE(t.tier_count, 0) >= 4 OR (COALESCE(t.tier_count, 0) >= 2 AND COALESCE(nd.node_count, 0) >= 10)
       THEN 'Microservices' ELSE 'Monolithic' END AS architecture,
  CASE WHEN regexp_matches(lower(concat_ws(chr(10), s.s_name, n.n_name)), 'prod|critical|enterprise|premium')
       THEN 'Peak' ELSE 'Pro' END AS license_tier,
  COALESCE(NULLIF(CASE WHEN s.s_suppkey % 5 = 0 THEN 'H5-' || CAST(s.s_suppkey AS VARCHAR)
                       WHEN s.s_suppkey % 3 = 0 THEN 'H-' || CAST(s.s_suppkey AS VARCHAR) END, ''),
           NULLIF(CASE WHEN s.s_suppkey % 4 = 0 THEN '' ELSE 'HC' || CAST(s.s_nationkey AS VARCHAR) END, ''),
           NULLIF('X' || CAST(n.n_regionkey AS VARCHAR), '')) AS h_code,
  n.n_name AS metadata_description, 1 AS owner_id, 1 AS sector_id
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN t ON t.l_suppkey = s.s_suppkey LEFT JOIN nd ON nd.l_suppkey = s.s_suppkey"""))
def q_inventory(spark, sf_dir):
    """S02 + S03 + S04: application rows derived from the inventory payload."""
    apps, nodes = inventory_sources(spark, sf_dir)
    inv = IG.application_inventory(apps, nodes)
    return inv.select("monitoring_id", "controller", "app_name", "tier_count", "node_count", "architecture",
                      "license_tier", "h_code", F.col("metadata.description").alias("metadata_description"),
                      "owner_id", "sector_id")


def inventory_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that knows two of three suppliers, enriched (owner and sector set), and a CMDB-only row of each fifth."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("s_suppkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    known = j.where(k % 3 != 0).select(
        (k + 1).alias("app_id"), k.cast("string").alias("monitoring_id"), F.col("r_name").alias("controller"),
        F.concat(F.lit("old "), F.col("s_name")).alias("app_name"), F.lit("Unknown").alias("architecture"),
        F.lit("Pro").alias("license_tier"), F.lit("H-OLD").alias("h_code"),
        (k % 3 + 2).cast("int").alias("owner_id"), F.when(k % 7 != 0, (k % 7).cast("int")).alias("sector_id"),
        F.concat(F.lit("c-"), k.cast("string")).alias("cmdb_id"),
        F.struct(F.lit("old").alias("description"), F.lit(9).alias("tier_count"), F.lit(9).alias("node_count")).alias("metadata"))
    only = j.where(k % 5 == 0).select(
        (k + 1_000_000).alias("app_id"), *[F.lit(None).cast("string").alias(c) for c in ("monitoring_id", "controller", "app_name", "architecture",
                                                                                       "license_tier", "h_code")],
        F.lit(3).alias("owner_id"), F.lit(2).alias("sector_id"), F.concat(F.lit("d-"), k.cast("string")).alias("cmdb_id"),
        F.lit(None).cast("struct<description:string,tier_count:int,node_count:int>").alias("metadata"))
    return known.unionByName(only)


@register("app_inventory_upsert", O.build(f"""
WITH feed AS ({ORACLE["app_inventory"]}),
fresh AS (SELECT *, row_number() OVER (ORDER BY monitoring_id, controller) AS place FROM feed WHERE CAST(monitoring_id AS BIGINT) % 3 = 0),
top AS (SELECT greatest(max(s_suppkey + 1) FILTER (WHERE s_suppkey % 3 <> 0), max(s_suppkey + 1000000) FILTER (WHERE s_suppkey % 5 = 0)) AS id FROM supplier)
SELECT CAST(monitoring_id AS BIGINT) + 1 AS app_id, monitoring_id, controller, app_name, architecture, license_tier, h_code,
  CAST(CAST(monitoring_id AS BIGINT) % 3 + 2 AS INTEGER) AS owner_id, CAST(NULLIF(CAST(monitoring_id AS BIGINT) % 7, 0) AS INTEGER) AS sector_id,
  'c-' || monitoring_id AS cmdb_id, metadata_description, node_count
FROM feed WHERE CAST(monitoring_id AS BIGINT) % 3 <> 0
UNION ALL
SELECT top.id + place, monitoring_id, controller, app_name, architecture, license_tier, h_code, 1, 1, NULL, metadata_description, node_count
FROM fresh, top
UNION ALL
SELECT s_suppkey + 1000000, NULL, NULL, NULL, NULL, NULL, NULL, 3, 2, 'd-' || CAST(s_suppkey AS VARCHAR), NULL, NULL
FROM supplier WHERE s_suppkey % 5 = 0"""))
def q_inventory_upsert(spark, sf_dir):
    """The feed over an enriched dimension; set owners and sectors stay, new applications get the next ids."""
    from meterline.operators.inventory import upsert_inventory
    apps, nodes = inventory_sources(spark, sf_dir)
    out = upsert_inventory(inventory_before(spark, sf_dir), IG.application_inventory(apps, nodes))
    return out.select("app_id", "monitoring_id", "controller", "app_name", "architecture", "license_tier", "h_code", "owner_id",
                      "sector_id", "cmdb_id", F.col("metadata.description").alias("metadata_description"),
                      F.col("metadata.node_count").cast("long").alias("node_count"))


@register("recon_repointed_cost", O.build("""
SELECT COALESCE(p.a_id, c.app_id) AS app_id, CAST(SUM(c.usd_cost) AS DOUBLE) AS usd_cost, COUNT(*) AS cost_rows
FROM recon_cost c LEFT JOIN recon_pairs p ON p.b_id = c.app_id AND p.place = 1 AND p.holder IS NULL
GROUP BY 1""", "recon_cost", "recon_pairs"))
def q_repointed(spark, sf_dir):
    """R-M4: cost per app after the merged CMDB-only rows' facts move to the surviving app."""
    from meterline.operators import reconcile as R
    from meterline.sources.star import recon_applications, recon_cost
    _, id_map = R.reconcile(recon_applications(spark, sf_dir))
    moved = R.repoint_fact(recon_cost(star(spark, sf_dir).cost), id_map)
    return (moved.groupBy("app_id").agg(F.sum("usd_cost").cast("double").alias("usd_cost"),
                                        F.count(F.lit(1)).alias("cost_rows")))
