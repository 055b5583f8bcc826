"""Ingest jobs (S01-S09): nested usage payloads, application inventory, tags,
CMDB records, usage estimates and the calendar dimension.

All parsing is done with Spark's JSON functions and generators (``from_json``,
``inline``/``explode``); nothing is parsed in Python.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions import rules
from meterline.functions.timeutil import as_date
from meterline.session import bounded_broadcast

# --- fixed values ------------------------------------------------------------------
# Usage type reported by an agent -> capability code (R16: kept as data).
USAGE_TYPE_TO_CAPABILITY = {
    "APM_APP_AGENT": "APM",
    "APP_AGENT": "APM",
    "MACHINE_AGENT": "INFRA",
    "ANALYTICS_AGENT": "ANALYTICS",
    "BROWSER_RUM_AGENT": "MRUM",
    "MOBILE_RUM_AGENT": "MRUM",
    "SYNTHETIC_AGENT": "Synthetic",
    "DB_AGENT": "DB",
}
PEAK_PACKAGE_MARKER = "PEAK"
CMDB_RELATION_TYPE = "Depends on::Used by"
DEFAULT_OWNER_ID = 1
DEFAULT_SECTOR_ID = 1
# usage estimate
APM_UNITS_PER_NODE = 1.5
APM_BASE, APM_SPREAD = 0.9, 0.2
MRUM_UNITS_PER_TIER = 100
MRUM_BASE, MRUM_SPREAD = 0.8, 0.4
ESTIMATE_DAYS = 365
# ---------------------------------------------------------------------------------------

USAGE_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("accountId", T.LongType()),
    T.StructField("packages", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("unitUsages", T.ArrayType(T.StructType([
            T.StructField("usageType", T.StringType()),
            T.StructField("granularityInMinutes", T.IntegerType()),
            T.StructField("data", T.ArrayType(T.StructType([
                T.StructField("timestamp", T.StringType()),
                T.StructField("used", T.StructType([
                    T.StructField("avg", T.DoubleType()), T.StructField("max", T.DoubleType()),
                    T.StructField("min", T.DoubleType())])),
            ]))),
        ]))),
    ]))),
])


def _type_map() -> Column:
    return F.create_map(*[x for k, v in USAGE_TYPE_TO_CAPABILITY.items() for x in (F.lit(k), F.lit(v))])


def _utc_day(instant: Column) -> Column:
    """Midnight (UTC) of an instant, as TIMESTAMP_NTZ, independent of the session time zone:
    whole days since the epoch, added to 1970-01-01."""
    days = F.floor(F.unix_micros(instant) / F.lit(86_400_000_000)).cast("int")
    return F.date_add(F.lit(dt.date(1970, 1, 1)), days).cast("timestamp_ntz")


def flatten_usage_points(payload: DataFrame, payload_col: str = "payload") -> DataFrame:
    """S01 stage 1: one row per data point with its raw fields.

    A document that cannot be read, or that holds no data point, leaves one row with
    ``fault`` set and its text in ``payload``.
    """
    doc = payload.select(F.col(payload_col).alias("raw"), F.from_json(F.col(payload_col), USAGE_PAYLOAD_SCHEMA).alias("d"))
    pk = doc.select("raw", F.col("d.accountId").alias("account_id"), F.col("d.packages").isNull().alias("bad"),
                    F.explode_outer("d.packages").alias("p"))
    uu = pk.select("raw", "account_id", "bad", F.col("p.name").alias("package"), F.explode_outer("p.unitUsages").alias("u"))
    pt = uu.select("raw", "account_id", "bad", "package", F.col("u.usageType").alias("usage_type"),
                   F.explode_outer("u.data").alias("x"))
    fault = F.when(F.col("bad"), F.lit("bad_document")).when(F.col("x").isNull(), F.lit("no_usage"))
    return pt.select("account_id", "package", "usage_type", F.col("x.timestamp").alias("timestamp"),
                     F.col("x.used.avg").alias("avg"), fault.alias("fault"),
                     F.when(fault.isNotNull(), F.col("raw")).alias("payload"))


def flatten_usage_payload(payload: DataFrame, capabilities: DataFrame, payload_col: str = "payload"):
    """Nested licence usage -> (account_id, ts, capability_code, tier, units) and rejects.

    Package name -> tier ('Peak' if it mentions PEAK), usage type -> capability
    (only seeded capabilities), avg = 0/missing skipped (documents that cannot be read or hold no
    data point are rejects too, with their text), unparsable timestamps
    skipped, timestamps truncated to the UTC day.
    """
    pts = flatten_usage_points(payload, payload_col)
    code = F.element_at(_type_map(), F.col("usage_type"))
    parsed = F.try_to_timestamp(F.col("timestamp"))
    x = pts.select("account_id",
                   F.when(F.upper(F.coalesce(F.col("package"), F.lit(""))).contains(PEAK_PACKAGE_MARKER),
                          F.lit("Peak")).otherwise(F.lit("Pro")).alias("tier"),
                   "usage_type", code.alias("capability_code"),
                   _utc_day(parsed).alias("ts"),
                   F.coalesce(F.col("avg"), F.lit(0.0)).alias("units"), "fault", "payload")
    known = bounded_broadcast(capabilities.select(F.col("capability_code").alias("_cc")), capabilities)
    x = x.join(known, F.col("capability_code") == F.col("_cc"), "left")
    ok = F.col("fault").isNull() & F.col("_cc").isNotNull() & (F.col("units") != 0) & F.col("ts").isNotNull()
    good = x.where(ok).select("account_id", "ts", "capability_code", "tier", "units")
    rejects = x.where(~ok).select(
        "account_id", "usage_type", "ts", "units",
        F.when(F.col("fault").isNotNull(), F.col("fault"))
         .when(F.col("_cc").isNull(), F.lit("unmapped_usage_type"))
         .when(F.col("ts").isNull(), F.lit("bad_timestamp")).otherwise(F.lit("zero_usage")).alias("reason"),
        "payload")
    return good, rejects


def tags_to_map(tags: Column) -> Column:
    """array<struct<name,value>> -> map; unnamed tags dropped, later duplicates win
    (session sets ``spark.sql.mapKeyDedupPolicy=LAST_WIN``)."""
    kept = F.filter(tags, lambda t: t["name"].isNotNull() & (t["name"] != ""))
    # keep only the last entry per name, so the result does not depend on the
    # session's map key dedup policy
    last = F.filter(kept, lambda t, i: ~F.exists(F.slice(kept, i + 2, F.size(kept) + 1),
                                                  lambda u: u["name"] == t["name"]))
    return F.map_from_entries(F.transform(last, lambda t: F.struct(t["name"].alias("key"), t["value"].alias("value"))))


def node_counts(apps: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node count per application, 0 when it has none."""
    n = nodes.groupBy("app_key").agg(F.count(F.lit(1)).alias("node_count"))
    return apps.join(n, "app_key", "left").withColumn("node_count", F.coalesce(F.col("node_count"), F.lit(0)))


def application_inventory(apps: DataFrame, nodes: DataFrame) -> DataFrame:
    """(app_key, controller, name, description, tiers, tags) + nodes -> application rows.

    Derived: tier_count = size(tiers), node_count (S04), architecture name (P02),
    licence tier (P01), h_code from tags (P03/P04), metadata as a typed struct.
    """
    a = node_counts(apps, nodes)
    tags = tags_to_map(F.col("tags"))
    return a.select(
        F.col("app_key").cast("string").alias("monitoring_id"),
        "controller",
        rules.safe_truncate("name", 255).alias("app_name"),
        F.coalesce(F.size("tiers"), F.lit(0)).alias("tier_count"),
        "node_count",
        rules.architecture_name(F.coalesce(F.size("tiers"), F.lit(0)), F.col("node_count")).alias("architecture"),
        rules.license_tier("name", "description").alias("license_tier"),
        rules.safe_truncate(rules.hcode_from_tags(tags), 50).alias("h_code"),
        F.struct(F.col("description").alias("description"),
                 F.coalesce(F.size("tiers"), F.lit(0)).alias("tier_count"),
                 F.col("node_count").alias("node_count")).alias("metadata"),
        F.lit(DEFAULT_OWNER_ID).alias("owner_id"), F.lit(DEFAULT_SECTOR_ID).alias("sector_id"))


#: an object of text fields without escapes that begins with its id, the other fields being neither of the two ids
FLAT_FIELD = r'^\{"(?:value|sys_id)":"[^"\\]*+"(?:,"(?!value"|sys_id")[^"\\]++":"[^"\\]*+")*+\}$'


def cmdb_field(c: Column) -> Column:
    """A CMDB field is a plain string or a {value, sys_id} object.

    Only text with a brace can be an object; plain text is not parsed, since a failed parse costs
    many times a good one.  Flat objects are cut at their quotes, which costs less than a parse; all others
    are parsed.
    """
    s = c.cast("string")
    first = F.substring_index(F.substring_index(s, '"', 4), '"', -1)                      # text of a flat object's first field
    parsed = F.coalesce(F.get_json_object(s, "$.value"), F.get_json_object(s, "$.sys_id"), s)
    return F.when(~s.contains("{"), s).when(s.rlike(FLAT_FIELD), first).otherwise(parsed)


def resolved_relations(relations: DataFrame) -> DataFrame:
    """(parent, child, type) of the relations of the wanted type that name both ends.

    A field is null only if its raw one is, so the ends are checked raw, and the resolved ones are declared
    not null: joins on them then infer no further check that would parse every record once more.  Servers
    and edges start from this same frame and shuffle it by ``parent``, so that one plan resolves the
    relations and shuffles them once.
    """
    r = relations.where(F.col("parent").isNotNull() & F.col("child").isNotNull()
                        & (cmdb_field(F.col("type")) == CMDB_RELATION_TYPE))
    return r.select(*[F.coalesce(cmdb_field(F.col(c)), F.lit("")).alias(c) for c in ("parent", "child")],
                    F.lit(CMDB_RELATION_TYPE).alias("type"))


def servers_for_matched_apps(relations: DataFrame, servers: DataFrame, matched_apps: DataFrame) -> DataFrame:
    """Servers that matched apps depend on (relation type filter), upsert-ready rows.

    An empty id becomes null: a check for "" would be inferred for the relations' ends as well, and parse
    every record below their distinct.  Joins build hash tables of the shuffled smaller side; the
    relations are not sorted.
    """
    matched = matched_apps.select(F.col("cmdb_id").alias("parent")).hint("shuffle_hash")
    r = resolved_relations(relations).join(matched, "parent", "left_semi")
    children = r.select(F.col("child").alias("sys_id")).distinct().hint("shuffle_hash")
    sid = cmdb_field(F.col("sys_id"))
    s = servers.select(F.when(sid != "", sid).alias("sys_id"), cmdb_field(F.col("name")).alias("server_name"),
                       cmdb_field(F.col("ip_address")).alias("ip_address"), cmdb_field(F.col("os")).alias("os"),
                       rules.loose_bool(cmdb_field(F.col("virtual"))).alias("is_virtual"))
    s = s.where(F.col("sys_id").isNotNull() & F.col("server_name").isNotNull() & (F.col("server_name") != ""))
    return s.join(children, "sys_id", "left_semi").dropDuplicates(["sys_id"])


def app_server_edges(relations: DataFrame, app: DataFrame, servers: DataFrame) -> DataFrame:
    """(app_id, server sys id) edges, both ends resolved by id, with the one type that is resolved.

    Distinct ids need no sort; a first type of each pair, a string, would make Spark sort them.
    """
    r = resolved_relations(relations)
    a = app.where(F.col("cmdb_id").isNotNull()).select("app_id", F.col("cmdb_id").alias("parent")).hint("shuffle_hash")
    s = servers.select(F.col("sys_id").alias("child")).hint("shuffle_hash")
    return (r.join(a, "parent").join(s, "child")
             .select("app_id", F.col("child").alias("server_sys_id")).distinct()
             .select("*", F.lit(CMDB_RELATION_TYPE).alias("relationship_type")))


def usage_estimate(apps: DataFrame, as_of, capabilities: DataFrame) -> DataFrame:
    """Deterministic daily usage per app for the ESTIMATE_DAYS days up to as_of (inclusive).

    apps: (app_id, tier_count, node_count, license_tier). APM units scale with
    nodes, MRUM with tiers; ``nodes_count`` holds nodes for APM and tiers for MRUM.
    """
    end = as_date(as_of)
    start = end - dt.timedelta(days=ESTIMATE_DAYS)
    days = apps.select("*", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))
    k = (F.dayofmonth("d") % 7).cast("double")
    apm = F.round(F.col("node_count") * F.lit(APM_UNITS_PER_NODE)
                  * (F.lit(APM_BASE) + F.lit(APM_SPREAD) * k / 7), 2)
    mrum = F.round(F.col("tier_count") * F.lit(MRUM_UNITS_PER_TIER)
                   * (F.lit(MRUM_BASE) + F.lit(MRUM_SPREAD) * k / 7), 2)
    caps = bounded_broadcast(capabilities.select("capability_id", "capability_code"), capabilities)
    rows = days.select(F.col("d").cast("timestamp_ntz").alias("ts"), "app_id", F.col("license_tier").alias("tier"),
                       F.inline(F.array(
                           F.struct(F.lit("APM").alias("capability_code"), apm.alias("units"),
                                    F.col("node_count").alias("nodes_count")),
                           F.struct(F.lit("MRUM").alias("capability_code"), mrum.alias("units"),
                                    F.col("tier_count").alias("nodes_count")))))
    return rows.join(caps, "capability_code").select("ts", "app_id", "capability_id", "tier",
                                                      F.col("units").alias("units_consumed"), "nodes_count")


def calendar_of(dates: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """S09 from a column of dates (e.g. a sequence exploded from data bounds)."""
    d = F.col("date_value")
    iso_dow = ((F.dayofweek(d) + 5) % 7 + 1)
    shifted = F.add_months(d, 12 - fiscal_start_month + 1) if fiscal_start_month != 1 else d
    return dates.select(
        "date_value", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"), iso_dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), (iso_dow >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.year(shifted).alias("fiscal_year"), F.quarter(shifted).alias("fiscal_quarter"),
        F.month(shifted).alias("fiscal_period"))
