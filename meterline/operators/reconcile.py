"""Application name reconciliation by exact keys (J12, R-M4 to R-M7).

Applications without a CMDB link meet CMDB-only records of the same name, whatever its case and
the blanks around it: an equi join.  Names that differ otherwise never match.  The record side
is reduced to one row per name, so no pair is ever scored; AQE splits a hot name's applications.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
SOURCE_A = "monitoring"
SOURCE_B = "cmdb"

# ---------------------------------------------------------------------------------


def name_key(c: str) -> Column:
    """Name in lower case, without blanks around it."""
    return F.lower(F.trim(F.col(c)))


def unmatched_sides(app: DataFrame):
    """Apps with a monitoring name but no CMDB link; CMDB-only records (no monitoring id)."""
    a = (app.where(F.col("cmdb_id").isNull() & F.col("app_name").isNotNull())
            .select(F.col("app_id").alias("a_id"), F.col("app_name").alias("a_name")))
    b = (app.where(F.col("monitoring_id").isNull() & F.col("cmdb_name").isNotNull())
            .select(F.col("app_id").alias("b_id"), F.col("cmdb_id").alias("b_cmdb_id"),
                    F.col("cmdb_name").alias("b_name")))
    # R-M5 (ruling R2): a record is claimed when its CMDB id is already held by a monitored app
    holders = (app.where(F.col("monitoring_id").isNotNull() & F.col("cmdb_id").isNotNull())
                  .groupBy(F.col("cmdb_id").alias("b_cmdb_id"))
                  .agg(F.min_by("app_name", "app_id").alias("claimed_by")))
    b = b.join(holders, "b_cmdb_id", "left").withColumn("b_claimed", F.col("claimed_by").isNotNull())
    return a, b


def reconcile(app: DataFrame):
    """Reconciliation on exact keys: (log, id_map). ``log`` has the reconciliation_log columns.

    A key's record is the one with the lowest id; its lowest application is matched, every
    other one is a conflict, as is each application of a record that is already claimed.
    """
    a, b = unmatched_sides(app)
    a = a.withColumn("k", name_key("a_name"))
    record = F.struct("b_id", "b_name", "b_claimed", "claimed_by")
    b = (b.withColumn("k", name_key("b_name")).groupBy("k").agg(F.min_by(record, "b_id").alias("r"))
          .select("k", "r.*"))
    first = a.groupBy("k").agg(F.min_by(F.struct("a_id", "a_name"), "a_id").alias("w"))
    d = (a.join(b.join(first, "k"), "k")
          .withColumn("match_status", F.when(~F.col("b_claimed") & (F.col("a_id") == F.col("w.a_id")), F.lit("auto_matched"))
                      .otherwise(F.lit("conflict"))))
    holder = F.when(F.col("b_claimed"), F.col("claimed_by")).otherwise(F.col("w.a_name"))
    log = d.select(F.lit(SOURCE_A).alias("source_a"), F.lit(SOURCE_B).alias("source_b"),
                   F.col("a_name").alias("match_key_a"), F.col("b_name").alias("match_key_b"),
                   F.lit(100).cast("decimal(5,2)").alias("confidence_score"), "match_status",
                   F.when(F.col("match_status") == "auto_matched", F.col("a_id")).alias("resolved_app_id"),
                   F.when(F.col("match_status") == "conflict",
                          F.concat(F.lit("CMDB record already matched to "), F.coalesce(holder, F.lit("?"))))
                    .alias("notes"))
    id_map = (d.where(F.col("match_status") == "auto_matched")
               .select(F.col("b_id").alias("old_app_id"), F.col("a_id").alias("new_app_id")))
    return log, id_map


def merge_matches(app: DataFrame, id_map: DataFrame) -> DataFrame:
    """R-M4: copy the CMDB attributes onto the matched app and drop the CMDB-only row."""
    cm = (app.join(id_map, F.col("app_id") == F.col("old_app_id"))
             .select(F.col("new_app_id").alias("app_id"),
                     *[F.col(c).alias(f"_m_{c}") for c in ("cmdb_id", "cmdb_name", "owner_id", "sector_id",
                                                           "architecture_id", "h_code", "support_group")]))
    out = app.join(id_map.select("old_app_id"), F.col("app_id") == F.col("old_app_id"), "left_anti") \
             .join(cm, "app_id", "left")
    for c in ("cmdb_id", "cmdb_name", "owner_id", "sector_id", "architecture_id", "h_code", "support_group"):
        out = out.withColumn(c, F.when(F.col(f"_m_{c}").isNotNull() | F.col("_m_cmdb_id").isNotNull(),
                                       F.col(f"_m_{c}")).otherwise(F.col(c)))
    return out.drop(*[c for c in out.columns if c.startswith("_m_")])


def repoint_fact(fact: DataFrame, id_map: DataFrame) -> DataFrame:
    """R-M4: move fact rows of a dropped CMDB-only app to the surviving app id."""
    m = id_map.select(F.col("old_app_id").alias("_old"), F.col("new_app_id").alias("_new"))
    return (fact.join(m, F.col("app_id") == F.col("_old"), "left")
                .withColumn("app_id", F.coalesce(F.col("_new"), F.col("app_id")))
                .drop("_old", "_new"))


def repointed(fact: DataFrame, id_map: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """``repoint_fact`` with a unique key afterwards: rows that meet on ``keys`` become one.

    Measures add up; of other columns the row that stood under the surviving id wins.  Rows of applications
    that no merge names pass by the grouping.
    """
    ids = id_map.select(F.explode(F.array("old_app_id", "new_app_id")).alias("app_id")).distinct()
    moved = repoint_fact(fact.join(ids, "app_id", "left_semi").withColumn("_came", F.col("app_id")), id_map)
    moved = moved.withColumn("_came", F.col("_came") != F.col("app_id"))
    others = [c for c in fact.columns if c not in keys and c not in measures]
    joined = moved.groupBy(*keys).agg(*[F.sum(c).cast(fact.schema[c].dataType).alias(c) for c in measures],
                                      *[F.min_by(c, F.struct("_came", c)).alias(c) for c in others])
    return fact.join(ids, "app_id", "left_anti").unionByName(joined.select(*fact.columns))


def repoint_table(table, id_map: DataFrame, keys: list[str], measures: list[str]) -> list:
    """R-M4 on a stored fact (a ``versions.Table``): rewrites the partitions that hold a dropped id, and no other.

    Returns those partitions.  They are found by the id column alone; the new version shows all of them at once.
    """
    from meterline.session import cut_lineage
    id_map = cut_lineage(id_map.select("old_app_id", "new_app_id"))
    by = table.partition_by
    holding = table.read().select("app_id", by).join(id_map.select(F.col("old_app_id").alias("app_id")), "app_id", "left_semi")
    parts = [r[0] for r in holding.select(by).distinct().collect()]                       # partition values
    if parts:
        table.rewrite(parts, lambda fact: repointed(fact, id_map, keys, measures))
    return sorted(parts, key=str)


def exact_match(app: DataFrame, services: DataFrame) -> DataFrame:
    """J12 / R-M7: case-insensitive exact name match of apps to CMDB service records.

    services: (sys_id, name, support_group). For duplicate names the record
    with the greatest sys_id wins ("last record wins" with a defined order);
    a CMDB id is given to one app only (the lowest app_id).
    """
    s = (services.where(F.col("name").isNotNull())
                 .groupBy(F.lower("name").alias("k"))
                 .agg(F.max_by(F.struct("sys_id", "name", "support_group"), F.col("sys_id")).alias("r"))
                 .select("k", "r.sys_id", "r.name", "r.support_group"))
    a = app.where(F.col("monitoring_id").isNotNull() & F.col("app_name").isNotNull()) \
           .select("app_id", "app_name", F.lower("app_name").alias("k"))
    j = a.join(s, "k")
    first = j.groupBy("sys_id").agg(F.min("app_id").alias("app_id"))
    return (j.join(first, ["sys_id", "app_id"])
             .select("app_id", "app_name", F.col("sys_id").alias("cmdb_id"), F.col("name").alias("cmdb_name"),
                     "support_group", F.lit(100.0).alias("confidence_score")))


def reconciliation_report(app: DataFrame) -> DataFrame:
    """R-M6 / Q02: matched, monitoring-only, CMDB-only, total and match rates (one pass)."""
    mon, cmdb = F.col("monitoring_id").isNotNull(), F.col("cmdb_id").isNotNull()
    g = app.agg(F.count_if(mon & cmdb).alias("matched"), F.count_if(mon & ~cmdb).alias("monitoring_only"),
                F.count_if(~mon & cmdb).alias("cmdb_only"), F.count(F.lit(1)).alias("total"),
                F.count_if(mon).alias("_mon"), F.count_if(cmdb).alias("_cmdb"))
    return g.select("matched", "monitoring_only", "cmdb_only", "total",
                    F.round(F.try_divide(F.col("matched") * 100.0, F.col("_mon")), 6).alias("monitoring_match_rate"),
                    F.round(F.try_divide(F.col("matched") * 100.0, F.col("_cmdb")), 6).alias("cmdb_match_rate"),
                    F.round(F.try_divide(F.col("matched") * 100.0, F.col("total")), 6).alias("overall_match_rate"))


#: what the enrichment writes on a matched application
ENRICHED = ("cmdb_id", "cmdb_name", "support_group")
LOG_SCHEMA = ("source_a string, source_b string, match_key_a string, match_key_b string, confidence_score decimal(5,2), "
              "match_status string, resolved_app_id long, state_hash long")


def enrich(app: DataFrame, services: DataFrame, log: DataFrame | None = None):
    """R-M7: (enriched applications, new log rows, match rate) of the exact name match.

    A matched application takes the record's id, name and support group; the others stay as they are.
    Its log entry carries a hash of all that; only entries whose hash differs from the newest one
    of the application are new, so that a run that changes nothing logs nothing.  ``log``: the entries so
    far with ``logged_at`` (any ordered type), or None.
    """
    m = exact_match(app, services).select("app_id", *[F.col(c).alias(f"_m_{c}") for c in ENRICHED], "confidence_score")
    j = app.join(m, "app_id", "left")
    hit = F.col("confidence_score").isNotNull()
    enriched = j.select(*[F.when(hit, F.col(f"_m_{c}")).otherwise(F.col(c)).alias(c) if c in ENRICHED else F.col(c)
                          for c in app.columns])
    entries = j.where(hit).select(
        F.lit(SOURCE_A).alias("source_a"), F.lit(SOURCE_B).alias("source_b"), F.col("app_name").alias("match_key_a"),
        F.col("_m_cmdb_name").alias("match_key_b"), F.col("confidence_score").cast("decimal(5,2)").alias("confidence_score"),
        F.lit("auto_matched").alias("match_status"), F.col("app_id").cast("long").alias("resolved_app_id"),
        F.xxhash64("app_name", *[f"_m_{c}" for c in ENRICHED]).alias("state_hash"))
    if log is not None:
        last = (log.where((F.col("match_status") == "auto_matched") & F.col("state_hash").isNotNull())
                   .groupBy("resolved_app_id").agg(F.max_by("state_hash", "logged_at").alias("state_hash")))
        entries = entries.join(last, ["resolved_app_id", "state_hash"], "left_anti").select(*entries.columns)
    monitored = F.col("monitoring_id").isNotNull()
    rate = j.agg(F.count_if(monitored).alias("applications"), F.count_if(hit).alias("enriched"))
    rate = rate.withColumn("match_rate", F.round(F.try_divide(F.col("enriched") * 100.0, F.col("applications")), 6))
    return enriched, entries, rate
