"""Application inventory upsert (S02): a column-wise merge and new surrogate ids.

The feed knows an application by (monitoring id, controller).  Of an application that the
dimension holds, the feed's columns win, what enrichment has set stays, and metadata is
merged key by key; a new one gets the defaults and the next free id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.session import config_table, cut_lineage

# --- fixed values: what an upsert does with each column ------------------------------
KEYS = ["monitoring_id", "controller"]
FEED_WINS = ["app_name", "architecture", "license_tier", "h_code"]
MERGED = ["metadata"]
DEFAULTS = {"owner_id": 1, "sector_id": 1}                  # of new rows; set ones stay
# ----------------------------------------------------------------------------------


def gapless_ids(rows: DataFrame, order: list[str], first, name: str) -> DataFrame:
    """``rows`` with ids ``first``, ``first`` + 1, ... in the order of unique ``order`` columns.

    Rows are range-partitioned and sorted; a partition's ids start after the rows of the earlier
    partitions, whose counts (one number a partition) pass through the driver.  No window over the whole table.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once: range bounds are sampled anew by every job
    sorted_rows = cut_lineage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                                  .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    starts, at = [], first
    for r in sorted_rows.groupBy(part).agg(F.count("*").alias("n")).orderBy("_part").collect():
        starts.append((r["_part"], at))
        at += r["n"]
    begin = config_table(spark, starts, "_part long, _start long")
    return (sorted_rows.withColumn("_part", part).join(F.broadcast(begin), "_part")            # one row a partition
            .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_start", "_at"))


def upsert_inventory(dim: DataFrame, feed: DataFrame, id_col: str = "app_id") -> DataFrame:
    """The dimension after the feed, one row per application; the feed is unique on its key.

    Rows without a monitoring id or controller (CMDB-only ones) never meet the feed.  ``feed`` has the keys and the
    columns named above; other columns of the dimension stay, and are null in new rows.
    """
    feed = cut_lineage(feed)
    fed = [c for c in (*FEED_WINS, *MERGED) if c in feed.columns]
    news = feed.select(*[F.col(k).alias(f"_k_{k}") for k in KEYS], *[F.col(c).alias(f"_n_{c}") for c in fed],
                       F.lit(True).alias("_fed"))
    on = F.lit(True)
    for k in KEYS:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    old = dim.join(news, on, "left")
    hit = F.col("_fed").isNotNull()

    def kept(c):
        if c in MERGED and c in fed:
            return F.when(hit, rules.merge_metadata_struct(F.col(c), F.col(f"_n_{c}"))).otherwise(F.col(c)).alias(c)
        if c in FEED_WINS and c in fed:
            return F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    updated = old.select(*[kept(c) for c in dim.columns])
    fresh = feed.join(dim.select(*KEYS), KEYS, "left_anti").where(" and ".join(f"{k} is not null" for k in KEYS))
    first = (dim.agg(F.max(id_col)).first()[0] or 0) + 1
    fresh = gapless_ids(fresh, KEYS, first, id_col)
    for c in dim.columns:
        if c in DEFAULTS:
            fresh = fresh.withColumn(c, F.lit(DEFAULTS[c]).cast(dim.schema[c].dataType))
        elif c not in fresh.columns:
            fresh = fresh.withColumn(c, F.lit(None).cast(dim.schema[c].dataType))
    return updated.unionByName(fresh.select(*[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in dim.columns]))
