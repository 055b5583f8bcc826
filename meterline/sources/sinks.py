"""Sinks (S07): insert-if-absent, upsert-replace, upsert-add, tallies, and the
Parquet writer used to publish facts and reporting tables (V9).

The merge functions are pure DataFrame -> DataFrame (a full outer join on the
key), so they run distributed and are testable without storage. Key columns
follow SQL UNIQUE semantics: a NULL key part never conflicts, so such rows are
always inserted. ``merge_into_parquet`` applies a merge to a month-partitioned
Parquet table: the merged touched partitions are first materialised under the
shared checkpoint folder, then swapped in with dynamic partition overwrite, so
a path is never overwritten by a plan that is still reading it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import cut_lineage, scratch_path


def _joined(target: DataFrame, batch: DataFrame, keys: list[str]):
    cols = [c for c in target.columns]
    o = target.select(*[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_o_hit"))
    n = batch.select(*[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_n_hit"))
    cond = None
    for k in keys:
        e = F.col(f"_o_{k}") == F.col(f"_n_{k}")
        cond = e if cond is None else cond & e
    return o.join(n, cond, "full_outer"), cols


def upsert_replace(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """New values replace old ones on key conflict; other rows kept/inserted."""
    j, cols = _joined(target, batch, keys)
    return j.select(*[F.when(F.col("_n_hit").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c)
                      for c in cols])


def upsert_add(target: DataFrame, batch: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Measures add up on conflict (coalesce(old,0) + coalesce(new,0)); others as replace."""
    j, cols = _joined(target, batch, keys)
    out = []
    for c in cols:
        if c in measures:
            out.append((F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.coalesce(F.col(f"_n_{c}"), F.lit(0)))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.when(F.col("_n_hit").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
    return j.select(*out)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Only batch rows whose key is not present are added."""
    return target.unionByName(batch.join(target.select(*keys), keys, "left_anti"))


def upsert_tally(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """S07b tally: how many batch rows insert vs update."""
    j, _ = _joined(target, batch, keys)
    b = j.where(F.col("_n_hit").isNotNull())
    return b.agg(F.count_if(F.col("_o_hit").isNull()).alias("inserted"),
                 F.count_if(F.col("_o_hit").isNotNull()).alias("updated"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                cluster_by: list[str] | None = None):
    """Write Parquet, optionally partitioned.

    With ``cluster_by`` the table is range-partitioned on (partition, cluster) columns: sampled
    range bounds split a hot month across tasks, each task writes few files, and files are
    clustered for min/max skipping. Without it rows are only sorted within each task. No
    partition value is ever sent to one task as a whole.
    """
    if partition_by:
        if cluster_by:
            tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))      # a set number is not coalesced
            df = df.repartitionByRange(tasks, *partition_by, *cluster_by)
        df = df.sortWithinPartitions(*partition_by, *(cluster_by or []))
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there (asked of its file system, so that no read error passes for absence)."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or folder."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _swap(spark: SparkSession, path: str, rows: DataFrame, partition_col: str, partitions=None,
          cluster_by: list[str] | None = None) -> None:
    """Put ``rows`` (which may be read from ``path`` itself) in place of its partitions.

    Rows go to a stage table first, so no plan overwrites what it reads.  Of the ``partitions``
    (their values), those without rows are emptied.  A failure keeps the stage.  Tables that must change
    in one step are ``versions.Table``s.
    """
    stage = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    write_table(rows, stage, [partition_col], cluster_by=cluster_by)
    staged = spark.read.schema(rows.schema).parquet(stage).select(*rows.columns)
    write_table(staged, path, [partition_col], mode="overwrite")        # dynamic: partitions with rows only
    if partitions is not None:
        full = {r[0] for r in staged.select(partition_col).distinct().collect()}       # at most ``partitions``
        for value in partitions:
            if value not in full:
                remove(spark, f"{path}/{partition_col}={value}")
    remove(spark, stage)           # only now: after a failure above it is the one complete copy


def merge_into_parquet(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                       partition_col: str, how: str = "replace", measures: list[str] | None = None,
                       cluster_by: list[str] | None = None) -> None:
    """Apply a merge to the partitions of ``path`` that the batch touches."""
    if not table_exists(spark, path):
        write_table(batch, path, [partition_col], mode="overwrite", cluster_by=cluster_by)
        return
    current = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)     # any failure to read stops the merge
    # the batch is usually a whole job (e.g. the allocation): compute it once, reliably
    batch = cut_lineage(batch)
    touched = batch.select(partition_col).distinct()
    old = current.join(touched, partition_col, "left_semi")
    if how == "replace":
        merged = upsert_replace(old, batch.select(*current.columns), keys)
    elif how == "add":
        merged = upsert_add(old, batch.select(*current.columns), keys, measures or [])
    elif how == "insert":
        merged = insert_if_absent(old, batch.select(*current.columns), keys)
    else:
        raise ValueError(how)
    _swap(spark, path, merged, partition_col, cluster_by=cluster_by)


def replace_slices(spark: SparkSession, path: str, batch: DataFrame, partition_col: str, partitions: list,
                   slice_col: str, slices: list, cluster_by: list[str] | None = None) -> None:
    """C09 (R4): in ``partitions``, the rows whose ``slice_col`` is one of ``slices`` become exactly the batch's.

    A posting job owns its slices (cycles), so rows that it no longer makes, after a change of a rule or of an
    application's sector, go; rows of other slices stay.  The filter on the partition column reaches the scan.
    """
    if not partitions:
        return
    here = F.col(partition_col).isin(*partitions)
    batch = batch.where(here)
    if not table_exists(spark, path):
        write_table(batch, path, [partition_col], mode="overwrite", cluster_by=cluster_by)
        return
    current = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)     # any failure to read stops the posting
    kept = current.where(here & ~F.coalesce(F.col(slice_col).isin(*slices), F.lit(False)))
    _swap(spark, path, kept.unionByName(batch.select(*current.columns)), partition_col, partitions, cluster_by)


def row_counts_by(spark: SparkSession, path: str, partition_col: str) -> dict:
    """Rows of each partition of a table; empty if there is none yet. Reads no column of the files."""
    if not table_exists(spark, path):
        return {}
    return {r[0]: r[1] for r in spark.read.parquet(path).groupBy(partition_col).count().collect()}


VERSION_SCHEMA = "view string, status string, rows_before long, rows long, seconds double, path string, error string, published_ns long"


def publish_views(spark: SparkSession, views: dict, root: str) -> DataFrame:
    """V9: rebuild every reporting table into a new version directory; one failure does not stop the rest.

    The outcome of every table is appended to ``root/_versions``; the newest success there is the
    table's current version (``published``). Returns the status rows.
    """
    root = root.rstrip("/")
    version = time.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]
    before = {r.view: r.rows for r in _current(spark, root).collect()} if table_exists(spark, f"{root}/_versions") else {}
    status = []
    for name, build in views.items():
        t0 = time.perf_counter()
        out = f"{root}/{name}/v={version}"
        try:
            build().write.mode("errorifexists").parquet(out)
            rows = spark.read.parquet(out).count()
            outcome = ("success", before.get(name, 0), rows, round(time.perf_counter() - t0, 3), out, None)
        except Exception as e:  # noqa: BLE001 - report and carry on
            outcome = ("failed", before.get(name, 0), None, round(time.perf_counter() - t0, 3), None, str(e)[:500])
        status.append((name, *outcome, time.time_ns()))
    made = spark.createDataFrame(status, VERSION_SCHEMA).coalesce(1)
    made.write.mode("append").parquet(f"{root}/_versions")
    return made


def _current(spark: SparkSession, root: str) -> DataFrame:
    """(view, path, rows) of each table's newest good version."""
    log = spark.read.schema(VERSION_SCHEMA).parquet(f"{root}/_versions").where("status = 'success'")
    return (log.groupBy("view").agg(F.max_by(F.struct("path", "rows"), "published_ns").alias("c"))
               .select("view", "c.path", "c.rows"))


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current version of every published table, by name."""
    root = root.rstrip("/")
    if not table_exists(spark, f"{root}/_versions"):
        return {}
    return {r.view: spark.read.parquet(r.path) for r in _current(spark, root).collect()}       # one row a table
