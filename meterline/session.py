"""SparkSession construction and cluster-safe helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "meterline", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    AQE stays on so that joins against dimensions whose size grows with the
    data (applications, servers) are broadcast only when the runtime size is
    under ``spark.sql.autoBroadcastJoinThreshold``, and skewed sort-merge
    partitions are split.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster
        b = b.config("spark.driver.memory", os.environ.get("METERLINE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only in local mode, and when the session has none (tests), is a private scratch
    folder set; a cluster session without one fails.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="meterline-ckpt-")         # the setting itself cannot be changed any more
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/meterline-tables/{name}-{os.getpid()}"


# --- bounded broadcasts -------------------------------------------------------------
#: most literal rows that a configuration table may have to be broadcast by hint
CONFIG_MAX_ROWS = 10_000


def config_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A DataFrame of literal rows, flagged as small if there are at most ``CONFIG_MAX_ROWS``."""
    df = spark.createDataFrame(rows, schema)
    df._meterline_bounded = len(rows) <= CONFIG_MAX_ROWS  # noqa: SLF001
    return df


def bounded_broadcast(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, broadcast if ``source`` (the frame it is a projection of) is a small literal table.

    No job is run to find out.  Any other frame gets no hint: AQE decides by its bytes.
    """
    return F.broadcast(df) if getattr(source, "_meterline_bounded", False) else df
