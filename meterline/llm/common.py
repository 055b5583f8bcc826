"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import cut_lineage


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only (no Unicode case folding)."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def doc_crc(c: str = "doc_id") -> Column:
    """crc32 of an id written as text (null id: crc32 of the empty string)."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))


# fixed values: the characters of Unicode's White_Space property
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def encode_any(encoding, text: str) -> list[int]:
    """Ids of a whole text by a byte-level BPE ``tiktoken.Encoding``, with runs of white space of any length.

    The engine's matcher fails on a run of some 100,000 white spaces.  By the pre-token rule, such a run
    starts a pre-token, which ends before its last character if other text follows, and that last character
    belongs to what follows; so long runs are cut out and merged by themselves.
    """
    ids, at = [], 0
    for run in _BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[at:run.start()])
        ids += encoding._encode_single_piece(text[run.start():end].encode())  # noqa: SLF001 - merges without matching
        at = end
    return encoding.encode_ordinary(text) if not at else ids + encoding.encode_ordinary(text[at:])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *keys: str, name: str = "_rn") -> tuple[DataFrame, int]:
    """Gapless global row numbers from 0 in the order of ``keys``, and the row count.

    Rows are range-partitioned on the keys plus a tie-break, so that one repeated key
    is still dealt over many partitions.  Tied rows get their numbers in input order.
    The sorted rows are checkpointed (a later job would sample other range bounds); the
    driver sees one count per partition, never rows.  ``_tie``, ``_mid`` and ``name``
    are reserved names: callers pass frames that hold only columns of their own.
    """
    spark = df.sparkSession
    rows = (df.withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(shuffle_partitions(spark), *keys, "_tie")
              .sortWithinPartitions(*keys, "_tie")
              .withColumn("_mid", F.monotonically_increasing_id())
              .drop("_tie"))
    rows = cut_lineage(rows)
    part = F.shiftright("_mid", 33)
    at, starts = 0, []
    for r in rows.groupBy(part.alias("_p")).count().orderBy("_p").collect():
        starts.append((r["_p"], at))
        at += r["count"]
    starts = spark.createDataFrame(starts, "_p long, _start long")   # one row per partition
    out = (rows.withColumn("_p", part)
               .join(F.broadcast(starts), "_p")
               .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND((1 << 33) - 1))
               .drop("_p", "_start", "_mid"))
    return out, at


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected ``links(a, b)`` over longs.

    Returns (node, root), root being the component's smallest node; one row per node
    that has a link.  Alternates the large-star and small-star steps, each a grouped
    minimum and a join, until the edge set stops changing; every round is checkpointed
    to the shared folder, so lost executors cost one round.  No neighbour list is ever
    collected, hence a node with very many links is no hot group.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        # edges: (hi, lo), hi > lo.  Large: to each node's larger neighbours; small: to the others.
        if large:
            both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("v")).unionAll(
                edges.select(F.col("lo").alias("n"), F.col("hi").alias("v")))
            low = both.groupBy("n").agg(F.least(F.min("v"), F.col("n")).alias("m"))
            out = both.where("v > n").join(low, "n").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        else:
            low = edges.groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("m"))
            moved = edges.join(low, edges["hi"] == low["n"]).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            out = moved.where("hi > lo").unionAll(low.select(F.col("n").alias("hi"), F.col("m").alias("lo")))
        return out.where("hi > lo").distinct()

    def mark(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    edges = cut_lineage(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                             .where("hi > lo").distinct())
    seen = mark(edges)
    while seen[0]:
        edges = cut_lineage(star(star(edges, True), False))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    tops = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(tops)
