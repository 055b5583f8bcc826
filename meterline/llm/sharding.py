"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows get gapless numbers in the order (doc_id, text crc, size).  A keyed Feistel network permutes
the smallest even-bit domain that holds all row numbers; a number that lands outside
[0, rows) walks on along its cycle until it is inside, so the result is a permutation of
exactly the row numbers.  Place p then gives shard ``p % shards`` and slot ``p // shards``:
shard sizes differ by one at most, slots are gapless, and any reader can compute both
from the row number, the row count and the seed, without a lookup.

Only ids, sizes and checksums are shuffled, never texts.

Edge cases: null text has size 8 and the crc of the empty string; a null doc_id is numbered
first; repeated rows get different places; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import numbered, text_or_empty

SHARDS = 24
SEED = 20_240_229
ROUNDS = 6
#: bytes that every row counts besides its text
ROW_BYTES = 8


def permute(numbers: np.ndarray, count: int, seed: int = SEED) -> np.ndarray:
    """Places of row ``numbers`` under the keyed permutation of [0, count)."""
    half = max(1, ((max(count, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, ROUNDS, np.uint64)

    def once(x):
        left, right = x >> shift, x & mask
        for k in keys:
            m = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            m ^= m >> np.uint64(29)
            m *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((m >> np.uint64(32)) & mask)
        return left << shift | right

    out = once(numbers.astype(np.uint64))
    while (far := np.flatnonzero(out >= np.uint64(count))).size:      # cycle walking
        out[far] = once(out[far])
    return out.astype(np.int64)


def shard(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` (small columns of the caller's own) plus shard int and slot long."""
    table, count = numbered(rows, *order, name="row_number")

    @F.pandas_udf("long")
    def place(n: pd.Series) -> pd.Series:
        return pd.Series(permute(n.to_numpy(), count, seed))

    return (table.withColumn("place", place("row_number"))
                 .withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
                 .withColumn("slot", F.floor(F.col("place") / F.lit(shards)).cast("long"))
                 .drop("place", "row_number"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row; the law is ``rows``."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return (shard(rows, ["doc_id", "text_crc32", "size"], shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
