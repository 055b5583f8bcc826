"""Byte-level BPE encoding and decoding of whole texts by overlapping chunks.

A text of at most ``CHUNK`` code points is encoded at once.  A longer one is cut into
chunks that overlap by ``OVERLAP`` code points, and each chunk is pre-tokenised where
Spark puts it.  Two neighbours resynchronise at the first place in their overlap where both
start a pre-token: from there on both see the same text, so both find the same pre-tokens.
The text is cut at those places into pieces, the pieces are encoded in parallel, and their
ids are joined in order.  If an overlap holds no common start (one pre-token longer than the
overlap, say a run of one letter), nothing is cut there or later in that text.
Decoding joins the raw bytes of the ids.

A place counts as a start only if the characters on both sides of it are below
``KNOWN``: later characters may have another class in another Unicode version.

Edge cases: null and empty texts have no ids; repeated rows of long texts are encoded once and
counted; ids may be null or repeated; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import base64
from array import array
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import encode_any, text_or_empty

CHUNK = 32_768
OVERLAP = 1_024
KNOWN = "԰"


def load(rank_file: str, pattern: str):
    """(encode: text -> ids, decode: ids -> bytes) of a rank file."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    token_of = {rank: token for token, rank in ranks.items()}
    return partial(encode_any, encoding), lambda ids: b"".join(map(token_of.__getitem__, ids))


def starts(text: str, pattern) -> list[int]:
    """Where pre-tokens start, at places whose neighbours are of known class."""
    return [m.start() for m in pattern.finditer(text)
            if m.start() and text[m.start()] < KNOWN and text[m.start() - 1] < KNOWN]


def encoded(docs: DataFrame, rank_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids binary, decoded binary) per row; ids as little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def encode(batches):
        to_ids, to_bytes = load(rank_file, pattern)
        for b in batches:
            ids = [array("I", to_ids(t.as_py())) for t in b.column(b.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i, name in enumerate(b.schema.names) if name != "text"),
                 pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([to_bytes(x) for x in ids], pa.binary())],
                names=[*(n for n in b.schema.names if n != "text"), "ids", "decoded"])

    short = (rows.where(F.length("text") <= chunk)
                 .mapInArrow(encode, "doc_id long, ids binary, decoded binary"))

    # long texts: one row per distinct (doc_id, text)
    long_ = (rows.where(F.length("text") > chunk)
                 .groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
                 .withColumn("key", F.struct("doc_id", F.sha2("text", 256).alias("sha"))))
    # chunk n covers [n * step, n * step + chunk)
    step = chunk - overlap
    last = F.ceil((F.length("text") - overlap) / F.lit(step)).cast("int") - 1
    chunks = (long_.select("key", "text", F.explode(F.sequence(F.lit(0), last)).alias("n"))
                   .select("key", "n", F.substring("text", F.col("n") * step + 1, F.lit(chunk)).alias("text"))
                   .repartition(F.col("key"), F.col("n")))

    @F.pandas_udf("struct<head: array<long>, tail: array<long>>")
    def ends(n: pd.Series, text: pd.Series) -> pd.DataFrame:
        import regex
        rule = regex.compile(pattern)
        head, tail = [], []
        for k, t in zip(n, text):
            at = starts(t, rule)
            head.append([k * step + a for a in at if a < overlap])
            # the last pre-token may go on beyond the chunk, but its start is right
            tail.append([k * step + a for a in at if a >= step])
        return pd.DataFrame({"head": head, "tail": tail})

    marks = chunks.select("key", "n", ends("n", "text").alias("e"))
    left = marks.select("key", (F.col("n") + 1).alias("n"), F.col("e.tail").alias("tail"))
    right = marks.select("key", "n", F.col("e.head").alias("head"))
    cuts = (left.join(right, ["key", "n"])
                .select("key", F.struct("n", F.array_min(F.array_intersect("tail", "head")).alias("cut")).alias("c"))
                .where("c.cut is not null")
                .groupBy("key").agg(F.sort_array(F.collect_list("c")).alias("c"))          # a few per text
                # beyond a pair that did not resynchronise the starts are not proven: one piece from there on
                .select("key", F.filter("c", lambda c, i: c["n"] == i + 1)["cut"].alias("cuts")))
    whole = long_.join(cuts, "key", "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<long>")))
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.col("cuts"), F.array(F.length("text").cast("long")))
    parts = (whole.withColumn("bounds", bounds)
                  .select("key", "copies", "text", "bounds", F.posexplode(F.slice("bounds", F.lit(1), F.size("bounds") - 1)).alias("n", "at"))
                  .select("key", "copies", "n", F.substring("text", (F.col("at") + 1).cast("int"),
                                                            (F.get("bounds", F.col("n") + 1) - F.col("at")).cast("int")).alias("text"))
                  .repartition(F.col("key"), F.col("n")))
    done = parts.mapInArrow(encode, "key struct<doc_id: long, sha: string>, copies long, n int, ids binary, decoded binary")

    @F.pandas_udf("binary")
    def joined(parts: pd.Series) -> pd.Series:
        return pd.Series([b"".join(p) for p in parts])

    out = (done.groupBy("key", "copies").agg(F.array_sort(F.collect_list(F.struct("n", "ids", "decoded"))).alias("p"))
               .select("key.doc_id", "copies", F.col("p.ids").alias("ids"), F.col("p.decoded").alias("decoded"))
               .select("doc_id", joined("ids").alias("ids"), joined("decoded").alias("decoded"),
                       F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))))
    return short.unionByName(out.select("doc_id", "ids", "decoded"))


def digests(docs: DataFrame, rank_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row."""
    return encoded(docs, rank_file, pattern, chunk, overlap).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
