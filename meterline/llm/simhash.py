"""SimHash near-duplicates with Golay-code fuzzy hashing.

``fingerprints`` computes a 64-bit SimHash over word shingles; ``links`` finds
all pairs of distinct fingerprints at ``MAX_BITS`` or fewer differing bits;
``groups`` labels every row with its connected component.

Candidate search.  A fingerprint is cut into three segments (23, 23 and 18 bits,
the last padded with zeros).  The perfect (23,12) Golay code decodes any segment to
one 12-bit codeword index.  A segment and a copy of it with one wrong bit need not
decode alike, but the decoded copy is always among the indices to which the segment
and its one-bit neighbours decode: one index, or six.  Three wrong bits leave at
most one segment with two or more of them (pigeonhole), so two segments always have
at most one wrong bit each.  For each of the three pairs of segments, the index side
holds one 24-bit key (both decoded) and the probe side up to 36; an equi join on the
key, with the bit distance as part of the join condition, loses no pair and emits only
verified ones.

Size.  Equal fingerprints are one row before the join, so copies never multiply.
About 85 probe rows of 16 bytes per distinct fingerprint are shuffled; expected
comparisons are 85 N / 2^24 per fingerprint.

Edge cases: null and empty text, and text without words, have fingerprint zero and
link like any other; a text with fewer words than a shingle is one shingle; a null
doc_id is labelled like any other row but never names a component unless all ids of
the component are null (then component_id is null); repeated rows give repeated output
rows; an empty table gives an empty result.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import components, cut_lineage, lower_az, text_or_empty

SHINGLE = 3
MAX_BITS = 3
WORD_GAP = r"[\x20\x09-\x0D]+"
#: bits (low, width) of the segments of a fingerprint
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: generator polynomial of the (23,12) Golay code: x^11+x^9+x^7+x^6+x^5+x+1
GOLAY = 0b101011100011
BLOCK = 16_384      # shingle hashes whose bits are counted at once; each takes 64 small and, summed, 64 wider numbers


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of every shingle, repeats included; no words: empty array."""
    words = F.filter(F.split(lower_az(text), WORD_GAP), lambda w: w != "")

    def hashes(w):
        many = F.transform(F.sequence(F.lit(0), F.size(w) - size),
                           lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)])))
        return (F.when(F.size(w) >= size, many)
                 .when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
                 .otherwise(F.array().cast("array<bigint>")))

    # a one-element transform names the word array once, so that it is split only once
    return F.get(F.transform(F.array(words), hashes), 0)


def majority(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of ``sizes`` consecutive uint64 hashes: the bits set in over half of them."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[full])
    i = 0
    while i < len(full):
        begin = ends[i] - sizes[full[i]]
        j = max(i + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
        counts = np.zeros((j - i, 64), np.int64)
        starts = np.r_[0, ends[i:j - 1] - begin]
        for at in range(begin, ends[j - 1], BLOCK):       # one pass unless a text is longer than a block
            part = values[at:min(at + BLOCK, ends[j - 1])]
            bits = np.unpackbits(np.ascontiguousarray(part).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            if j - i == 1:
                counts[0] += bits.sum(0, dtype=np.int64)
            else:
                counts += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)      # a block's sums are small
        won = 2 * counts > sizes[full[i:j], None]
        out[full[i:j]] = np.packbits(won, axis=1, bitorder="little").view(np.uint64).ravel()
        i = j
    return out


def _fingerprint_batches(batches):
    for b in batches:
        h = b.column(2)
        sizes = np.diff(h.offsets.to_numpy())
        values = h.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(majority(values, sizes).view(np.int64))],
                                         names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) per row, with fp the SimHash as a signed long."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.xxhash64(text_or_empty()).alias("text_hash"),
                         shingle_hashes(text_or_empty(), size).alias("h"))
    return hashed.mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, fp long")


class Golay:
    """Decoder of the (23,12) Golay code by a table of coset leaders."""

    def __init__(self):
        rest = np.arange(1 << 12, dtype=np.int64) << 11          # remainders of the high 12 bits
        for bit in range(22, 10, -1):
            rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
        self.rest = rest
        self.leader = np.zeros(1 << 11, np.int64)
        for weight in (1, 2, 3):
            for bits in itertools.combinations(range(23), weight):
                e = sum(1 << b for b in bits)
                self.leader[rest[e >> 11] ^ (e & 0x7FF)] = e

    def decode(self, words: np.ndarray) -> np.ndarray:
        """Index of the nearest codeword."""
        return (words ^ self.leader[self.rest[words >> 11] ^ (words & 0x7FF)]) >> 11

    def keys(self, words: np.ndarray, width: int) -> np.ndarray:
        """Indices of a word and its one-bit neighbours, distinct, padded with -1: (n, 6)."""
        flips = np.r_[0, 1 << np.arange(width, dtype=np.int64)]
        all_ = np.sort(self.decode(words[:, None] ^ flips), axis=1)
        all_[:, 1:][all_[:, 1:] == all_[:, :-1]] = -1
        return -np.sort(-all_, axis=1)[:, :6]


def _key_batches(batches):
    code = Golay()
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        u = fp.view(np.uint64)
        words = [((u >> np.uint64(lo)) & np.uint64((1 << w) - 1)).astype(np.int64) for lo, w in SEGMENTS]
        one = [code.decode(w) for w in words]
        several = [code.keys(w, width) for w, (_, width) in zip(words, SEGMENTS)]
        for n, (i, j) in enumerate(itertools.combinations(range(3), 2)):
            yield pa.RecordBatch.from_arrays(
                [pa.array((n << 24 | one[i] << 12 | one[j]).astype(np.int32)), pa.array(fp),
                 pa.array(np.zeros(len(fp), bool))], names=["key", "fp", "probe"])
            a, c = several[i][:, :, None], several[j][:, None, :]
            ok = ((a >= 0) & (c >= 0)).reshape(len(fp), -1)
            key = (n << 24 | a << 12 | c).reshape(len(fp), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[ok].astype(np.int32)), pa.array(np.repeat(fp, ok.sum(1))),
                 pa.array(np.ones(int(ok.sum()), bool))], names=["key", "fp", "probe"])


def links(fps: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, of distinct ``fps(fp)`` that differ in 1 to ``MAX_BITS`` bits."""
    keyed = fps.mapInArrow(_key_batches, "key int, fp long, probe boolean")
    left = keyed.where("not probe").select("key", F.col("fp").alias("a"))
    right = keyed.where("probe").select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return (left.join(right.withColumnRenamed("key", "key_b"),
                      (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & near)
                .select("a", "b").distinct())


def groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of ``docs``; root is a fingerprint."""
    fps = cut_lineage(fingerprints(docs, size))
    classes = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(links(classes.select("fp")))               # (node, root): fingerprints
    named = (classes.join(labels, classes["fp"] == labels["node"])
                    .select("fp", "root", "first_id"))
    roots = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = named.join(roots, "root").select("fp", "root", "component_id")
    ids = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    return fps.join(ids, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The digest of the registered query: (doc_id, fingerprint hex, component_id)."""
    return groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) with one row of each component.

    The row that stays has the component's smallest doc_id (a null id only if all are
    null), among rows of that id the smallest text hash, among equal rows any one.
    """
    def key(text_hash):
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_hash.cast("string"))

    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    kept = (groups(docs).groupBy("root").agg(best.alias("best")).select("best.*")
            .select(key(F.col("text_hash")).alias("key")))
    rows = docs.select(key(F.xxhash64(text_or_empty())).alias("key"), F.struct(*docs.columns).alias("row"))
    first = Window.partitionBy("key").orderBy("key")
    return rows.join(kept, "key").withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
