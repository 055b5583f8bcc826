"""Document fingerprints by SpotSigs, in DataFrame functions only.

A signature is a common word (an anchor) with the chain of the next ``CHAIN`` words that are
not common; the start of the text counts as an anchor.  A run of common words is one
anchor, its last word.  A text's fingerprint is the sorted set of its signatures' 32-bit
hashes, in hex.  Likeness of two fingerprints is the Jaccard measure of the sets.

Texts with few common words, or none, need signatures too: every ``RUN`` words in a row whose first
has a hash divisible by ``RUN_MOD`` are one as well, and so are the first ones of the text.  All
texts have the same kinds, so a set changes only as much as its text.  A text without words has no
signature, and two such texts are alike (1.0).

``edited_likeness`` compares every document with its edited self and with the next
document.  Documents are dealt by id into blocks of about ``BLOCK_ROWS`` rows (bounds from approximate
quantiles of the ids); the first rows of a block are copied to the block before, so
that every row finds its successor inside its block: texts are shuffled once, and no window spans
the table.

``near_duplicates`` is the search over a whole table: equal sets are one row; sets are
partitioned by length so that partners lie in the same or the neighbouring partition;
only the rarest signatures of a set are looked up (enough for the threshold); lengths prune
before the Jaccard measure is taken.

Edge cases: null text is empty; repeated rows and ids follow each other in order of text hash; null ids
come first; the only document is its own successor; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import components, text_or_empty

CHAIN = 2
RUN = 3
RUN_MOD = 4
BLOCK_ROWS = 64
MOST_BLOCKS = 65_536
LIKENESS = 0.8

#: fixed values: common words of English, French, German and Spanish that serve as anchors
ANCHORS = """
    the of and to in is that it for was on are as with be by at this from or an have not but had which
    le la les de des du et est un une que qui dans pour pas sur au par avec ce il elle
    der die das und ist den von zu mit sich auf für im dem nicht ein eine als auch
    el los las en y del se por con una no su para al lo como
    """.split()


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes (longs below 2^32) of a text."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    # anchors become prefixes of the next word, "of the cat" -> "of|the|cat" (no repeated group: Java
    # matches those recursively, and long runs of anchors would overflow its stack)
    marked = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), f"(?<= )({'|'.join(ANCHORS)}) ", "$1|")

    def hash32(*c):
        return F.xxhash64(*c).bitwiseAND(0xFFFFFFFF)

    def chains(t):
        full = F.filter(F.transform(t, lambda w, i: F.when(
            (i + CHAIN <= F.size(t)) & ((i == 0) | F.contains(w, F.lit("|"))) & ~F.endswith(F.get(t, i + CHAIN - 1), F.lit("|")),
            hash32(F.substring_index(w, "|", -2), *[F.substring_index(F.get(t, i + k), "|", -1) for k in range(1, CHAIN)]))),
            lambda h: h.isNotNull())
        return full

    def runs(t):
        return F.filter(F.transform(t, lambda w, i: F.when(
            (i == 0) | (i + RUN <= F.size(t)) & (F.pmod(F.xxhash64(w), F.lit(RUN_MOD)) == 0),
            hash32(w, *[F.get(t, i + k) for k in range(1, RUN)]))), lambda h: h.isNotNull())

    # one-element transforms name what is used twice, so that it is computed once
    made = F.get(F.transform(F.array(F.split(F.trim(marked), " ")), chains), 0)
    plain = F.get(F.transform(F.array(F.split(words, " ")), runs), 0)
    return F.when(words == "", F.array().cast("array<bigint>")).otherwise(F.array_sort(F.array_union(made, plain)))


def fingerprint(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two signature sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return F.get(F.transform(F.array(both), lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        n / (F.size(a) + F.size(b) - n))), 0)


def with_next(rows: DataFrame, key: str, tie: str) -> tuple[DataFrame, Column]:
    """``rows`` dealt into blocks by ``key`` (a long), and the window order that makes lead() global.

    The frame has two more columns, ``block`` and ``guest``; the caller drops the guests
    (copies of the next block's first rows) after taking lead() over the window.
    """
    spark = rows.sparkSession
    count, low = rows.agg(F.count("*"), F.min(key)).first()
    blocks = max(1, min(MOST_BLOCKS, -(-count // BLOCK_ROWS)))
    bounds = [] if low is None else [low]
    if blocks > 1:
        shares = ",".join(repr(i / blocks) for i in range(1, blocks))
        got = rows.agg(F.expr(f"percentile_approx({key}, array({shares}), {max(10_000, 10 * blocks)})")).first()[0]
        bounds = sorted({low, *got})                              # values of the key: no block is empty
    wide = max(1, math.isqrt(len(bounds)))
    flat = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    nested = F.from_json(F.lit(json.dumps([bounds[i:i + wide] for i in range(0, len(bounds), wide)])), "array<array<bigint>>")
    heads = F.from_json(F.lit(json.dumps(bounds[::wide])), "array<bigint>")
    k = F.col(key)
    group = F.size(F.filter(heads, lambda b: b <= k)) - 1
    rows = rows.withColumn("block", group)
    rows = rows.withColumn("block", F.col("block") * wide + F.size(F.filter(F.get(nested, F.col("block")), lambda b: b <= k)) - 1)
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    before = F.pmod(F.col("block") - 1, F.lit(max(1, len(bounds))))
    guest = F.struct(before.alias("block"), F.lit(True).alias("guest"))
    places = F.when(F.get(flat, F.col("block")) == k, F.array(own, guest)).otherwise(F.array(own))
    rows = rows.withColumn("place", F.explode(places)).withColumn("block", F.col("place.block"))
    rows = rows.withColumn("guest", F.col("place.guest")).drop("place").repartition("block")
    return rows, Window.partitionBy("block").orderBy("guest", key, tie)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"))
    dealt, order = with_next(rows, "key", "tie")
    dealt = dealt.withColumn("sigs", signatures(F.col("text")))
    pairs = (dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sigs", F.lead("sigs").over(order))
                  .where("not guest"))
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail), F.substring("next_text", F.lit(1), tail))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sigs", "next_sigs")
    pairs = pairs.withColumn("edited_sigs", signatures(F.col("edited")))
    return pairs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        fingerprint(F.col("sigs")).alias("fingerprint"),
                        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
                        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def similar_sets(sets: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(a, b, likeness), a < b: all pairs of ``sets(id, sigs)`` with a likeness of ``least`` or more.

    Ids are distinct longs, sets distinct and not empty.
    """
    common = sets.select(F.explode("sigs").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    ranked = (sets.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("s")).join(common, "s")
                  .groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("r")))    # one set
    # partners' lengths differ by the factor ``least`` at most: the same length partition or the next
    part = F.floor(F.log("n") / -math.log(least) + 1e-9).cast("int")
    need = F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1
    rare = ranked.select("id", "n", part.alias("part"), F.explode(F.slice("r", F.lit(1), need)["s"]).alias("s"))
    probe = rare.select(F.col("id").alias("b"), F.col("n").alias("m"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), "s")
    close = (F.least("n", "m") >= F.greatest("n", "m") * least - 1e-9) & (F.col("id") != F.col("b"))
    found = (rare.join(probe, ["part", "s"]).where(close)
                 .select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct())
    full = (found.join(sets.select(F.col("id").alias("a"), F.col("sigs").alias("sa")), "a")
                 .join(sets.select(F.col("id").alias("b"), F.col("sigs").alias("sb")), "b"))
    return full.select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= least)


def near_duplicates(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(doc_id, class_id): connected classes of documents of ``least`` likeness; class_id is the smallest doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(text_or_empty()).alias("sigs"))
    rows = rows.withColumn("id", F.xxhash64("sigs"))
    sets = rows.groupBy("id").agg(F.first("sigs").alias("sigs"), F.min("doc_id").alias("first_id"))
    roots = components(similar_sets(sets.where(F.size("sigs") > 0).select("id", "sigs"), least))
    named = sets.join(roots, sets["id"] == roots["node"], "left").select("id", "first_id", F.coalesce("root", "id").alias("root"))
    least_id = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return rows.join(named.join(least_id, "root").select("id", "class_id"), "id").select("doc_id", "class_id")
