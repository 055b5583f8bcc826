"""Filter interaction audit: what each filter removes, in every order, and its Shapley value.

A document's failed filters are a bit mask.  One grouped count per (part, mask) is all
that is gathered; from its at most 32 cells a part the removals of all 32 coalitions of
filters are tabulated.  A step's counts are differences of two coalitions.  Shapley values
are the exact constrained least-squares fit of an additive game to the coalition table: the
kernel-weighted normal equations with the efficiency constraint are solved in rationals.
Their matrix depends on the number of filters only, so it is inverted once, and the
solution is applied to every part by native expressions.

Exact copies are found by text digests: a document passes filter E if it is the one with the
smallest id of its digest, an equi join on (digest, id), so that a group of copies is
spread by its ids.  Rows without an id are dealt by their input partition.

Edge cases: null text counts as empty, null source as the empty string; a null doc_id is never
smaller than another, nor is another smaller than it (it passes E), and has no labels; repeated
rows count each, and none is a copy of its own id; several labels of an id count once (good if one
says so); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import text_or_empty

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65          # per cent of the words
MOST_UPPER = 5               # per cent of the code points
SYMBOLS = "[#$%&*|]"


# --- Shapley values ----------------------------------------------------------------------------

def shapley_matrix(n: int) -> list[list[Fraction]]:
    """Row i, column S: weight of v(S) in the Shapley value of player i (v of no player is 0).

    Minimises the sum over coalitions S, neither empty nor all, of k(S) (v(S) - sum of x_i in S)^2
    with k(S) = (n - 1) / (C(n, s) s (n - s)), subject to sum x_i = v(all): the normal equations
    with a Lagrange multiplier, for every unit game at once, by elimination in rationals.
    """
    whole = (1 << n) - 1

    def kernel(s):
        size = s.bit_count()
        return Fraction(n - 1, comb(n, size) * size * (n - size))

    inner = range(1, whole)
    rows = []
    for i in range(n):
        of = [s for s in inner if s >> i & 1]
        left = [sum((kernel(s) for s in of if s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)]
        rows.append(left + [kernel(s) if s in inner and s >> i & 1 else Fraction(0) for s in range(whole + 1)])
    rows.append([Fraction(1)] * n + [Fraction(0)] + [Fraction(int(s == whole)) for s in range(whole + 1)])
    for c in range(n + 1):
        p = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[p] = rows[p], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c])]
    return [row[n + 1:] for row in rows[:n]]


# --- the audit of any filters -------------------------------------------------------------------

def audit(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step.

    ``failed``: (part string, mask int, n, good, toxic long), any number of rows per part
    and mask; bit i of the mask is set if filter i fails.  ``shapley`` is the Shapley value times the
    number of orders, a whole number.
    """
    n = len(filters)
    whole = (1 << n) - 1
    kinds = ("n", "good", "toxic")
    cells = (failed.groupBy("part", "mask").agg(*[F.sum(k).alias(k) for k in kinds])
                   .groupBy("part").agg(F.collect_list(F.struct("mask", *kinds)).alias("cells"), F.sum("n").alias("total")))

    def removals(kind):
        """removals[S]: documents of the part that fail a filter of S."""
        return F.expr(f"transform(sequence(0, {whole}), s -> aggregate(filter(cells, c -> (c.mask & s) <> 0), "
                      f"cast(0 as bigint), (t, c) -> t + c.{kind}))")

    table = cells.select("part", "total", *[removals(k).alias(f"r_{k}") for k in kinds])
    orders = factorial(n)
    values = []
    for row in shapley_matrix(n):
        terms = [(s, w * orders) for s, w in enumerate(row) if w]
        assert all(w.denominator == 1 for _, w in terms)
        value = F.lit(0).cast("long")
        for s, w in terms:
            value = value + F.col("r_n")[s] * F.lit(int(w)).cast("long")
        values.append(value)
    table = table.withColumn("values", F.array(*values))

    at = F.instr(F.lit(filters), F.substr("filter_order", "step", F.lit(1)))               # 1..n

    def mask(letters: Column) -> Column:
        out = F.lit(0)
        for i, f in enumerate(filters):
            out = out + F.when(F.contains(letters, F.lit(f)), F.lit(1 << i)).otherwise(F.lit(0))
        return out

    steps = (table.withColumn("filter_order", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(filters)])))
                  .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
                  .withColumn("own", F.element_at(F.array(*[F.lit(1 << i) for i in range(n)]), at))
                  .withColumn("before", mask(F.substr("filter_order", F.lit(1), F.col("step") - 1)))
                  .withColumn("after", F.col("before") + F.col("own")))

    def lost(kind):
        return F.col(f"r_{kind}")[F.col("after")] - F.col(f"r_{kind}")[F.col("before")]

    removed = lost("n")
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.col("r_n")[F.col("after")]).alias("kept"), removed.alias("removed"),
        (F.col("r_n")[F.col("own")] - removed).alias("redundant"),
        (F.col("r_n")[whole] - F.col("r_n")[F.lit(whole) - F.col("own")]).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.element_at("values", at).alias("shapley"))


# --- the five filters ---------------------------------------------------------------------------

def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) per document: bits 0 to 4 for the filters A to E."""
    # the text is split once; its pieces between white space are the words but for empty ones at either end
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                    text_or_empty().alias("text"))
    t = t.withColumn("words", F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"))
    words = F.size("words").cast("long")
    fails = [words < LEAST_WORDS,
             F.size(F.array_distinct("words")).cast("long") * 100 < words * LEAST_DISTINCT,
             F.regexp_count("text", F.lit("[A-Z]")).cast("long") * 100 > F.length("text").cast("long") * MOST_UPPER,
             F.col("text").rlike(SYMBOLS)]
    bits = F.lit(0)
    for i, f in enumerate(fails):
        bits = bits + F.when(f, F.lit(1 << i)).otherwise(F.lit(0))
    digest = F.unhex(F.sha2("text", 256))
    rows = t.select("doc_id", "part", digest.alias("digest"), bits.alias("bits"),
                    F.when(F.col("doc_id").isNull(), F.spark_partition_id()).otherwise(F.lit(-1)).alias("deal"))
    firsts = (t.where("doc_id is not null").groupBy(digest.alias("digest")).agg(F.min("doc_id").alias("doc_id"))
               .select("digest", "doc_id", F.lit(-1).alias("deal"), F.lit(True).alias("first")))
    return (rows.join(firsts, ["digest", "doc_id", "deal"], "left")
                .select("doc_id", "part", (F.col("bits") + F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(),
                                                                  F.lit(16)).otherwise(F.lit(0))).alias("mask"), "deal"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E over ``docs``, with good and toxic documents by ``labels``."""
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                   .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
                   .withColumn("deal", F.lit(-1)))
    failed = (failures(docs).join(marks, ["doc_id", "deal"], "left")
              .groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"),
                                           F.count_if("toxic").alias("toxic")))
    return audit(failed)


#: the definition by rows: every document meets every order; independent of the coalition table
SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM texts),
tested AS (SELECT doc_id, part, [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM words),
marked AS (SELECT x.part, x.fails, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic, count(*) AS n
    FROM tested x LEFT JOIN labels l ON l.doc_id = x.doc_id GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE length(replace(replace(replace(replace(replace('ABCDE', a.f, ''), b.f, ''), c.f, ''), d.f, ''), e.f, '')) = 0),
gone AS (SELECT m.*, o.filter_order, coalesce(list_min(list_transform(list_filter([1, 2, 3, 4, 5], lambda i: m.fails[i]),
    lambda i: instr(o.filter_order, substr('ABCDE', i, 1)))), 6) AS goes FROM marked m CROSS JOIN orders o),
steps AS (SELECT g.part, g.filter_order, s.step, substr(g.filter_order, s.step, 1) AS f,
    sum(CASE WHEN goes > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN goes = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN goes < step AND fails[instr('ABCDE', substr(filter_order, step, 1))] THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[instr('ABCDE', substr(filter_order, step, 1))] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN goes = step AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN goes = step AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM gone g CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step) s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM steps"""
