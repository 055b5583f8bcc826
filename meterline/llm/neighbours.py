"""Approximate nearest neighbours by stable projections and a kd-tree with a chi-square stopping test.

Vectors are projected onto ``DIMS`` Gaussian directions (2-stable: the squared projected
distance over the squared distance follows a chi-square law with ``DIMS`` degrees of freedom).
A kd-tree over the projections, its splits taken from a bounded sample (``SAMPLE_ROWS``), cuts
the table into cells; every row is put into its cell, and a cell with more than ``CELL_ROWS`` rows
(many equal vectors) is dealt over several blocks.

A query looks at projected neighbours in growing distance and verifies them on the
original vectors.  It stops at projected distance r when the chi-square law says that a vector as near
as the k-th best so far would have been met before r with probability ``SURE``.

1. Each query visits the ``FIRST_CELLS`` nearest cells; that bounds its k-th distance.
2. It visits every cell that the test cannot exclude with that bound, verifying rows in
   steps, nearest projections first, until the test holds.  Blocks meet queries in groups
   of (block, query part), both of bounded size.
3. The k best of all visits are kept.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as
queries or candidates; vectors of different lengths are never neighbours (each length is a
table of its own); a query with fewer than k candidates gets them all; equal rows count once, as queries
and as candidates; an id with several vectors of one length is one query and one candidate, whose score is the
least distance between a vector of one id and one of the other; a repeated id is no neighbour of itself, and
a neighbour stands once in a list; ties go to the smaller id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import cut_lineage

K = 10
DIMS = 6                    # even: the chi-square law then has a closed form
SURE = 0.99
SAMPLE_ROWS = 20_000
CELL_ROWS = 1_024
MOST_CELLS = 4_096
FIRST_CELLS = 2
QUERY_ROWS = 4_096          # queries of one group at most, about
STEP = 256                  # rows verified between two stopping tests
QUERY_MOD = 100
SEED = 41


def chi_square(x: np.ndarray) -> np.ndarray:
    """P(chi-square with DIMS degrees of freedom <= x)."""
    h = np.minimum(np.asarray(x, float) / 2, 700.0)
    term, total = np.ones_like(h), np.ones_like(h)
    for i in range(1, DIMS // 2):
        term = term * h / i
        total = total + term
    return 1 - np.exp(-h) * total


@dataclass
class Tree:
    """kd-tree over projections; cell numbers are the leaves from left to right."""
    directions: np.ndarray      # (length, DIMS)
    axis: np.ndarray            # inner nodes in heap order
    split: np.ndarray
    depth: int

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.directions

    def cell(self, p: np.ndarray) -> np.ndarray:
        at = np.zeros(len(p), int)
        for _ in range(self.depth):
            right = p[np.arange(len(p)), self.axis[at]] > self.split[at]
            at = 2 * at + 1 + right
        return at - ((1 << self.depth) - 1)

    def distances(self, p: np.ndarray) -> np.ndarray:
        """Squared projected distance from each point to each cell's region: (points, cells)."""
        low = np.full((1, DIMS), -np.inf)
        high = np.full((1, DIMS), np.inf)
        for level in range(self.depth):
            nodes = np.arange((1 << level) - 1, (1 << (level + 1)) - 1)
            low, high = np.repeat(low, 2, 0), np.repeat(high, 2, 0)
            i = np.arange(len(nodes))
            high[2 * i, self.axis[nodes]] = self.split[nodes]
            low[2 * i + 1, self.axis[nodes]] = self.split[nodes]
        out = np.zeros((len(p), len(low)))
        for a in range(DIMS):
            gap = np.maximum(np.maximum(low[:, a] - p[:, a:a + 1], p[:, a:a + 1] - high[:, a]), 0)
            out += gap * gap
        return out


def build(sample: np.ndarray, rows: int, seed: int = SEED) -> Tree:
    """Tree with about rows / CELL_ROWS cells, splits at medians of the sample's widest axis."""
    directions = np.random.default_rng(seed).standard_normal((sample.shape[1], DIMS))
    depth = max(0, min(int(math.log2(MOST_CELLS)), math.ceil(math.log2(max(1, rows / CELL_ROWS)))))
    axis, split = np.zeros((1 << depth) - 1, int), np.full((1 << depth) - 1, np.inf)
    parts = {0: sample @ directions}
    for node in range(len(axis)):
        p = parts.pop(node)
        if len(p):
            axis[node] = int((np.quantile(p, 0.9, axis=0) - np.quantile(p, 0.1, axis=0)).argmax())
            split[node] = float(np.median(p[:, axis[node]]))
        right = p[:, axis[node]] > split[node]
        parts[2 * node + 1], parts[2 * node + 2] = p[~right], p[right]
    return Tree(directions, axis, split, depth)


def best_of(q: np.ndarray, qid: int, ids: np.ndarray, x: np.ndarray, near: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k best (distance, id) of one block for one query; ``near``: squared projected distances."""
    order = np.argsort(near, kind="stable")
    best: list[tuple[float, int]] = []
    for a in range(0, len(order), STEP):
        if len(best) == k and best[-1][0] > 0 and chi_square(near[order[a]] / best[-1][0]**2) >= SURE:
            break
        rows = order[a:a + STEP]
        d = x[rows] - q
        d = np.sqrt((d * d).sum(1))
        if len(best) == k:
            rows, d = rows[d <= best[-1][0]], d[d <= best[-1][0]]
        least: dict[int, float] = {}            # an id may have several vectors
        for s, i in sorted(best + [(float(s), int(i)) for s, i in zip(d, ids[rows]) if i != qid]):
            least.setdefault(i, s)
        best = [(s, i) for i, s in least.items()][:k]
    return best


def search(vectors: DataFrame, k: int = K, query_mod: int = QUERY_MOD, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for every row with id % query_mod = 0."""
    spark = vectors.sparkSession
    bad = F.exists(vector_col, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists(vector_col, lambda v: v != 0)
    rows = (vectors.where(F.col(id_col).isNotNull()).where(F.col(vector_col).isNotNull() & ~bad & some)
                   .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
                   .withColumn("n", F.size("v")))
    out = None
    for n, count in sorted((r["n"], r["count"]) for r in rows.groupBy("n").count().collect()):   # lengths, a few
        part = _search(rows.where(F.col("n") == n).select("id", "v"), count, k, query_mod)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


def _search(rows: DataFrame, count: int, k: int, query_mod: int) -> DataFrame:
    sample = rows.distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).toPandas()     # bounded
    tree = build(np.array(sample["v"].tolist(), float), count)

    @F.pandas_udf("int")
    def cell_of(v: pd.Series) -> pd.Series:
        return pd.Series(tree.cell(tree.project(np.array(v.tolist(), float))).astype(np.int32))

    placed = cut_lineage(rows.distinct().withColumn("cell", cell_of("v")))
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}    # at most MOST_CELLS rows
    cells = np.array(sorted(sizes))
    blocks = np.array([-(-sizes[c] // CELL_ROWS) for c in cells])
    queries = rows.where(F.col("id") % query_mod == 0).distinct()
    spread = F.create_map(*[F.lit(int(x)) for c, b in zip(cells, blocks) for x in (c, b)])
    table = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.get(F.array(spread), 0)[F.col("cell")]).cast("int"))
    queries = queries.withColumn("bound", F.lit(float("inf")))

    def visits(first: bool):
        @F.pandas_udf("array<struct<cell: int, block: int>>")
        def of(v: pd.Series, bound: pd.Series) -> pd.Series:
            far = tree.distances(tree.project(np.array(v.tolist(), float)))[:, cells]
            out = []
            for f, b in zip(far, bound):
                if first:
                    go = np.argsort(f, kind="stable")[:FIRST_CELLS]
                elif not np.isfinite(b):
                    go = np.arange(len(cells))
                elif b == 0:
                    go = np.flatnonzero(f == 0)         # what is at distance 0 has the same projection
                else:
                    go = np.flatnonzero(chi_square(f / b**2) < SURE)
                out.append([(int(cells[c]), j) for c in go for j in range(blocks[c])])
            return pd.Series([[{"cell": c, "block": j} for c, j in o] for o in out])
        return of

    def verify(key, data, asked):
        ids, x = data["id"].to_numpy(), np.array(data["v"].tolist(), float).reshape(len(data), -1)
        out = []
        if len(ids) and len(asked):
            p, pq = tree.project(x), tree.project(np.array(asked["v"].tolist(), float))
            for qid, q, pr in zip(asked["id"], asked["v"], pq):
                near = ((p - pr) ** 2).sum(1)
                out += [(qid, i, s) for s, i in best_of(np.asarray(q, float), qid, ids, x, near, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        go = asked.withColumn("at", F.explode(visits(first)("v", "bound"))).select("id", "v", "at.cell", "at.block")
        # a block that very many queries visit meets them in parts; the others are not copied, unvisited ones do not go on
        loads = cut_lineage(go.groupBy("cell", "block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts")))
        go = go.join(loads, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
        visited = table.join(loads, ["cell", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        keys = ["cell", "block", "part"]
        found = visited.groupBy(*keys).cogroup(go.groupBy(*keys)).applyInPandas(verify, "query_id long, vec_id long, score double")
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = cut_lineage(visit(queries, True))
    bound = (near.groupBy("query_id").agg(F.count("*").alias("found"), F.max("score").alias("worst"))
                 .select(F.col("query_id").alias("id"), F.when(F.col("found") >= k, F.col("worst")).alias("worst")))
    asked = (queries.drop("bound").join(bound, "id", "left")
                    .withColumn("bound", F.coalesce("worst", F.lit(float("inf")))).drop("worst"))
    return visit(asked, False).select("query_id", "rank", "vec_id", "score")
