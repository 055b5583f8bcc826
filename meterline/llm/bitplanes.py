"""Centroid clustering in integers: bit planes and popcounts.

A vector's 64 integer components are written in two's complement and packed by bit
position: plane j holds bit j of all 64 components in one uint64, the top plane has the sign
weight.  Then x . c = sum over planes i, j of w_i w_j popcount(X_i & C_j), exactly, and
|x - c|^2 = x . x - 2 x . c + c . c.  Planes are packed once, into a table in the shared
checkpoint folder (8 bytes a plane, about a quarter of the floats); each round reads only
them.  A cluster's component sums are bit counts per (cluster, plane, component): counts
of each task are added up by Spark, and the driver sees at most clusters x planes
rows, whatever the number of vectors.

Edge cases: vectors that are null, of another length, or hold a null or non-finite component take
no part; with fewer than 16 kept vectors there are as many centroids as vectors; repeated
rows each count and each come back; under one id, different vectors are ordered by their
planes; a null id hashes as the empty string; components of any magnitude are exact, but
a distance or sum that does not fit a long comes back as null; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.session import cut_lineage

WIDTH = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
#: vectors handled at once in numpy
BLOCK = 8192
LONG_MAX = (1 << 63) - 1


# --- planes -------------------------------------------------------------------------------------

def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles; Python integers where int64 could overflow."""
    if x.size == 0 or np.abs(x).max() < 2.0**54:
        return np.floor(SCALE * x).astype(np.int64)
    return np.array([[int(v) * SCALE if abs(v) >= 2.0**54 else int(np.floor(SCALE * v)) for v in row] for row in x.tolist()],
                    dtype=object).reshape(x.shape)


def pack(v: np.ndarray) -> np.ndarray:
    """(n, planes) uint64 of (n, 64) integers; the top plane is the sign."""
    top = max(int(v.max()), ~int(v.min()), 0) if v.size else 0
    planes = [np.packbits(((v >> j) & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)[:, 0]
              for j in range(top.bit_length() + 1)]
    return np.stack(planes, 1)


def lengths(planes: np.ndarray) -> np.ndarray:
    """Planes that each row needs: equal ones at the top repeat the sign."""
    n, p = planes.shape
    need = np.ones(n, np.int64)
    for j in range(1, p):
        need[planes[:, j] != planes[:, j - 1]] = j + 1
    return need


def weights(planes: int, exact) -> list:
    return [exact(1 << j) for j in range(planes - 1)] + [exact(-(1 << (planes - 1)))]


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) exact dot products of packed rows x (n, p) and c (k, q)."""
    wide = x.shape[1] + c.shape[1] + 8 > 62
    out = np.zeros((len(x), len(c)), object if wide else np.int64)
    for i, a in enumerate(weights(x.shape[1], int)):
        for j, b in enumerate(weights(c.shape[1], int)):
            bits = np.bitwise_count(x[:, i, None] & c[None, :, j])
            out += bits.astype(out.dtype) * (a * b)
    return out


def own_dots(x: np.ndarray) -> np.ndarray:
    """(n,) exact x . x of packed rows."""
    out = np.zeros(len(x), object if 2 * x.shape[1] + 8 > 62 else np.int64)
    w = weights(x.shape[1], int)
    for i, a in enumerate(w):
        for j in range(i, len(w)):
            bits = np.bitwise_count(x[:, i] & x[:, j])
            out += bits.astype(out.dtype) * (a * w[j] * (1 if i == j else 2))
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of equals) and the squared distance."""
    d = own_dots(x)[:, None] - 2 * dots(x, centroids) + own_dots(centroids)[None, :]
    best = np.argmin(d, axis=1)
    return best, d[np.arange(len(d)), best]


def unpack(planes: np.ndarray) -> list[int]:
    """Components of one packed vector."""
    w = weights(len(planes), int)
    return [sum(w[j] * (int(p) >> i & 1) for j, p in enumerate(planes)) for i in range(WIDTH)]


def read_planes(column: pa.Array) -> np.ndarray:
    """(n, most planes) uint64 of a list column; shorter rows repeat their top plane."""
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    at = np.minimum(np.arange(size.max())[None, :], size[:, None] - 1) + start[:, None]
    return flat[at]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            yield batch.slice(a, BLOCK)


# --- Spark --------------------------------------------------------------------------------------

def packed(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, planes) of the vectors that take part, written to the shared checkpoint folder."""
    v = F.col(vec_col).cast("array<double>")
    kept = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
                   .where(F.size("v") == WIDTH)
                   .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))

    def run(batches):
        for b in _blocks(batches):
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            planes = pack(integers(x))
            need = lengths(planes)
            flat = planes[np.arange(planes.shape[1])[None, :] < need[:, None]].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(need)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                             names=["vec_id", "planes"])

    return cut_lineage(kept.mapInArrow(run, "vec_id long, planes array<long>"))


def seeds(rows: DataFrame, clusters: int, seed: int) -> list[np.ndarray]:
    """Planes of the rows with the smallest hashes of seed and id, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.orderBy(F.sha2(name, 256), "planes").limit(clusters).select("planes").collect()
    return [np.array(r.planes, np.int64).view(np.uint64) for r in first]


def together(centroids: list[np.ndarray]) -> np.ndarray:
    """Packed centroids with equally many planes."""
    p = max(map(len, centroids))
    return np.stack([np.concatenate([c, np.repeat(c[-1:], p - len(c))]) for c in centroids])


def moved(rows: DataFrame, centroids: np.ndarray) -> list[np.ndarray]:
    """The centroids after one round: exact floors of the means, empty ones as they were."""
    k = len(centroids)

    def run(batches):
        counts: dict = {}                                       # (cluster, plane, sign) -> bit counts, members
        for b in _blocks(batches):
            x = read_planes(b.column(1))
            best, _ = nearest(x, centroids)
            for c in np.unique(best).tolist():
                mine = x[best == c]
                bits = np.unpackbits(np.ascontiguousarray(mine).view(np.uint8).reshape(len(mine), x.shape[1], 8), axis=2,
                                     bitorder="little").sum(0, dtype=np.int64)
                for j in range(x.shape[1]):
                    key = (c, j, j == x.shape[1] - 1)
                    old = counts.setdefault(key, [np.zeros(WIDTH, np.int64), 0])
                    old[0] += bits[j]
                    old[1] += len(mine)
        if counts:
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in keys], pa.int32()), pa.array([x[1] for x in keys], pa.int32()),
                 pa.array([x[2] for x in keys], pa.bool_()), pa.array([counts[x][1] for x in keys], pa.int64()),
                 pa.array([counts[x][0].tolist() for x in keys], pa.list_(pa.int64()))],
                names=["cluster", "plane", "sign", "members", "bits"])

    got = (rows.mapInArrow(run, "cluster int, plane int, sign boolean, members long, bits array<long>")
               .groupBy("cluster", "plane", "sign")
               .agg(F.sum("members").alias("members"), F.array(*[F.sum(F.col("bits")[i]) for i in range(WIDTH)]).alias("bits"))
               .collect())                                      # at most clusters x planes x 2
    sums, members = [[0] * WIDTH for _ in range(k)], [0] * k
    for r in got:
        w = (-1 if r.sign else 1) << r.plane
        sums[r.cluster] = [s + w * n for s, n in zip(sums[r.cluster], r.bits)]
        members[r.cluster] += r.members if r.plane == 0 else 0
    out = []
    for c in range(k):
        if members[c]:
            mean = [s // members[c] for s in sums[c]]
            small = all(abs(m) < 1 << 62 for m in mean)
            out.append(pack(np.array([mean], np.int64 if small else object))[0])
        else:
            out.append(centroids[c])
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) per row."""
    def run(batches):
        for b in _blocks(batches):
            best, d = nearest(read_planes(b.column(1)), centroids)
            fits = [int(x) if x <= LONG_MAX else None for x in d] if d.dtype == object else d
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best.astype(np.int32)), pa.array(fits, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector that takes part."""
    spark = vectors.sparkSession
    rows = packed(vectors, id_col, vec_col)
    centroids = seeds(rows, clusters, seed)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                           F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                           F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        centroids = moved(rows, together(centroids))
    result = assigned(rows, together(centroids))

    def whole(c: str) -> Column:
        """Sum of a long column, null if one of its values did not fit a long."""
        return F.when(F.count(c) == F.count("*"), F.sum(F.col(c).cast("decimal(38,0)")))

    sums = {r.cluster: r.s for r in result.groupBy("cluster").agg(whole("distance").alias("s")).collect()}    # a row a cluster

    def fit(total):
        return int(total) if total is not None and total <= LONG_MAX else None

    inertia = fit(None if None in sums.values() else sum(sums.values()))
    table = [(c, fit(sums[c]), inertia, hashlib.sha256(",".join(map(str, unpack(p))).encode()).hexdigest())
             for c, p in enumerate(centroids) if c in sums]
    return (result.join(F.broadcast(spark.createDataFrame(table, schema)), "cluster")                  # a row a cluster
                  .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same by differences of plain integers, one set of common table expressions a round."""
    steps = [f"""
kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS INTEGER) AS k, v FROM kept
    ORDER BY k LIMIT {clusters})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (SELECT x.vec_id, any_value(x.v) AS v, min({{'d': list_sum(list_transform(list_zip(x.v, c.v),
    lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'k': c.k}}) AS best FROM kept x CROSS JOIN c{r} c GROUP BY x.vec_id)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT k, list(CAST(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END AS BIGINT) ORDER BY i) AS v FROM (
    SELECT best.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2) GROUP BY k),
c{r + 1} AS (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (k))""")
    return f"""WITH {','.join(steps)}
SELECT a.vec_id, CAST(a.best.k AS INTEGER) AS cluster, CAST(a.best.d AS BIGINT) AS distance,
    CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.k = a.best.k"""


SQL = _sql()
