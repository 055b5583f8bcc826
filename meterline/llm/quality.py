"""Quality classifier: histogram gradient-boosted trees over document statistics.

``fit`` trains on a bounded sample of labelled documents (``TRAIN_ROWS``, smallest id
hashes first); ``scorer`` makes a column expression that scores every whole text.
Statistics are computed where the text is; only the sample's statistics (some 30 floats
a row) reach the driver.  The trees are stored as flat arrays (feature, threshold, left,
right, value), and a batch walks all trees at once, level by level, in numpy.

Edge cases: null and empty texts have all-zero statistics and get a score like any other;
with no usable labels, or labels of one kind only, every score is the base rate (0.5
without labels); a document with several labels counts as good only if all are; repeated rows get equal
scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import doc_crc, text_or_empty

TRAIN_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
RIDGE = 1.0
LEAST_WEIGHT = 5.0
THRESHOLD = 0.3
HELD_OUT_MOD = 5

_SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_RUNS = re.compile(r"[^\w\s]{2,}")


# --- statistics -----------------------------------------------------------------------------

def statistics(text: str) -> list[float]:
    """Statistics of one whole text; all zero if it has no characters."""
    if not text:
        return [0.0] * N_STATISTICS
    raw = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    seen = Counter(words)
    pairs = set(zip(words, words[1:]))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    symbols = counts[list(_SYMBOLS)]
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    top = seen.most_common(1)[0][1] if seen else 0
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)),
        sizes.mean(), sizes.std(), sizes.max(), np.mean(sizes <= 2),
        upper / n, lower / n, upper / max(1, upper + lower), counts[48:58].sum() / n, counts[128:].sum() / n,
        counts[[9, 10, 11, 12, 13, 32]].sum() / n, symbols.sum() / n, symbols.max() / n,
        counts[ord(".")] / n_words, counts[ord(",")] / n_words, counts[ord("|")] / n_words, counts[ord("!")] / n_words,
        (counts[list(b"#$%&*")].sum()) / n_words, counts[list(b"@/:")].sum() / n_words,
        len(_RUNS.findall(text)) / n_words,
        len(seen) / n_words, (len(pairs) + 1) / n_words, top / n_words,
        len(set(lines)) / n_lines, max(map(len, lines), default=0) / n, n / n_lines,
        len(zlib.compress(raw, 1)) / n, float(raw[-1:].isalnum()),
    ]


N_STATISTICS = 30


def _matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, N_STATISTICS)


# --- trees ----------------------------------------------------------------------------------

@dataclass
class Trees:
    """Trees as flat arrays; a leaf points to itself."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for a in range(0, len(x), 4096):
            part = x[a:a + 4096]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(DEPTH):
                at = np.where(part[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[a:a + 4096] = 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))
        return out


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees with logistic loss; splits are searched in histograms of binned statistics."""
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node(v=0.0):
        i = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(i), right.append(i), value.append(v)
        return i

    if len(y) and 0 < y.mean() < 1:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
        margin = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            roots.append(node())
            where = np.full(len(y), roots[-1])                # node of each row
            level = [roots[-1]]
            for _ in range(DEPTH):
                slot = np.full(len(feature), -1)
                slot[level] = np.arange(len(level))
                of = slot[where]
                active = np.flatnonzero(of >= 0)
                shape = (len(level), x.shape[1], BINS)
                flat = (of[active, None] * x.shape[1] + np.arange(x.shape[1])) * BINS + binned[active]
                size = int(np.prod(shape))
                gs = np.bincount(flat.ravel(), np.repeat(g[active], x.shape[1]), size).reshape(shape).cumsum(2)
                hs = np.bincount(flat.ravel(), np.repeat(h[active], x.shape[1]), size).reshape(shape).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + RIDGE) + (gt - gs)**2 / (ht - hs + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hs < LEAST_WEIGHT) | (ht - hs < LEAST_WEIGHT)] = -1
                below = []
                for s, parent in enumerate(level):
                    f, b = np.unravel_index(gain[s].argmax(), gain[s].shape)
                    if gain[s, f, b] <= 1e-6 or b >= len(edges[f]):
                        continue
                    feature[parent], threshold[parent] = int(f), float(edges[f][b])
                    left[parent], right[parent] = node(), node()
                    mine = active[of[active] == s]
                    where[mine] = np.where(binned[mine, f] <= b, left[parent], right[parent])
                    below += [left[parent], right[parent]]
                level = below
                if not level:
                    break
            n = len(feature)
            gain_ = np.bincount(where, g, n), np.bincount(where, h, n)
            leaf = -RATE * gain_[0] / (gain_[1] + RIDGE)
            for i in np.unique(where):
                value[i] = float(leaf[i])
            margin += leaf[where]
    return Trees(base, np.array(roots, int), np.array(feature, int), np.array(threshold, float),
                 np.array(left, int), np.array(right, int), np.array(value, float))


# --- Spark ----------------------------------------------------------------------------------

def held_out(c: str = "doc_id") -> Column:
    return doc_crc(c) % HELD_OUT_MOD == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Train on at most ``rows`` labelled documents outside the held-out fifth."""
    chosen = (labels.where("quality is not null and doc_id is not null").where(~held_out())
                    .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality"))
                    .orderBy(F.xxhash64("id"), "id").limit(rows))

    @F.pandas_udf("array<double>")
    def stats(text: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(text)))

    # at most ``rows`` ids; of an id's texts the one with the smallest hash (then the smallest) counts
    sample = (docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
                  .join(F.broadcast(chosen), "id")
                  .groupBy("id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
                  .select("id", "quality", stats("t.text").alias("x")).toPandas().sort_values("id"))
    x = np.array(sample["x"].tolist(), float).reshape(-1, N_STATISTICS)
    return train(x, (sample["quality"].to_numpy() > 0).astype(float))


def scorer(model: Trees):
    """Column expression: text -> score in 0..1."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(text)))

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row."""
    score = scorer(fit(docs, labels))
    return (docs.select("doc_id", held_out().alias("held_out"), score(text_or_empty()).alias("score"))
                .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier does not reject."""
    return docs.where(scorer(fit(docs, labels))(text_or_empty()) >= THRESHOLD)
