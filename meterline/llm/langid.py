"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a label by forward-backward, so code-switched text is labelled
word by word; a document's language is the one with the largest sum of word marginals, its
score that sum's share.  A word that a text repeats counts once, with its mean marginal: a
phrase repeated a hundred times is no hundredfold evidence.

Features of a word: hashed prefixes, suffixes and character n-grams, and the word itself if
the training sample's lexicon has it (with the lexicon's majority language as a further
feature).  Emission and transition weights are learned together by stochastic gradient
on the log-likelihood of label sequences (AdaGrad).

The training sample is bounded: ``TRAIN_DOCS`` documents of each language (smallest id hashes)
and ``WINDOWS`` evenly spaced windows of ``WINDOW`` words of each.  Documents have one label, so
training sequences splice windows of different documents: the transitions see
switches at window borders.

Inference is exact and whole-text: the words of many texts form one chain with restarts, cut
into equal blocks whose 4x4-like transfer matrices are multiplied side by side in numpy, so
a very long text costs as much a word as short ones.

Edge cases: a null text, an empty one and one without a letter are ``und`` with score 0;
with no training rows every text is ``und``; repeated rows get equal results; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import doc_crc

TRAIN_DOCS = 300
WINDOWS = 4
WINDOW = 24
SPLICE = 3              # windows of a training sequence
BUCKETS = 1 << 16
EPOCHS = 6
RATE = 0.3
HELD_OUT_MOD, HELD_OUT_REST = 4, 2
LEAST_SCORE = 0.3       # documents below are rejected by ``keep_known``
CHAIN = 200_000         # words labelled at once
CACHE = 200_000         # words whose emissions a task remembers
UNKNOWN = "und"

LONGEST = 48            # letters of a word; longer runs, as in scripts without spaces, are cut into such words

_WORD = re.compile(r"[^\W\d_]{1,%d}" % LONGEST)


def words_of(text: str) -> list[str]:
    text = text.lower()
    words = _WORD.findall(text)
    if all(map(str.isalpha, words)):
        return words
    # some word characters are neither digits nor letters: fractions, superscripts, letter-like numbers
    return _WORD.findall("".join(c if c.isalpha() else " " for c in text))


def _buckets(codes: np.ndarray, at: np.ndarray, k: int, kind: int) -> np.ndarray:
    """Hash buckets of the k letters from each place ``at`` on."""
    h = np.full(len(at), 8 * kind + k, np.uint64)
    for j in range(k):
        h = (h ^ codes[at + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str]):
    """Feature buckets of many words at once: (letter grams, their words' starts, affixes).

    Letter grams: [(buckets by letter, valid)]; affixes: [(buckets by word, valid)].  Words are read with
    a border mark on both sides.
    """
    marked = [f"^{w}$" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    codes = np.r_[np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32), np.zeros(4, np.uint32)].astype(np.uint64)
    letters = np.arange(ends[-1] if len(ends) else 0)
    room = np.repeat(ends, sizes) - letters
    grams = [(_buckets(codes, letters, k, 0), room >= k) for k in (1, 2, 3)]
    affixes = [(_buckets(codes, starts, k, 1), sizes >= k) for k in (2, 3, 4)]
    affixes += [(_buckets(codes, np.maximum(ends - k, 0), k, 2), sizes >= k) for k in (2, 3, 4)]
    return grams, starts, affixes


def lexicon_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """The word itself and its majority language, if the lexicon has it."""
    if word not in lexicon:
        return []
    return [zlib.crc32(x.encode()) % BUCKETS for x in (f"={word}", f"lex{lexicon[word]}")]


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


@dataclass
class Field:
    """A trained random field."""
    labels: list[str]
    lexicon: dict[str, int]
    emit: np.ndarray            # (buckets, labels)
    move: np.ndarray            # (labels, labels)
    begin: np.ndarray           # (labels,)
    known: dict[str, int] = field(default_factory=dict)         # word -> row of ``table``
    table: np.ndarray | None = None

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp of emission scores, the largest of a word being 1; distinct words are scored once."""
        if self.table is None or len(self.known) > CACHE:
            self.known, self.table = {}, np.empty((0, len(self.labels)))
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            grams, starts, affixes = features(new)
            score = sum(np.add.reduceat(self.emit[b] * ok[:, None], starts, axis=0) for b, ok in grams)
            score += sum(self.emit[b] * ok[:, None] for b, ok in affixes)
            for i, w in enumerate(new):
                if w in self.lexicon:
                    score[i] += self.emit[lexicon_features(w, self.lexicon)].sum(0)
            score = np.exp(np.maximum(score - score.max(1, keepdims=True), -50))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.table = np.concatenate([self.table, score])
        return self.table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    def marginals(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Word marginals of one chain of ``e`` (words, labels); ``first`` marks the texts' first words."""
        n, k = e.shape
        block = max(1, int(np.sqrt(n)))
        rows = -(-n // block)
        e = np.concatenate([e, np.ones((rows * block - n, k))]).reshape(rows, block, k)
        restart = np.r_[first, np.ones(rows * block - n, bool)].reshape(rows, block)
        move = np.exp(self.move - self.move.max())
        begin = np.exp(self.begin - self.begin.max())

        def ahead(v, c):                                # v (rows, ..., k) over word c of each block
            out = v @ move
            s = restart[:, c]
            if s.any():
                out[s] = v[s].sum(-1, keepdims=True) * begin
            out = out * (e[:, c, None, :] if v.ndim == 3 else e[:, c])
            return out / out.max(tuple(range(1, out.ndim)), keepdims=True)

        product = np.broadcast_to(np.eye(k), (rows, k, k)).copy()
        for c in range(block):
            product = ahead(product, c)
        enter = np.empty((rows, k))                     # forward vector before each block
        leave = np.empty((rows, k))                     # backward vector after each block
        v = np.full(k, 1.0)
        for r in range(rows):
            enter[r] = v
            v = v @ product[r]
            v /= v.max()
        v = np.full(k, 1.0)
        for r in range(rows - 1, -1, -1):
            leave[r] = v
            v = product[r] @ v
            v /= v.max()
        forward = np.empty_like(e)
        v = enter
        for c in range(block):
            v = forward[:, c] = ahead(v, c)
        backward = np.empty_like(e)
        v = leave
        for c in range(block - 1, -1, -1):
            backward[:, c] = v
            w = v * e[:, c]
            out = w @ move.T
            s = restart[:, c]
            if s.any():
                out[s] = (w[s] @ begin)[:, None]
            v = out / out.max(1, keepdims=True)
        got = (forward * backward).reshape(-1, k)[:n]
        return got / got.sum(1, keepdims=True)

    def predict(self, texts) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.labels:
            return names, scores
        todo, words, sizes, weights = [], [], [], []

        def flush():
            if todo:
                starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(int)
                first = np.zeros(len(words), bool)
                first[starts] = True
                got = self.marginals(self.emissions(words), first) / np.array(weights, float)[:, None]
                share = np.add.reduceat(got, starts, axis=0)
                share /= share.sum(1, keepdims=True)
                for i, s in zip(todo, share):
                    best = int(s.argmax())
                    names[i], scores[i] = self.labels[best], float(min(1.0, s[best]))
            todo.clear(), words.clear(), sizes.clear(), weights.clear()

        for i, t in enumerate(texts):
            w = words_of(t) if t else []
            if w:
                times = Counter(w)
                todo.append(i), words.extend(w), sizes.append(len(w)), weights.extend(map(times.__getitem__, w))
                if len(words) >= CHAIN:
                    flush()
        flush()
        return names, scores


def train(samples: list[tuple[str, list[str]]], seed: int = 7) -> Field:
    """A field from (language, words) windows of at most ``WINDOW`` words."""
    samples = sorted({(lang, tuple(words)) for lang, words in samples if words})     # copies count once
    labels = sorted({s[0] for s in samples})
    k = len(labels)
    number = {x: i for i, x in enumerate(labels)}
    seen: dict[str, Counter] = {}
    for lang, words in samples:
        for w in words:
            seen.setdefault(w, Counter())[number[lang]] += 1
    lexicon = {w: c.most_common(1)[0][0] for w, c in seen.items() if c.total() >= 3}
    out = Field(labels, lexicon, np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return out
    vocabulary = {w: i + 1 for i, w in enumerate(seen)}                     # 0 pads
    grams, starts, affixes = features(list(vocabulary))
    at: list[list[int]] = [[]] + [lexicon_features(w, lexicon) for w in vocabulary]
    words_at = np.repeat(np.arange(len(vocabulary)), np.diff(np.r_[starts, len(grams[0][0])]))
    for found, of in [*((g, words_at) for g in grams), *((a, np.arange(len(vocabulary))) for a in affixes)]:
        for word, bucket in zip(of[found[1]].tolist(), found[0][found[1]].tolist()):
            at[word + 1].append(bucket)
    widest = max(map(len, at))
    index = np.array([x + [BUCKETS] * (widest - len(x)) for x in at])       # bucket BUCKETS is always 0
    emit = np.zeros((BUCKETS + 1, k))
    ids = np.zeros((len(samples), WINDOW), int)
    for row, (_, words) in zip(ids, samples):
        row[:len(words)] = [vocabulary[w] for w in words]
    lang = np.array([number[s[0]] for s in samples])
    rng = np.random.default_rng(seed)
    sums = [np.full(a.shape, 1e-2) for a in (emit, out.move, out.begin)]
    batch = 48
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        order = np.r_[order, order[:-len(order) % SPLICE]].reshape(-1, SPLICE)
        for b in range(0, len(order), batch):
            o = order[b:b + batch]
            x = ids[o].reshape(len(o), -1)
            y = np.repeat(lang[o], WINDOW, axis=1)
            live = x > 0
            # words to the front of each sequence, padding behind
            front = np.argsort(~live, axis=1, kind="stable")
            x, y, live = (np.take_along_axis(a, front, 1) for a in (x, y, live))
            steps = int(live.sum(1).max())
            x, y, live = x[:, :steps], y[:, :steps], live[:, :steps]
            score = emit[index[x]].sum(2)                                   # (sequences, steps, k)
            f = np.empty_like(score)
            f[:, 0] = out.begin + score[:, 0]
            for t in range(1, steps):
                f[:, t] = np.where(live[:, t, None], _logsum(f[:, t - 1, :, None] + out.move, 1) + score[:, t], f[:, t - 1])
            g = np.zeros_like(score)
            for t in range(steps - 2, -1, -1):
                g[:, t] = np.where(live[:, t + 1, None],
                                   _logsum(out.move + (score[:, t + 1] + g[:, t + 1])[:, None, :], 2), g[:, t + 1])
            z = _logsum(f[:, -1], 1)
            p = np.exp(f + g - z[:, None, None]) * live[:, :, None]
            gold = np.eye(k)[y] * live[:, :, None]
            diff = p - gold
            pair = np.exp(f[:, :-1, :, None] + out.move + (score[:, 1:] + g[:, 1:])[:, :, None, :] - z[:, None, None, None])
            both = live[:, 1:, None, None]
            d_move = (pair * both).sum((0, 1)) - (gold[:, :-1, :, None] * gold[:, 1:, None, :]).sum((0, 1))
            buckets = index[x].ravel()
            d_emit = np.stack([np.bincount(buckets, np.repeat(diff[:, :, j].ravel(), widest), BUCKETS + 1)
                               for j in range(k)], 1)
            d_emit[BUCKETS] = 0
            for weights, grad, total in zip((emit, out.move, out.begin), (d_emit, d_move, diff[:, 0].sum(0)), sums):
                grad = grad / len(o)
                total += grad**2
                weights -= RATE * grad / np.sqrt(total)
    out.emit = emit[:BUCKETS]
    return out


# --- Spark ----------------------------------------------------------------------------------

def held_out(c: str = "doc_id") -> Column:
    return doc_crc(c) % HELD_OUT_MOD == HELD_OUT_REST


def fit(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Field:
    """Train on at most ``per_language`` documents of each language outside the held-out quarter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    rows = rows.where("lang is not null and text is not null and id is not null").where(~held_out("id"))
    order = F.struct(F.xxhash64("id"), "id")
    # first salted parts of each language, then the languages: a language may hold most rows
    # one row an id, so that repeated rows neither crowd out other ids nor multiply below
    ids = (rows.groupBy("id").agg(F.min("lang").alias("lang"))
               .select("id", "lang", F.pmod(F.xxhash64("id"), F.lit(16)).alias("salt")))
    for keys in (["lang", "salt"], ["lang"]):
        ids = (ids.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
                  .where(F.col("nth") <= per_language).drop("nth"))

    @F.pandas_udf("array<array<string>>")
    def windows(text: pd.Series) -> pd.Series:
        out = []
        for t in text:
            w = words_of(t)
            n = min(WINDOWS, -(-len(w) // WINDOW))
            at = [int(i * max(0, len(w) - WINDOW) / max(1, n - 1)) for i in range(n)]
            out.append([w[a:a + WINDOW] for a in at])
        return pd.Series(out)

    # at most per_language ids of each language; of an id's texts the one with the smallest hash (then the smallest) counts
    sample = (rows.join(F.broadcast(ids.select("id", "lang")), ["id", "lang"])
                  .groupBy("id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
                  .select("lang", windows("t.text").alias("w"), "id").collect())
    return train([(r["lang"], list(w)) for r in sorted(sample, key=lambda r: r["id"]) for w in r["w"]])


def predictor(model: Field):
    """Column expression: text -> struct(lang_pred, score)."""
    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(text: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(text.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row."""
    found = predictor(fit(docs))
    return (docs.select("doc_id", held_out().alias("held_out"), found("text").alias("p"))
                .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) with a language and a score of ``LEAST_SCORE`` or more."""
    found = predictor(fit(docs))
    rows = docs.select(F.struct(*docs.columns).alias("row"), found(F.col("text")).alias("p"))
    return rows.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= LEAST_SCORE)).select("row.*")
