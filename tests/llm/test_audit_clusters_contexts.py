"""Filter audit, bit-plane clustering and context-tree scores against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

from meterline.llm import bitplanes, contexttree, filteraudit

# --- filter audit -------------------------------------------------------------------------------

PROSE = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, PROSE, "a"), (2, PROSE, "a"), (3, PROSE, "b"), (3, PROSE, "b"), (4, "short", "a"), (5, None, None), (6, "", None),
    (7, "same " * 80, "b"), (8, "SHOUT " * 80, "a"), (9, PROSE + " #", "a"), (10, PROSE.upper() + " 100 %", "b"),
    (None, PROSE, "a"), (None, "x", None), (11, " ".join(["one"] * 70), "a"), (12, "  " + PROSE + "\n\t", "a"), (13, "", "b"),
    (14, "$" * 50_000 + " A" * 3000, "b"), (15, "short", ""),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 1, 0), (4, 0, 0), (7, None, 1), (8, 1, None), (None, 1, 1), (10, 1, 1), (99, 1, 1)]
DOC_SCHEMA = "doc_id long, text string, source string, mask int, good int, n long, step string"
LABEL_SCHEMA = "doc_id long, quality int, toxic int, part string"


def audit_by_rows():
    good = {i for i, q, _ in LABELS if q == 1 and i is not None}
    toxic = {i for i, _, t in LABELS if t == 1 and i is not None}
    rows = []
    for doc, text, source in DOCS:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in DOCS):
            fails.add("E")
        rows.append((source or "", fails, doc in good, doc in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone),
                                          sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_every_order_applied_by_rows(spark):
    docs = spark.createDataFrame([(*d, 1, 1, 5, "x") for d in DOCS], DOC_SCHEMA).repartition(3)
    labels = spark.createDataFrame([(*x, "p") for x in LABELS], LABEL_SCHEMA)
    got = filteraudit.audit_documents(docs, labels)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == audit_by_rows()
    assert got.count() == 3 * 120 * 5
    assert filteraudit.audit_documents(docs.limit(0), labels).count() == 0
    bare = filteraudit.audit_documents(docs, labels.limit(0)).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()
    assert tuple(bare) == (0, 0)


@pytest.mark.parametrize("n", [2, 3, 5])
def test_shapley_matrix_is_the_average_of_marginal_gains(n):
    rng = np.random.default_rng(n)
    game = [0] + [int(x) for x in rng.integers(-50, 50, (1 << n) - 1)]
    matrix = filteraudit.shapley_matrix(n)
    for i in range(n):
        gains = [game[sum(1 << j for j in p[:p.index(i) + 1])] - game[sum(1 << j for j in p[:p.index(i)])]
                 for p in permutations(range(n))]
        assert sum(w * v for w, v in zip(matrix[i], game)) == Fraction(sum(gains), len(gains))


# --- bit-plane clustering -----------------------------------------------------------------------

def clusters_by_rows(rows, k=16, rounds=3):
    """Plain Python integers throughout."""
    kept = [(i, [math.floor(Fraction(64) * Fraction(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    cent = [v for _, v in first[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cent]
        return min(range(len(cent)), key=lambda i: (d[i], i)), min(d)

    for _ in range(rounds):
        at = [near(v)[0] for _, v in kept]
        for c in range(len(cent)):
            mine = [v for (_, v), a in zip(kept, at) if a == c]
            if mine:
                cent[c] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, *near(v)) for i, v in kept]
    sums = Counter()
    for _, c, d in out:
        sums[c] += d
    whole = sum(sums.values())

    def fit(x):
        return x if x < 1 << 63 else None

    return [(i, c, fit(d), fit(sums[c]), fit(whole), hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest()) for i, c, d in out]


def run_clusters(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, "e", 1, 2) for i, v in rows],
                               f"vec_id long, embedding array<{kind}>, planes string, cluster int, distance int").repartition(3)
    return sorted((tuple(r) for r in bitplanes.cluster(df).collect()), key=repr)


def test_clusters_equal_plain_integers(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3 * (1 + i % 4), 64)]) for i in range(300)]
    rows += [(400, rows[7][1]), (7, rows[7][1]), (None, rows[9][1]), (500, [0.0] * 64), (501, [-0.0] * 64), (502, [-1 / 64] * 64)]
    bad = [(600, None), (601, [0.5] * 63), (602, [0.5] * 65), (603, [None] + [0.5] * 63), (604, [math.nan] + [0.5] * 63),
           (605, [math.inf] + [0.5] * 63), (606, [])]
    assert run_clusters(spark, rows + bad) == sorted(clusters_by_rows(rows + bad), key=repr)


def test_clusters_of_few_equal_huge_and_no_vectors(spark):
    some = [(i, [float(i)] * 64) for i in range(5)]
    assert run_clusters(spark, some) == sorted(clusters_by_rows(some), key=repr)
    same = [(i, [0.25] * 64) for i in range(40)]
    assert run_clusters(spark, same) == sorted(clusters_by_rows(same), key=repr)
    huge = [(i, [(-1.0) ** i * 10.0 ** (i * 3)] * 64) for i in range(1, 20)]
    assert run_clusters(spark, huge) == sorted(clusters_by_rows(huge), key=repr)
    assert run_clusters(spark, []) == [] and run_clusters(spark, [(1, None)]) == []


def test_popcount_products_are_exact():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-5000, 5000, (40, 64)), rng.integers(-300, 300, (6, 64))
    assert (bitplanes.dots(bitplanes.pack(x), bitplanes.pack(c)) == x @ c.T).all()
    assert (bitplanes.own_dots(bitplanes.pack(x)) == (x * x).sum(1)).all()
    assert bitplanes.unpack(bitplanes.pack(x)[3]) == x[3].tolist()


# --- context-tree weighting -----------------------------------------------------------------------

TEXTS = [(1, "Ab abc ab\tabd ab"), (2, "abc abc  abc"), (3, ""), (4, None), (5, "ÉTÉ été abc"), (5, "ÉTÉ été abc"), (None, "abc"), (7, "  "),
         (8, "zz " * 40 + "q" * 90), (9, "abc"), (10, "abd ab"), (11, "the cat sat"), (12, "cat the sat the"), (13, "ab")]
D = 2


def training(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 != 0


def sequence(text):
    raw = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode()
    return b"\xff" * D + raw + b"\xfe"


def kt(a, b):
    """Block probability as the product of the sequential estimates."""
    p = Fraction(1)
    for i in range(a):
        p *= Fraction(2 * i + 1, 2 * (i + 1))
    for j in range(b):
        p *= Fraction(2 * j + 1, 2 * (a + j + 1))
    return p


class Tree:
    """Context trees in rationals, straight from the definition."""

    def __init__(self, texts):
        self.n = Counter()
        for t in texts:
            s = sequence(t)
            for i in range(D, len(s)):
                for d in range(D + 1):
                    for place, bit in self.path(s[i]):
                        self.n[s[i - d:i], place, bit] += 1
        self.weighted = {}

    @staticmethod
    def path(byte):
        return [((1 << i) | (byte >> (8 - i)), byte >> (7 - i) & 1) for i in range(8)]

    def pe(self, ctx, place):
        return kt(self.n[ctx, place, 0], self.n[ctx, place, 1])

    def pw(self, ctx, place):
        key = ctx, place
        if key not in self.weighted:
            p = self.pe(*key)
            if len(ctx) < D and self.n[ctx, place, 0] + self.n[ctx, place, 1]:
                kids = math.prod((self.pw(bytes([b]) + ctx, place) for b in range(256)), start=Fraction(1))
                p = (p + kids) / 2
            elif len(ctx) < D:
                p = Fraction(1)
            self.weighted[key] = p
        return self.weighted[key]

    def chance(self, s, i):
        out = Fraction(1)
        for place, bit in self.path(s[i]):
            left, p = Fraction(1), Fraction(0)
            for d in range(D + 1):
                ctx = s[i - d:i]
                w = left * (1 if d == D else self.pe(ctx, place) / 2 / self.pw(ctx, place))
                n = [self.n[ctx, place, 0], self.n[ctx, place, 1]]
                p += w * Fraction(2 * n[bit] + 1, 2 * sum(n) + 2)
                left -= w
            out *= p
        return out


def scores_by_rows(rows):
    tree = Tree([t for i, t in rows if training(i)])
    words = Counter()
    split = [re.findall(r"[^\x20\x09-\x0D]+", sequence(t)[D:-1].decode()) + ["\n"] for _, t in rows]
    for (i, _), w in zip(rows, split):
        if training(i):
            words.update(w)
    total = sum(words.values())
    scale = total + 0.1 * (len(words) + 1)
    out = []
    for (i, t), w in zip(rows, split):
        s = sequence(t)
        score = sum(math.log10(tree.chance(s, j)) for j in range(D, len(s)))
        out.append((i, not training(i), len(w), sum(words[x] > 0 for x in w), total,
                    sum(math.log10((words[x] + 0.1) / scale) for x in w), score, -score / math.log10(2) / (len(s) - D)))
    return out


def run_scores(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id long, text string, block int, word string, gram int")
    return [tuple(r) for r in contexttree.score_documents(df.repartition(2), **options).collect()]


def same(got, want):
    def order(rows):
        return sorted(rows, key=lambda r: (r[0] or -1, r[2], round(r[6], 6)))
    assert [r[:5] for r in order(got)] == [r[:5] for r in order(want)]
    for g, w in zip(order(got), order(want)):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_scores_equal_the_definition_in_rationals(spark):
    assert {training(i) for i, _ in TEXTS} == {True, False}
    want = scores_by_rows(TEXTS)
    same(run_scores(spark, TEXTS, depth=D), want)
    # many blocks and pieces, words longer than a piece included
    same(run_scores(spark, TEXTS, depth=D, block_bytes=40, piece_bytes=5), want)


def test_scores_without_training_or_rows(spark):
    held = [(i, "ab c") for i in range(400) if not training(i)][:3]
    same(run_scores(spark, held, depth=D), scores_by_rows(held))
    for r in run_scores(spark, held, depth=D):
        assert r[6] == pytest.approx(-5 * 8 * math.log10(2)) and r[4] == 0 and r[3] == 0
    assert run_scores(spark, []) == []


def test_chances_of_all_bytes_sum_to_one(spark):
    texts = [t for i, t in TEXTS if training(i)]
    grams = Counter(int.from_bytes(s[i - D:i + 1]) for s in map(sequence, texts) for i in range(D, len(s)))
    after = int.from_bytes(b"ab") << 8
    table = [(after | b, 0) for b in range(256) if not grams[after | b]] + list(grams.items())
    got = contexttree.gram_scores(spark.createDataFrame([x for x in table if x[1] or x[0] >> 8 == after >> 8], "gram long, n long"), D)
    assert sum(10 ** r["value"] for r in got.where(f"gram div 256 = {after >> 8}").collect()) == pytest.approx(1)


def test_grams_by_tables_and_by_sorting_agree(monkeypatch):
    rng = np.random.default_rng(3)
    parts = [(b"\xff" * 4, bytes(rng.integers(97, 103, n).tolist()), last) for n, last in ((50, True), (0, True), (7, False), (30, True))]
    want = sorted({(b + p + b"\xfe" * last)[i:i + 5] for b, p, last in parts for i in range(len(p) + last)})
    for cells in (contexttree.CELLS, 0):
        monkeypatch.setattr(contexttree, "CELLS", cells)
        value, ids, sizes = contexttree.grams(parts, 4)
        assert [int(v).to_bytes(5) for v in value] == want and sizes.tolist() == [51, 1, 7, 31] and len(ids) == 90
    whole = contexttree.grams(parts, 4)
    monkeypatch.setattr(contexttree, "RUN_BYTES", 40)
    values, made = contexttree.block_grams(parts, 4)
    assert len(made) == 2 and values.tolist() == whole[0].tolist()
    assert np.concatenate([numbers[ids] for numbers, ids, _ in made]).tolist() == whole[1].tolist()
    assert list(contexttree.pieces(b"aaaa bb cc", 3)) == [(0, 4), (4, 7), (7, 10)] and list(contexttree.pieces(b"")) == [(0, 0)]
