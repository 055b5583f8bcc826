"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions.  Each decision (one of 255 places in the byte's
binary tree) has a context tree of its own over the preceding ``DEPTH`` bytes.  A node holds
the counts of zeros and ones met there in training; its Krichevsky-Trofimov block probability
Pe depends on the counts alone, and its weighted probability is
Pw = (Pe + product of the children's Pw) / 2 (Pw = Pe at full depth).  After training, a decision's
probability mixes the estimates of all depths along its context: node s has weight
Pe(s) / 2 Pw(s) of what its ancestors left over.  A text's score is the sum of log10 over all
its bytes, lower-cased, and one end symbol; ``bits_per_byte`` is its code length.

How it runs, for texts and vocabularies of any size:

1. Texts go into blocks of ``BLOCK_BYTES`` (texts over ``PIECE_BYTES`` are cut at white space, with the
   context carried over).  Each block writes its pieces, and its different words and
   byte strings of DEPTH + 1 (grams) with their training counts, once, to the shared checkpoint folder.
2. Counts are summed over all blocks by a window per word and a grouping per gram; a block has
   one row per word, so no key is hot.  The context trees are built level by level by grouped sums, and read
   from the root down by joins; no table is collected or broadcast.
3. Each block meets the values of its own words and grams (a co-group bounded by the block size)
   and adds them up.

Edge cases: null and empty texts score the end symbol alone (one token); with no training text every
decision has probability 1/2, and the base is uniform; a null doc_id counts as the empty string for the
split into training and held-out texts; repeated rows each train and each come back; a word longer than a piece stays whole; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import doc_crc, text_or_empty
from meterline.session import cut_lineage, scratch_path

DEPTH = 4
HELD_OUT_MOD = 10
BLOCK_BYTES = 32_000_000
PIECE_BYTES = 250_000
#: bytes of a block that are turned into grams at once, and that a pack holds
RUN_BYTES = 4_000_000
PACK_BYTES = 250_000
#: bytes that UTF-8 never holds: before a text, and after it
BEFORE, END = b"\xff", b"\xfe"
#: the end as a word; words hold no white space
END_WORD = b"\n"
ADD = 0.1
#: most cells of a lookup table over (string, next byte); longer ones are sorted instead
CELLS = 16_000_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
LAYOUT = "block long, pack binary, slot int, word binary, gram long, n long"
#: a pack: pieces of one block, as a compressed Arrow stream
PACK = pa.schema([("at", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("before", pa.binary()), ("piece", pa.binary()),
                  ("last", pa.bool_())])
SCORES = ("at long, doc_id long, train boolean, n_tokens long, n_known long, n_bytes long, n_firsts long, counts_score double, "
          "score double")
#: rows that a block gets: log10 probability of a gram, training count of a word, and of a word that is counted in this block
GRAM, WORD, FIRST_WORD = 0, 1, 2


# --- one block ----------------------------------------------------------------------------------

def pieces(raw: bytes, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of the pieces of a text, cut before a white space; at least one piece."""
    start = 0
    while True:
        found = _SPACE.search(raw, start + size) if len(raw) - start > size else None
        end = found.start() if found else len(raw)
        yield start, end
        if end == len(raw):
            return
        start = end


def grams(parts: list[tuple[bytes, bytes, bool]], depth: int = DEPTH):
    """(gram values, number of each position's gram, positions of each part).

    ``parts``: (bytes before, bytes, is the text's end).  Positions are the bytes and end symbols, in
    order; the different grams are numbered in ascending order of their bytes.
    """
    sizes = np.array([len(p) + last for _, p, last in parts], np.int64)
    joined = np.frombuffer(b"".join(chain.from_iterable((b, p, END if last else b"") for b, p, last in parts)), np.uint8)
    starts = np.cumsum(sizes + depth) - sizes - depth
    valid = np.ones(len(joined) + 1, bool)
    for t in range(depth):
        valid[starts + sizes + t] = False
    where = np.flatnonzero(valid[:max(0, len(joined) - depth)])
    used = np.flatnonzero(np.bincount(joined, minlength=256))
    symbol = np.zeros(256, np.int32)
    symbol[used] = np.arange(len(used))
    s = symbol[joined]
    ids, kinds = s[:len(s) - depth], len(used)
    for t in range(1, depth + 1):
        following = s[t:len(s) - depth + t]
        if t == depth:
            ids, following = ids[where], following[where]
        if kinds * len(used) <= CELLS:
            code = ids * np.int32(len(used)) + following
            met = np.zeros(kinds * len(used), bool)
            met[code] = True
            rank = np.cumsum(met, dtype=np.int32) - 1
            ids, kinds = rank[code], int(rank[-1]) + 1
        else:
            code = ids.astype(np.int64) * len(used) + following
            some, ids = np.unique(code, return_inverse=True)
            ids, kinds = ids.astype(np.int32), len(some)
    one = np.zeros(kinds, np.int64)
    one[ids] = where                                            # a place of each gram
    value = np.zeros(kinds, np.int64)
    for t in range(depth + 1):
        value = value << 8 | joined[one + t]
    return value, ids, sizes


def runs(parts: list, piece: int, size: int) -> Iterator[list]:
    """Consecutive parts (their bytes at place ``piece``) of about ``size`` bytes together."""
    some, n = [], 0
    for part in parts:
        some.append(part)
        n += len(part[piece])
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


def block_grams(parts: list, depth: int):
    """(gram values of all parts in ascending order, [(numbers of a run's grams in them, number of each position's gram in
    the run, positions of each part)])."""
    made = [grams(some, depth) for some in runs(parts, 1, RUN_BYTES)]
    values = np.unique(np.concatenate([value for value, _, _ in made]))
    return values, [(np.searchsorted(values, value), ids, sizes) for value, ids, sizes in made]


def packed(parts: list) -> bytes:
    """Parts (at, doc_id, train, before, piece, last) as a pack."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, PACK, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*parts), PACK)], schema=PACK))
    return sink.getvalue().to_pybytes()


def _column(rows: int, /, **columns) -> pa.RecordBatch:
    """A batch of the layout with the given columns, the others null."""
    kinds = {"block": pa.int64(), "pack": pa.binary(), "slot": pa.int32(), "word": pa.binary(), "gram": pa.int64(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in kinds.items()],
                                      names=list(kinds))


def lay_out(block: int, parts: list, depth: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block: its pieces, words (slots from 0) and grams (slots from 0)."""
    for some in runs(parts, 4, PACK_BYTES):
        yield _column(1, block=[block], pack=[packed(some)])
    values, made = block_grams([p[3:] for p in parts], depth)
    train = np.array([p[2] for p in parts])
    n, at = np.zeros(len(values), np.int64), 0
    for numbers, ids, sizes in made:
        n[numbers] += np.bincount(ids[np.repeat(train[at:at + len(sizes)], sizes)], minlength=len(numbers))
        at += len(sizes)
    for a in range(0, len(values), 100_000):
        few = slice(a, a + 100_000)
        yield _column(len(values[few]), block=np.full(len(values[few]), block), gram=values[few], n=n[few],
                      slot=np.arange(a, a + len(values[few]), dtype=np.int32))
    del values, made, n
    trained, met = Counter(), set()
    for _, _, train, _, piece, last in parts:
        words = piece.split()
        trained.update(words) if train else met.update(words)
        if last:
            trained.update([END_WORD]) if train else met.add(END_WORD)
    words = sorted(met.union(trained))
    for a in range(0, len(words), 100_000):
        few = words[a:a + 100_000]
        yield _column(len(few), block=np.full(len(few), block), slot=np.arange(a, a + len(few), dtype=np.int32), word=few,
                      n=[trained[w] for w in few])


def _blocks(rows: DataFrame, depth: int, block_bytes: int, piece_bytes: int) -> DataFrame:
    """Layout of ``rows`` (doc_id, train, raw), written once to the shared checkpoint folder."""
    def run(batches):
        from pyspark import TaskContext
        number = at = TaskContext.get().partitionId() << 33
        size, parts = 0, []
        for batch in batches:
            for doc, train, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = raw.as_py().lower()                       # of bytes: A-Z only
                at += 1
                for start, end in pieces(raw, piece_bytes):
                    before = raw[max(0, start - depth):start].rjust(depth, BEFORE)
                    parts.append((at, doc, train, before, raw[start:end], end == len(raw)))
                    size += end - start + 1
                    if size >= block_bytes:
                        yield from lay_out(number, parts, depth)
                        number, size, parts = number + 1, 0, []
        if parts:
            yield from lay_out(number, parts, depth)

    spark = rows.sparkSession
    path = scratch_path(spark, f"context-blocks-{uuid.uuid4().hex}")
    rows.mapInArrow(run, LAYOUT).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(LAYOUT).parquet(path)


def score_block(parts: pa.Table, rows: pa.Table, depth: int) -> pa.Table:
    """Sums of the pieces of one block; ``parts``: its packs, ``rows``: (kind, slot, value) of its words and grams."""
    parts = pa.concat_tables(pa.ipc.open_stream(p).read_all() for p in parts["pack"].to_pylist())
    kind, slot, value = (rows[c].to_numpy() for c in ("kind", "slot", "value"))
    of_words = kind != GRAM
    counts, of_grams = np.zeros(int(of_words.sum())), np.zeros(int((~of_words).sum()))
    counts[slot[of_words]] = value[of_words]
    of_grams[slot[~of_words]] = value[~of_words]
    pieces_ = list(zip(parts["before"].to_pylist(), parts["piece"].to_pylist(), parts["last"].to_pylist()))
    score = []
    made = block_grams(pieces_, depth)[1]
    while made:
        numbers, ids, sizes = made.pop(0)
        score.append(np.add.reduceat(of_grams[numbers][ids], np.cumsum(sizes) - sizes))
    del of_grams, value, slot

    logs = np.log10(counts + ADD)
    met = set()
    for _, p, last in pieces_:
        met.update(p.split())
        if last:
            met.add(END_WORD)
    number = {w: i for i, w in enumerate(sorted(met))}
    tokens, known, base = [], [], []
    for _, p, last in pieces_:
        words = p.split() + [END_WORD] * last
        i = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        tokens.append(len(words))
        known.append(int((counts[i] > 0).sum()))
        base.append(float(logs[i].sum()))

    firsts = np.zeros(len(pieces_), np.int64)
    firsts[0] = (kind == FIRST_WORD).sum()
    return pa.table({"at": parts["at"], "doc_id": parts["doc_id"], "train": parts["train"], "n_tokens": pa.array(tokens, pa.int64()),
                     "n_known": pa.array(known, pa.int64()), "n_bytes": pa.array([len(p) for _, p, _ in pieces_], pa.int64()),
                     "n_firsts": firsts, "counts_score": pa.array(base, pa.float64()), "score": np.concatenate(score)})


# --- the context trees --------------------------------------------------------------------------

def ln_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1/2: eight steps of the recurrence, then Stirling's series."""
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    y = x + 8
    inverse = F.lit(1.0) / y
    square = inverse * inverse
    series = inverse * (F.lit(1 / 12) - square * (F.lit(1 / 360) - square * (F.lit(1 / 1260) - square * F.lit(1 / 1680))))
    # of large x the product would overflow; there the recurrence is not needed
    direct = (x - 0.5) * F.ln(x) - x + F.lit(0.9189385332046727) + F.lit(1 / 12) / x
    return F.when(x > 1e6, direct).otherwise((y - 0.5) * F.ln(y) - y + F.lit(0.9189385332046727) + series - F.ln(product))


def with_weights(nodes: DataFrame) -> DataFrame:
    """ln Pe and ln Pw of nodes (node, zeros, ones, kids); ``kids`` is the sum of the children's ln Pw, null at full depth."""
    zeros, ones = F.col("zeros").cast("double"), F.col("ones").cast("double")
    pe = ln_gamma(zeros + 0.5) + ln_gamma(ones + 0.5) - ln_gamma(zeros + ones + 1.0) - F.lit(1.1447298858494002)
    # an empty node has Pe = 1 exactly
    nodes = nodes.withColumn("pe", F.when((F.col("zeros") == 0) & (F.col("ones") == 0), F.lit(0.0)).otherwise(pe))
    high = F.greatest("pe", "kids")
    mixed = high + F.ln(F.exp(F.col("pe") - high) + F.exp(F.col("kids") - high)) - F.lit(0.6931471805599453)
    return nodes.withColumn("pw", F.when(F.col("kids").isNull(), F.col("pe")).otherwise(mixed))


def decisions(table: DataFrame) -> DataFrame:
    """The eight decisions of each gram: its columns plus node (context and place in the byte) and bit."""
    last = F.col("gram").bitwiseAND(255)
    places = []
    for i in range(8):
        place = F.shiftright(last, 8 - i).bitwiseOR(F.lit(1 << i).cast("long"))
        node = F.shiftleft(F.shiftright("gram", 8), 8).bitwiseOR(place)
        places.append(F.struct(node.alias("node"), F.shiftright(last, 7 - i).bitwiseAND(1).cast("int").alias("bit")))
    return table.withColumn("d", F.explode(F.array(*places))).select(*table.columns, "d.node", "d.bit")


def shorter(node: Column, depth: int) -> Column:
    """The node with only the last ``depth`` bytes of its context."""
    return node.bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1).cast("long"))


def gram_scores(table: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, value): log10 probability of each gram's last byte after the others, by the counts ``n``.

    ``table``: one row per gram, n its training count (0 for grams met in held-out texts only).
    """
    n = F.col("n")
    levels = {depth: cut_lineage(with_weights(
        decisions(table).groupBy("node").agg(F.sum(F.when(F.col("bit") == 0, n).otherwise(F.lit(0))).alias("zeros"),
                                             F.sum(F.when(F.col("bit") == 1, n).otherwise(F.lit(0))).alias("ones"))
        .withColumn("kids", F.lit(None).cast("double"))).select("node", "zeros", "ones", "pe", "pw"))}
    for d in range(depth - 1, -1, -1):
        levels[d] = cut_lineage(with_weights(
            levels[d + 1].groupBy(shorter(F.col("node"), d).alias("node"))
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("pw").alias("kids")))
            .select("node", "zeros", "ones", "pe", "pw"))
    state = None
    for d in range(depth + 1):
        here = levels[d]
        if state is None:
            here = here.withColumns({"left": F.lit(1.0), "p0": F.lit(0.0), "p1": F.lit(0.0)})
        else:
            here = here.withColumn("above", shorter(F.col("node"), d - 1)).join(state, "above")
        stop = F.lit(1.0) if d == depth else F.exp(F.col("pe") - F.col("pw") - F.lit(0.6931471805599453))
        weight = F.col("left") * F.least(stop, F.lit(1.0))
        total = F.col("zeros") + F.col("ones") + 1.0
        state = here.select(F.col("node").alias("above"),
                            (F.col("p0") + weight * (F.col("zeros") + 0.5) / total).alias("p0"),
                            (F.col("p1") + weight * (F.col("ones") + 0.5) / total).alias("p1"),
                            (F.col("left") - weight).alias("left"))
    chance = F.when(F.col("bit") == 1, F.col("p1")).otherwise(F.col("p0"))
    return (decisions(table.select("gram")).join(state.withColumnRenamed("above", "node"), "node")
            .groupBy("gram").agg(F.sum(F.log10(chance)).alias("value")))


# --- documents ----------------------------------------------------------------------------------

def held_out(c: str = "doc_id") -> Column:
    return doc_crc(c) % HELD_OUT_MOD == 0


def score_documents(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per row.

    ``bits_per_byte`` is the code length of text and end symbol by their number.
    """
    layout = _blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out()).alias("train"),
                                 text_or_empty().cast("binary").alias("raw")), depth, block_bytes, piece_bytes)
    words = layout.where("word is not null").select("block", "slot", "word", "n")
    tokens = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    one = Window.partitionBy("word")
    total = F.sum("n").over(one)
    # a trained word counts as a kind of word in one block
    kind = F.when((total > 0) & (F.min("block").over(one) == F.col("block")), F.lit(FIRST_WORD)).otherwise(F.lit(WORD))
    counts = words.select("block", kind.cast("byte").alias("kind"), "slot", total.cast("double").alias("value"))

    strings = layout.where("gram is not null").select("block", "slot", "gram", "n")
    table = cut_lineage(strings.groupBy("gram").agg(F.sum("n").alias("n")))
    chances = (strings.select("block", "slot", "gram").join(gram_scores(table, depth), "gram")
               .select("block", F.lit(GRAM).cast("byte").alias("kind"), "slot", "value"))

    rows = counts.unionAll(chances).withColumnRenamed("block", "of")
    parts = layout.where("pack is not null").select("block", "pack")

    def run(key, left, right):
        return score_block(left, right, depth)

    # one small row a text, kept: the number of kinds is known only once all blocks are through
    scored = cut_lineage(parts.groupBy("block").cogroup(rows.groupBy("of")).applyInArrow(run, SCORES)
                         .groupBy("at").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("train").alias("train"),
                                            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "n_bytes", "n_firsts", "counts_score",
                                                                          "score")]))
    kinds = scored.agg(F.coalesce(F.sum("n_firsts"), F.lit(0))).first()[0]
    scale = math.log10(tokens + ADD * (kinds + 1))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"),
                         (F.col("counts_score") - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score",
                         (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
