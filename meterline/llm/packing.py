"""Best-fit packing of documents into sequences by linear grouping.

1. Every document becomes token ids plus a closing id 0; longer ones are cut into pieces.
2. Spark counts the pieces of each length: at most ``WINDOW`` numbers, whatever the corpus.
3. From those counts alone the driver makes a plan (``plan``):
   large lengths are dealt into groups of equal cardinality and rounded up to the largest
   length of their group; the few sizes left make a configuration problem (which multisets
   of sizes fill a sequence, and how often), solved as a linear program by column
   generation with a knapsack as pricing step, rounded down; the actual lengths are put
   back in place of the rounded ones; all that remains, the small lengths above all, goes
   to the fullest sequence with room, largest length first.
   Pieces of one length are alike, so the plan is kept as runs ("pieces a..b of this length,
   k to a sequence, from sequence s on, at this offset"), some thousands at any corpus size.
4. Spark numbers the pieces by length, and every piece finds its run by its number.

Edge cases: null and empty texts are documents of one token (the closing id); a text of any
length is cut into full pieces after a shorter first one; an added token of the tokenizer file (say
<|endoftext|>) in a text is one id; repeated rows and ids are packed
each on its own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import cut_lineage, encode_any, numbered, text_or_empty

WINDOW = 2048
CLOSING_ID = 0
#: what counts as large (over WINDOW / part) and into how many groups it is dealt; each
#: choice is planned, and the plan with the fewest sequences is used
CHOICES = ((8, 64), (2, 64))
#: column generation ends when no pattern is worth more than this above its cost
TOLERANCE = 1e-3


# --- tokens ---------------------------------------------------------------------------------

def byte_encoder(tokenizer_json: str):
    """Encoder (text -> ids) with the vocabulary and merges of a byte-level BPE file.

    Ids are those of ``tokenizers`` for the same file with special tokens off (the tests
    compare them); the merge engine is tiktoken's, which is five times as fast.  Holds for
    files whose ids are in merge order, which is checked.
    """
    import public_tokenizers
    import tiktoken

    with open(tokenizer_json, encoding="utf-8") as f:
        spec = json.load(f)
    # the printable stand-ins of byte-level BPE: 188 bytes stand for themselves, the rest from U+0100
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    made = [(m if isinstance(m, str) else " ".join(m)).replace(" ", "") for m in spec["model"]["merges"]]
    ids = [spec["model"]["vocab"][m] for m in made]
    if ids != sorted(ids):
        raise ValueError("the ids are not in merge order")
    return partial(encode_any, tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                 special_tokens={}))


def text_encoder(tokenizer_json: str):
    """Encoder (text -> ids) equal to ``tokenizers`` at its defaults: the file's added tokens get their ids.

    Texts without an added token go to ``byte_encoder``, the others to ``tokenizers`` itself.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_json, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f).get("added_tokens", [])]
    fast, whole = byte_encoder(tokenizer_json), None

    def encode(text: str) -> list[int]:
        nonlocal whole
        if any(x in text for x in added):
            if whole is None:                   # most tasks never meet such a text, and it is large
                whole = Tokenizer.from_file(tokenizer_json)
            return whole.encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


def pieces(docs: DataFrame, tokenizer_json: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    def cut(batches):
        encode = text_encoder(tokenizer_json)
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = array("I", encode(text.as_py()))
                ids.append(CLOSING_ID)
                at, end = 0, len(ids) % window or window
                n = 0
                while at < len(ids):
                    out.append((doc, n, at, end - at, zlib.crc32(ids[at:end].tobytes())))
                    n, at, end = n + 1, end, end + window
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
                .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long"))


# --- plan -----------------------------------------------------------------------------------

def configurations(sizes: list[int], demand: list[int], window: int) -> list[tuple[list[int], int]]:
    """[(items of each size, times)]: rounded-down optimum of the configuration program."""
    n = len(sizes)
    sizes_ = np.array(sizes)
    basis = np.diag([float(window // s) for s in sizes])
    d = np.array(demand, float)

    def best_pattern(value):
        """Unbounded knapsack: the most valuable multiset of sizes that fits."""
        worth = np.zeros(window + 1)
        last = np.full(window + 1, -1)
        for room in range(sizes_.min(), window + 1):
            fits = sizes_ <= room
            got = np.where(fits, worth[np.maximum(room - sizes_, 0)] + value, -1.0)
            k = int(got.argmax())
            if got[k] > worth[room - 1] + 1e-12:
                worth[room], last[room] = got[k], k
            else:
                worth[room] = worth[room - 1]
        items, room = np.zeros(n), window
        while room > 0:
            if last[room] < 0:
                room -= 1
            else:
                items[last[room]] += 1
                room -= sizes_[last[room]]
        return worth[window], items

    for _ in range(20 * n):
        inverse = np.linalg.inv(basis)
        worth, items = best_pattern(np.ones(n) @ inverse)
        if worth <= 1 + TOLERANCE:
            break
        step, amount = inverse @ items, inverse @ d
        ratios = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratios.argmin())
        if not np.isfinite(ratios[leave]):
            break
        basis[:, leave] = items
    amount = np.linalg.solve(basis, d)
    return [([int(round(v)) for v in basis[:, j]], int(amount[j] + 1e-9)) for j in range(n) if amount[j] >= 1]


def sequences(runs) -> int:
    return max((bin0 + -(-number // per) for _, number, _, per, bin0, _ in runs), default=0)


def best_plan(counts: dict[int, int], window: int = WINDOW):
    """The plan with the fewest sequences among ``CHOICES``."""
    return min((plan(counts, window, part, groups) for part, groups in CHOICES), key=sequences)


def plan(counts: dict[int, int], window: int, part: int, groups: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (first piece, pieces, length, to a sequence, first sequence, offset).

    Pieces are numbered by length, ascending, from 0.  ``counts``: pieces of each length.
    Lengths over ``window / part`` are large and dealt into about ``groups`` groups.
    """
    lengths = sorted(counts)
    first = dict(zip(lengths, np.cumsum([0, *[counts[x] for x in lengths]]).tolist()))
    left = dict(counts)                         # pieces of each length without a place yet
    runs: list[tuple[int, int, int, int, int, int]] = []
    bins = 0

    def take(length, number, per_bin, bin0, offset):
        runs.append((first[length] + counts[length] - left[length], number, length, per_bin, bin0, offset))
        left[length] -= number

    if left.get(window):                        # full pieces are sequences by themselves
        number = left[window]
        take(window, number, 1, bins, 0)
        bins += number

    large = [x for x in lengths if window // part < x < window]
    total = sum(counts[x] for x in large)
    members: list[list[int]] = []               # lengths of each group; groups break between lengths
    seen = 0
    for x in large:
        if not members or seen >= len(members) * total / groups:
            members.append([])
        members[-1].append(x)
        seen += counts[x]
    free: dict[int, list[tuple[int, int]]] = {}         # room -> runs of sequences (first, number)
    rooms: list[int] = []                               # rooms with sequences, sorted

    def put(room, bin0, number):
        if number and room:
            if room not in free:
                free[room] = []
                insort(rooms, room)
            free[room].append((bin0, number))

    if members:
        for items, times in configurations([m[-1] for m in members],
                                           [sum(counts[x] for x in m) for m in members], window):
            stretch = [(0, times, 0)]                   # (first sequence of the run, number, filled)
            for group, copies in enumerate(items):
                for _ in range(copies):
                    pool = [x for x in members[group] if left[x]]
                    done = []
                    for bin0, number, filled in stretch:
                        while number and pool:          # actual lengths in place of the rounded one
                            x = pool[0]
                            n = min(number, left[x])
                            take(x, n, 1, bins + bin0, filled)
                            done.append((bin0, n, filled + x))
                            bin0, number = bin0 + n, number - n
                            if not left[x]:
                                pool.pop(0)
                        if number:
                            done.append((bin0, number, filled))
                    stretch = done
            for bin0, number, filled in stretch:
                put(window - filled, bins + bin0, number)
            bins += times

    for x in reversed(lengths):                         # best fit, largest first
        while left[x]:
            at = bisect_left(rooms, x)
            if at == len(rooms):                        # no room anywhere: new sequences
                per = window // x
                number = -(-left[x] // per)
                put(window, bins, number)
                bins += number
                continue
            room = rooms[at]
            bin0, number = free[room].pop()
            if not free[room]:
                del free[room]
                rooms.pop(at)
            per = room // x
            full = min(number, left[x] // per)
            if full:
                take(x, full * per, per, bin0, window - room)
                put(room - per * x, bin0, full)
            elif left[x]:                               # fewer than one sequence takes
                n = left[x]
                take(x, n, n, bin0, window - room)
                put(room - n * x, bin0, 1)
                full = 1
            put(room, bin0 + full, number - full)
    return runs


def pack(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``rows`` with doc_id, piece, start, length, ids_crc32, plus sequence_id and offset."""
    rows = cut_lineage(rows)
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}   # at most ``window`` rows
    table, _ = numbered(rows, "length", "doc_id", "piece", "start", "ids_crc32", name="n")
    runs = np.array(sorted(best_plan(counts, window)), np.int64).reshape(-1, 6)

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(n: pd.Series) -> pd.DataFrame:
        n = n.to_numpy()
        r = runs[np.searchsorted(runs[:, 0], n, "right") - 1]
        nth = n - r[:, 0]
        return pd.DataFrame({"sequence_id": r[:, 4] + nth // r[:, 3], "offset": r[:, 5] + nth % r[:, 3] * r[:, 2]})

    return table.withColumn("at", place("n")).select(*rows.columns, "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, tokenizer_json: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    return pack(pieces(docs, tokenizer_json, window), window)
