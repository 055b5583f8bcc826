"""Texts, layouts and repeated rows that earlier versions of the operators lost or failed on."""

import time

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from meterline.llm import bpe, langid, maintext, packing, quality

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RUNS = [" " * 5000, " " * 5000 + "x", "a" + "\n" * 6000 + " b", "é" + "\t " * 3000 + "7", "x" + " " * 4096 + "!", "x" + " " * 4095 + "!",
        "　" * 5000 + "字", " " * 4500 + "'s", "a " + " " * 5000, "\x1c" * 5000 + "a", " " * 9000 + "\n" * 9000 + "end" + " " * 5000]


def test_long_runs_of_blanks_have_the_ids_of_the_plain_engine():
    encode, decode = bpe.load(RANKS, public_tokenizers.PATTERN)
    packed = packing.byte_encoder(JSON)
    whole = packing.text_encoder(JSON)
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    with open(RANKS, "rb") as f:
        import base64
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    plain = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in RUNS:
        assert encode(text) == plain.encode_ordinary(text) and decode(encode(text)) == text.encode()
        assert packed(text) == whole(text) == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" * 2_000_000, "!" * 2_000_000, "b" + " \n" * 1_000_000 + "c"])
def test_two_million_of_a_kind(spark, text):
    encode, decode = bpe.load(RANKS, public_tokenizers.PATTERN)
    ids = encode(text)
    assert decode(ids) == text.encode() and packing.text_encoder(JSON)(text) == ids
    rule = regex.compile(public_tokenizers.PATTERN)
    with open(RANKS, "rb") as f:
        import base64
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    engine = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ids == [i for m in rule.finditer(text) for i in engine._encode_single_piece(m.group().encode())]


def test_long_blanks_through_the_operators(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "word " * 40_000 + " " * 600_000 + "end")], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got[1].n_tokens == 1_000_000 and set(got) == {1, 2}
    import hashlib
    assert got[2].decoded_sha256 == hashlib.sha256(("word " * 40_000 + " " * 600_000 + "end").encode()).hexdigest()
    assert packing.pieces(docs.where("doc_id = 1"), JSON).agg(F.sum("length")).first()[0] == 1_000_001


def test_fractions_and_superscripts_are_no_letters(spark):
    rows = [(i, f"the cat sat on the mat number {i} and looked at the old moon", "en") for i in range(40)]
    rows += [(100 + i, f"le chat est sur la table et regarde la lune {i} fois par nuit", "fr") for i in range(40)]
    odd = [(900, "½ ² ①", None), (901, "12 !! _", None), (902, None, None), (903, "ª", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    assert [got[i][0] for i in (900, 901, 902)] == ["und"] * 3 and got[903][0] != "und"
    assert langid.words_of("x²y ½a") == ["x", "y", "a"]


def test_repeated_labelled_ids_do_not_multiply(spark, monkeypatch):
    rows = [(i, f"the cat sat on the mat number {i} and looked at the old moon", "en") for i in range(40)]
    rows += [(100 + i, f"le chat est sur la table et regarde la lune {i} fois par nuit", "fr") for i in range(40)]
    once = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    many = spark.createDataFrame(rows + [rows[3]] * 1000 + [(3, "une autre ligne", "fr")] * 500, "doc_id long, text string, lang string")
    seen = []
    real = langid.train
    monkeypatch.setattr(langid, "train", lambda x: seen.append(x) or real(x))
    langid.fit(many)
    langid.fit(once)
    assert len(seen[0]) == len(seen[1])
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(40), *range(100, 140)]], "doc_id long, quality int, toxic int")
    sizes, fit = [], quality.train
    monkeypatch.setattr(quality, "train", lambda x, y: sizes.append(x.shape) or fit(x, y))
    quality.fit(many, labels)
    quality.fit(once, labels)
    assert sizes[0] == sizes[1]


def text(html):
    return maintext.text_of(maintext.parse(html))


BODY = "<p>The first long paragraph of the page says what there is to say.</p><p>The second one goes on for a while.</p>"
WANT = "The first long paragraph of the page says what there is to say.\nThe second one goes on for a while."


@pytest.mark.parametrize("html", [
    f"<body><form action=x><nav>menu</nav>{BODY}<input name=q></form></body>",
    f"<body><form><article>{BODY}</article></form><footer>imprint</footer></body>",
    f"<body><aside><main>{BODY}</main></aside><aside>more links</aside></body>",
    f"<body><header><main>{BODY}</main></header></body>",
    f"<body><form><p>Subscribe now</p><button>ok</button></form><article>{BODY}</article></body>",
    f"<body>{BODY}<form><label>Your mail</label><input><button>Send</button></form></body>",
    f"<body>{BODY}<aside><p>Read this too</p></aside></body>",
    f"<body><header><h1>Site</h1></header><article>{BODY}</article></body>",
])
def test_wrappers_round_the_text_do_not_take_it_along(html):
    assert text(html) == WANT


def test_headlines_formulas_and_words_in_sentences_stay():
    assert text(f"<article><header><h1>Title</h1><p>by me</p><nav>x</nav></header>{BODY}</article>") == f"Title\n{WANT}"
    assert text(f"<article><header><p>by me</p></header>{BODY}</article>") == WANT
    assert text("<article><p>Press <button>Start</button> to see <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p></article>") \
        == "Press Start to see x=2 here."
    assert text("<article><p>Text.</p><button>Buy</button></article>") == "Text."


def test_deep_nesting_takes_linear_time():
    deep = "<div class=widget>" * 6000 + "<p>deep text</p>" + "</div>" * 6000
    began = time.time()
    text(f"<body><h1>t</h1>{deep}</body>")
    assert time.time() - began < 5


def scanned_by_rows(text, rule_list):
    """(labels, score) of a text of words, with Python's matcher and plain loops."""
    import re
    words = f" {' '.join(re.findall(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', text.lower()))} "
    found = []
    for r in rule_list:
        if r["keyword"] in words and r["context"] in words:
            for m in re.finditer(r["pattern"], words):
                start = words[:m.start()].count(" ") - 1
                found.append((start, -(start + len(m.group().split())), r["priority"], r["label"], r["score"], r["base"]))
    labels, best, last = {h[3] for h in found if h[5]}, 0.0, None
    for h in sorted(found):
        if last is None or h[0] >= -last[1]:
            kept = True
        elif -h[1] <= -last[1]:
            continue
        elif h[2] < last[2]:
            last = h
            continue
        else:
            kept = h[2] == last[2]
        if kept:
            if last:
                labels.add(last[3])
                best = max(best, last[4])
            last = h
    if last:
        labels.add(last[3])
        best = max(best, last[4])
    return ",".join(sorted(labels)), 1.0 if any(h[5] for h in found) else best


def test_license_labels_equal_plain_loops(spark):
    import random

    from meterline.llm import licenses
    rule = {"keyword": " ", "context": " ", "score": 0.5, "base": False}
    few = [rule | {"label": "long", "priority": 5, "pattern": "(?<= )a b c(?= )"}, rule | {"label": "best", "priority": 1, "pattern": "(?<= )c d(?= )", "score": 0.9},
           rule | {"label": "inner", "priority": 0, "pattern": "(?<= )b(?= )"}, rule | {"label": "late", "priority": 7, "pattern": "(?<= )d e f(?= )"},
           rule | {"label": "peer", "priority": 1, "pattern": "(?<= )d e(?= )", "base": True}]
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefg", k=rng.randint(0, 25))) for _ in range(150)] + ["a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, few).collect()}
    assert got == {i: scanned_by_rows(t, few) for i, t in enumerate(texts)} and got[150] == ("best", 0.9)
    real = licenses.rules()
    words = "licensed under the mit license apache version 2 0 gnu general public gpl v3 or later cc by nc sa bsd 3 clause see terms of spdx identifier".split()
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs).collect()}
    assert got == {i: scanned_by_rows(t, real) for i, t in enumerate(texts)}


def test_bit_counts_take_little_memory():
    import tracemalloc
    import numpy as np
    from meterline.llm import simhash
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 400, 1_500)
    sizes[700] = 3 * simhash.BLOCK + 7                      # one text over several blocks
    values = rng.integers(0, 2**64, sizes.sum(), dtype=np.uint64)
    tracemalloc.start()
    got = simhash.majority(values, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    at = np.r_[0, np.cumsum(sizes)]
    for i in (0, 1, 699, 700, 701, 1_499):
        own = [int(v) for v in values[at[i]:at[i + 1]]]
        assert int(got[i]) == sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in own) > len(own))


def test_large_tokenizer_is_read_only_for_texts_with_added_tokens(monkeypatch):
    import tokenizers
    read = []

    class Counting:
        @staticmethod
        def from_file(path, of=tokenizers.Tokenizer.from_file):
            read.append(path)
            return of(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    encode = packing.text_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = encode("plain text")
    assert plain and not read
    marked = encode("plain text<|endoftext|>") + encode("<|endoftext|>")
    assert len(read) == 1 and marked[:len(plain)] == plain and marked[-1] == marked[-2]


def test_pipeline_bounds_its_batches(spark):
    import corpus_pipeline
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    try:
        for given, then in (("10000", "1000"), ("0", "1000"), ("64", "64")):
            spark.conf.set(conf, given)
            corpus_pipeline.near_duplicate_stage(
                spark, spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id long, text string"), "")
            assert spark.conf.get(conf) == then
    finally:
        spark.conf.set(conf, before)
