"""Corpus pipeline: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return the
rows of ``docs`` that they keep, with the columns of ``docs``; the last returns one row per
packed piece.  ``run`` applies them to ``documents``, each result written as Parquet in the
shared checkpoint folder and read again as the next stage's input, so that a lost
executor never costs more than the stage at hand.  A stage's files go when the next stage's are
written; those of the last but one stay, since the result is read from them.

Edge cases are those of the operators: null and empty texts are scored, have no language and
go in the second stage; an empty table passes through all stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterline.llm import langid, packing, quality, simhash
from meterline.session import checkpoint_dir
from meterline.sources.sinks import remove
from meterline.sources.tables import read


#: most rows of a batch between Spark and Python.  A task holds several copies of its batch, in the JVM outside the
#: heap and in Python; Spark's 10,000 whole texts, or their shingle hashes, are hundreds of megabytes an executor.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``BATCH_ROWS``; a smaller one stays.  No result depends on it."""
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, does not reject."""
    bound_batches(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language."""
    bound_batches(spark)
    return langid.keep_known(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    bound_batches(spark)
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    bound_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: classifiers and fingerprints are beyond SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    before = ""
    base = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for n, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if n == len(STAGES) - 1:
            return out
        made = f"{base}/{n}-{name}"
        out.write.parquet(made)
        if n:
            remove(spark, before)
        docs, before = spark.read.parquet(made), made
    return docs
