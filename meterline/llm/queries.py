"""One registered query per operator, and the pipeline; thin digests of the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterline.sources.tables import read

from meterline.llm import (bitplanes, bpe, contexttree, filteraudit, langid, licenses, maintext, neighbours, packing,
                           quality, sharding, simhash, spotsigs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality(spark, sf_dir):
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op2_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_langid(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


@query
def op4_spotsigs(spark, sf_dir):
    return spotsigs.edited_likeness(read(spark, sf_dir, "documents"))


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op6_maintext(spark, sf_dir):
    return maintext.main_text(read(spark, sf_dir, "pages"))


@query
def op7_sharding(spark, sf_dir):
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


@query
def op8_bpe(spark, sf_dir):
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


@query
def op9_licenses(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"))


@query
def op10_neighbours(spark, sf_dir):
    return neighbours.search(read(spark, sf_dir, "embeddings"))


@query
def op11_context_tree(spark, sf_dir):
    return contexttree.score_documents(read(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark, sf_dir):
    return filteraudit.audit_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op13_bitplane_clusters(spark, sf_dir):
    return bitplanes.cluster(read(spark, sf_dir, "embeddings"))


ORACLE |= {"op12_filter_audit": filteraudit.SQL, "op13_bitplane_clusters": bitplanes.SQL}


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
