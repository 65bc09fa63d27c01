"""The registered queries of the corpus operators: production parameters, whole tables."""

import public_tokenizers as tokenizers
from pyspark.sql import functions as F

from . import (
    alignment, bpe, decontaminate, graph_search, huffman, jaccard_join, language, licenses, prefix_trie,
    secrets, sharding, surrogates, toxicity,
)

QUERIES, CHECKS = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_bpe(spark, sf):
    return bpe.round_trip(table(spark, sf, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          tokenizers.PATTERN)


@query
def op4_language(spark, sf):
    return language.identify(table(spark, sf, "documents"))


@query
def op7_decontamination(spark, sf):
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_sharding(spark, sf):
    return sharding.assign(table(spark, sf, "documents"), 24)


@query
def op5_secrets(spark, sf):
    return secrets.digest(table(spark, sf, "documents"))


@query
def op8_jaccard_join(spark, sf):
    return jaccard_join.join(table(spark, sf, "documents"))


@query
def op3_graph_search(spark, sf):
    return graph_search.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op10_huffman(spark, sf):
    return huffman.round_trip(table(spark, sf, "documents"), tokenizers.path("word_bpe_49k.json"))


@query
def op6_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query
def op9_surrogates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return surrogates.pseudonymize(docs, "surrogates of the documents table")


@query
def op11_toxicity(spark, sf):
    return toxicity.detect(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_alignment(spark, sf):
    return alignment.align(table(spark, sf, "documents"), tokenizers.path("byte_bpe_50k.json"),
                           tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)


@query
def op13_trie(spark, sf):
    return prefix_trie.trie(table(spark, sf, "conversations"))


CHECKS["op13_trie"] = prefix_trie.CHECK


@query
def pipeline(spark, sf):
    import corpus_pipeline  # the stages stand at the repository's top and use this package

    return corpus_pipeline.run(spark, sf)
