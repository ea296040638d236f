"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from stockyard.llm import (
    ann,
    bpe,
    collocation,
    decontam,
    langid,
    lm,
    minhash,
    resample,
    simhash,
    suffix_dedup,
    tokencount,
    toxicity,
    urlfilter,
)
from stockyard.llm.common import table


# The rules of the URL contract.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op1_nearest_neighbours(spark, sf_dir):
    """The five nearest vectors (cosine) of every fiftieth embedding, by a k-means tree."""
    return ann.nearest_neighbours(spark, table(spark, sf_dir, "embeddings"))


def op2_language_id(spark, sf_dir):
    """Language of every document, learned from two thirds of them."""
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op3_bpe_encode_decode(spark, sf_dir):
    """Token ids of every document and their decoding, as digests."""
    return bpe.encode_texts(spark, table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.json"), caches=3)


def op4_lm_scoring(spark, sf_dir):
    """Unigram and maximum-entropy log-probabilities of every document."""
    return lm.score_texts(spark, table(spark, sf_dir, "documents"))


def op5_token_counts(spark, sf_dir):
    """Unigram token counts of every document."""
    return tokencount.count_tokens(spark, table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("piece_bpe_32k.model"))


def op6_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page URL."""
    return urlfilter.judge(spark, table(spark, sf_dir, "pages"), URL_RULES)


def op7_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from four fifths of the labels."""
    return toxicity.score_texts(spark, table(spark, sf_dir, "documents"),
                                table(spark, sf_dir, "labels"))


def op8_suffix_array_dedup(spark, sf_dir):
    """Bytes of every document that repeated 200-byte strings cover."""
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark, sf_dir):
    """Words of every document inside ten-word windows of test items."""
    return decontam.decontaminate(spark, table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark"))


def op10_simhash_near_dedup(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    got = simhash.near_groups(spark, table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), simhash.hex_fp(F.col("fp")).alias("fingerprint"), "component_id")


def op11_phrase_collocations(spark, sf_dir):
    """The best two- and three-word collocations of each language."""
    return collocation.mine(spark, table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark, sf_dir):
    """The twentieth of the documents that is most like the benchmark, drawn with noise."""
    return resample.resample(spark, table(spark, sf_dir, "documents"),
                             table(spark, sf_dir, "benchmark"))


def op13_minhash_near_dedup(spark, sf_dir):
    """Near-duplicate component of every document, by MinHash bands and exact links."""
    return minhash.near_groups(spark, table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    """The corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_nearest_neighbours, op2_language_id, op3_bpe_encode_decode, op4_lm_scoring,
    op5_token_counts, op6_url_filter, op7_toxicity, op8_suffix_array_dedup,
    op9_benchmark_decontamination, op10_simhash_near_dedup,
    op11_phrase_collocations, op12_importance_resampling, op13_minhash_near_dedup, pipeline)}
