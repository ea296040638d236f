"""Training-corpus pipeline over ``documents``: five stages, each written as
Parquet and read again as the next one's input.

Every stage but the last returns the columns of its input (extra columns too).
Null texts pass through all of them; an empty table gives an empty result;
repeated rows are copies of one document, of which the near-duplicate stage
keeps one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm import bpe, decontam, simhash, suffix_dedup, toxicity
from stockyard.llm.common import prepare, table, written

# A document with a larger share of its words inside test items goes whole.
MAX_COVERAGE = 0.8
TOKENIZER = "byte_bpe_50k.json"


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in ("doc_id", "text"))


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The input with its extra columns under names that no result has."""
    names = {c: f"_in{k}" for k, c in enumerate(_others(docs))}
    return docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in names.items()]), names


def _restored(df: DataFrame, docs: DataFrame, names: dict[str, str], text: str,
              n_chars=None) -> DataFrame:
    cell = {"doc_id": F.col("doc_id"), "text": F.col(text)}
    cell |= {c: F.col(n) for c, n in names.items()}
    if n_chars is not None and "n_chars" in cell:
        cell["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return df.select(*[cell[c].alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    src, names = _renamed(docs)
    got = toxicity.score_texts(spark, src, table(spark, sf_dir, "labels"),
                               keep=tuple(names.values()), with_text=True)
    return _restored(got.where("predicted = 0"), docs, names, "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (see ``simhash.keep_one``)."""
    return simhash.keep_one(spark, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 or more that occur again are cut out."""
    src, names = _renamed(docs)
    got = suffix_dedup.remove_repeats(spark, src, keep=tuple(names.values()), with_text=True)
    n = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(
        F.col(names["n_chars"]) if "n_chars" in names else F.lit(None))
    return _restored(got, docs, names, "kept_text", n)


def cut_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; documents that are little else go."""
    src, names = _renamed(docs)
    got = decontam.decontaminate(spark, src, table(spark, sf_dir, "benchmark"),
                                 with_text=True, keep=tuple(names.values()))
    n = F.when(F.col("n_hit") > 0, F.length("clean_text")).otherwise(
        F.col(names["n_chars"]) if "n_chars" in names else F.lit(None))
    return _restored(got.where(F.col("n_hit") <= MAX_COVERAGE * F.col("n_words")), docs, names,
                     "clean_text", n)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return bpe.encode_texts(spark, docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies),
          ("suffix_array_dedup", cut_repeats), ("benchmark_decontamination", cut_test_items),
          ("bpe_encoding", encode)]

# The stages learn models and hash texts, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
