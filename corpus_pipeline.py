"""A corpus pipeline of the operators in ``tidemark.llm``.

``STAGES`` lists the stages in order; ``run`` applies them to ``documents``. Every stage
takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and its result is
written as Parquet and read again as the next stage's input. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, quality
from tidemark.llm.common import Scratch
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.minhash import drop_near_copies
from tidemark.llm.mixing import take_mix
from tidemark.llm.tokens import read_spec

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from ``labels`` rows
    that are not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id stays."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the document with the smallest id stays."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken by source weights; a document taken n times is there n times."""
    return take_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its number of tokens, and digests of its ids and of the decoded text."""
    spec = read_spec(TOKENIZER)
    return bpe.digests(bpe.encode(docs, spec), spec)


STAGES = [
    ("quality", good_quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mix),
    ("tokens", tokens),
]

# Neither the classifier nor the tokenizer can be put in SQL; tests compare the stages with
# plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage, every stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    scratch = Scratch(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage_{k}", keep=True)
    return docs
