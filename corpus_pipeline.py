"""A corpus from raw documents to tokens: quality rules, exact and near duplicates, mixture, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of ``documents``.
Nulls, empty tables and repeated rows have the results that the operators' own descriptions state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cloudweft.llm import bpe, exact, jaccard, mixing, quality
from cloudweft.llm.common import discard, documents, labels, tables, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned posterior reject go."""
    return quality.keep_good(docs)


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose texts are equal but for white space, the one with the longest text stays."""
    return exact.drop_copies(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words with a similarity of 0.8 or more, the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say, for the target weights of domains, which are learned from all labelled
    documents and not only from those left."""
    return mixing.mix(docs, labels(spark, sf_dir), known=documents(spark, sf_dir))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the bytes that the ids decode to."""
    return bpe.encode_table(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", one_of_equal),
    ("n-gram Jaccard join", one_of_similar),
    ("mixing to target weights", mixture),
    ("byte-level BPE", tokens),
]

#: Expectation-maximisation, gradient descent and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder before the next one reads it."""
    docs, mark = documents(spark, sf_dir), tables()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
