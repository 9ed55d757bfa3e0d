"""The corpus pipeline: documents in, packed sequences out; part of the subpackage ``strataflow.llm``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import mixing, packing, simhash, substring, toxicity
from strataflow.llm.common import ready, table
from strataflow.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    ready(spark)
    return toxicity.without_toxic(docs, toxicity.learnt(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ready(spark)
    return simhash.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut; a document that loses all its words stays as an empty text."""
    ready(spark)
    return substring.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and topics meet their target weights."""
    ready(spark)
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with the sequences and offsets they take."""
    ready(spark)
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Learnt lexicons, near-duplicate components and tokenizers have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
