"""Corpus pipeline over the documents table.

Toxic documents go, repeated lines go, of each group of near-duplicate
documents one stays, sources are mixed to their target weights, and the mix
is packed into sequences.  Every stage works on all rows the one before kept
and hands on the columns of documents (the last returns the packing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import jaccard, lines, mixing, packing, toxicity
from basketry.llm.common import cut, documents, read_table
from basketry.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on ``labels``, does not hold for toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier one; n_chars follows."""
    return lines.without_repeated_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the least doc_id."""
    return jaccard.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their sequence and offset."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("jaccard_join", keep_one_of_near_copies),
          ("mixing", mix_sources), ("packing", pack)]

#: Learned scores, edit similarity and byte-pair tokens have no SQL form; tests
#: compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
